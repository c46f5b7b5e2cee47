"""Hybrid blend of two recommendation lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

USER, ITEM = "userId", "itemId"


def blend_recommendations(first: DataFrame, second: DataFrame,
                          score: str = "totalScore") -> DataFrame:
    """Full outer join on (userId, itemId); totalScore = (s1 + s2) / 2 with
    a missing score counted as 0 (an item in one list only gets half its
    score); sorted by score desc, then item. Inputs are top-N lists, so
    the join and the sort are bounded by the list lengths."""
    a = first.select(USER, ITEM, F.col(score).cast("double").alias("totalScore1"))
    b = second.select(USER, ITEM, F.col(score).cast("double").alias("totalScore2"))
    total = (F.coalesce(F.col("totalScore1"), F.lit(0.0)) +
             F.coalesce(F.col("totalScore2"), F.lit(0.0))) / F.lit(2.0)
    return (a.join(b, [USER, ITEM], "full_outer")
            .select(USER, ITEM, total.alias("totalScore"))
            .orderBy(F.col("totalScore").desc(), F.col(ITEM).asc()))
