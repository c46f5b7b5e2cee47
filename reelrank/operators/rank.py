"""Ranking: global top-N, top-N per user, min-max scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from reelrank.session import cut_lineage

# Scores are compared at this many decimals when ranking, so values that
# are equal up to float summation order tie and fall back to the id.
RANK_DIGITS = 9


def top_n(df: DataFrame, n: int, score: str, key: str) -> DataFrame:
    """The ``n`` highest scores, ties broken by ``key`` ascending
    (planned as TakeOrderedAndProject: a bounded heap per partition)."""
    return df.orderBy(F.round(F.col(score), RANK_DIGITS).desc(), F.col(key).asc()).limit(n)


def topn_per_user(df: DataFrame, n: int, score: str = "totalScore",
                  user: str = "userId", item: str = "itemId",
                  rank_col: str = "rank") -> DataFrame:
    """At most ``n`` rows per user by score desc, then item id. The
    ``row_number() <= n`` filter is planned with a partial WindowGroupLimit
    before the shuffle, so a user with millions of rows ships only n."""
    w = Window.partitionBy(user).orderBy(F.round(F.col(score), RANK_DIGITS).desc(),
                                         F.col(item).asc())
    return (df.withColumn(rank_col, F.row_number().over(w))
            .filter(F.col(rank_col) <= n))


def minmax_scale(df: DataFrame, score: str, upper: float = 10.0, cap: float = 10.0,
                 constant: float = 5.0, out: str = "NormalizedScore") -> DataFrame:
    """least(bround(upper * (x - min) / (max - min), 2), cap); every row
    gets ``constant`` when all scores are equal. The scores (one row per
    item) are written once to the checkpoint folder; min and max are scalar
    subqueries over that copy, so the scoring plan runs once and nothing
    reaches the driver."""
    df = cut_lineage(df)
    lo = df.select(F.min(score)).scalar()
    hi = df.select(F.max(score)).scalar()
    scaled = F.lit(float(upper)) * (F.col(score) - lo) / F.nullif(hi - lo, F.lit(0.0))
    return df.withColumn(out, F.when(lo == hi, F.lit(float(constant)))
                         .otherwise(F.least(F.bround(scaled, 2), F.lit(float(cap)))))
