"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelrank.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = (both.groupBy("u").agg(F.min("v").alias("m"))
             .select("u", F.least("u", "m").alias("m")))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return least.withColumnRenamed("m", "v").union(moved).distinct()


def star_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v): every node of ``edges`` (u, v) but each component's smallest,
    with that smallest node. Rounds grow with the logarithm of the longest
    chain; each is written to the shared folder."""
    current = written(edges.where("u <> v").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        current = written(_small_star(_large_star(current)), "stars")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return current
        before = state
    raise RuntimeError("components did not settle")
