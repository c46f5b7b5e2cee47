"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD = r"[^\x20\x09-\x0D]+"
# the separators between words, as single characters
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_bytes(text: str) -> Column:
    """A text column as UTF-8 bytes, null as empty: Python tasks read the
    stored bytes and need no decoding."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``
    (below it, this application's own folder when Spark made one)."""
    current = spark.sparkContext.getCheckpointDir()
    current = current or spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for it")
    return current.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and reread:
    cuts the lineage, survives lost executors, and later steps read only
    the columns they need."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def skew_lookup(rows: DataFrame, groups: DataFrame, keys: list[str], size: str,
                salt_by: list[str], max_hot: int = 1000) -> DataFrame:
    """``rows`` left-joined with ``groups`` (one row per key, ``size`` = how
    many rows carry it) where a key may hold a third of all rows.

    Groups above ``sum(size) / max_hot`` rows number fewer than ``max_hot``
    by arithmetic, so they may be broadcast; their rows are dealt out by
    ``salt_by`` in the shuffle join that serves all other groups.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    cut = max(int(total) // max_hot, 1)
    values = [c for c in groups.columns if c not in keys]
    hot = groups.where(F.col(size) > cut).select(
        *[F.col(k) for k in keys], *[F.col(c).alias(f"_hot_{c}") for c in values])
    cold = groups.where(F.col(size) <= cut).select(
        # zero, but not a literal: a constant would leave the join's keys and
        # with it the dealing out
        *[F.col(k) for k in keys], (F.col(size) > cut).cast("int").alias("_salt"),
        *[F.col(c).alias(f"_cold_{c}") for c in values])
    found = F.col(f"_hot_{size}").isNotNull()
    out = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(found, 1 + F.pmod(F.xxhash64(*salt_by), F.lit(8191)).cast("int"))
        .otherwise(0))
    out = out.join(cold, [*keys, "_salt"], "left")
    return out.select(*[F.col(c) for c in rows.columns],
                      *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in values])


def commonest(counts: DataFrame, count: str, limit: int, key: str = "word") -> DataFrame:
    """The rows of a written ``counts`` table with the largest ``count``, at
    most ``limit``: those above a power of 2^(1/16), and of the rows between
    it and the next lower one as many as still fit, drawn by a hash of
    ``key``. A histogram of some hundred numbers finds the power, so no task
    sends ``limit`` rows of its own."""
    step = F.floor(F.log2(count) * 16).cast("int")
    cut, share, held = 0, 0.0, 0
    for r in sorted(counts.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect(),
                    key=lambda r: -r["s"]):
        cut, share = r["s"], 1.0
        if held + r["n"] > limit:
            room = limit - held  # less six standard deviations of the draw
            share = max(0.0, room - 6 * room ** 0.5) / r["n"]
            break
        held += r["n"]
    drawn = F.shiftrightunsigned(F.xxhash64(key), 11) < F.lit(int(share * 2**53))
    return counts.where((step > cut) | ((step == cut) & drawn))
