"""Preparation: validity split, sampling, splits, caps, dense ids, dedupe."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from reelrank.functions.hashing import unit_hash
from reelrank.session import cut_lineage
from reelrank.sizing import DEFAULT_BROADCAST_ROWS, block_count, sized_broadcast

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
           T.FloatType, T.DoubleType, T.DecimalType)
FLOATING = (T.FloatType, T.DoubleType)
# Ranges that dense ids are numbered in at least, and keys of one.
MIN_RANGES, RANGE_KEYS = 8, 1_000_000


def _valid_predicate(df: DataFrame, cols: Sequence[str] | None) -> Column:
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    pred = F.lit(True)
    for f in fields:
        c = F.col(f.name)
        cond = c.isNotNull()
        if isinstance(f.dataType, FLOATING):
            cond = cond & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
        pred = pred & cond
    return pred


def split_valid_rows(df: DataFrame, cols: Sequence[str] | None = None):
    """(valid, rejected): rows with a null, NaN or +-inf value in any of
    ``cols`` (default all) are rejected. One predicate and its negation;
    no join, no index bookkeeping."""
    pred = F.coalesce(_valid_predicate(df, cols), F.lit(False))
    return df.filter(pred), df.filter(~pred)


def sample_fraction(df: DataFrame, fraction: float, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Rows whose seeded key hash falls below ``fraction``. The decision
    depends only on the row's keys, so it is the same on every run and
    for any partitioning (``df.sample`` is not)."""
    return df.filter(unit_hash(list(keys), seed) < F.lit(float(fraction)))


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: the ``n`` smallest key hashes, ties
    by every column.

    A global top-n would merge n rows from every partition in one task
    (P * n rows). The hash is uniform on [0, 1), so rows with a hash below
    t = (n + 8*sqrt(n) + 16) / rows number about n; when at least n pass,
    the n smallest are all among them, so the exact top-n of that small
    set is the answer. A short pass that falls below n doubles t. Two
    passes over the input: the row count and the filtered write."""
    u = unit_hash(list(keys), seed)
    order = [F.col("_u")] + [F.col(c) for c in df.columns]
    rows = df.count()
    if rows <= n:
        return df
    t = (n + 8 * math.sqrt(n) + 16) / rows
    while t < 1.0:
        # about n rows: written once, then counted and ranked from the copy
        kept = cut_lineage(df.withColumn("_u", u).filter(F.col("_u") < F.lit(t)))
        if kept.count() >= n:
            return kept.orderBy(*order).limit(n).drop("_u")
        t *= 2
    return df.withColumn("_u", u).orderBy(*order).limit(n).drop("_u")


def train_test_split(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2,
                     seed: int = 42, col: str = "split") -> DataFrame:
    """Tag each row 'train' or 'test' by its seeded key hash."""
    u = unit_hash(list(keys), seed)
    return df.withColumn(col, F.when(u < F.lit(1.0 - test_fraction), "train").otherwise("test"))


def cap_per_user(df: DataFrame, k: int, user: str, order: Sequence[Column | str] | None = None) -> DataFrame:
    """The first ``k`` rows per user in ``order`` (default: every column,
    ascending, so duplicates are handled deterministically). Planned with
    a partial WindowGroupLimit, so hot users ship k rows per partition."""
    order = list(order) if order else [F.col(c) for c in df.columns if c != user]
    w = Window.partitionBy(user).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= k).drop("_rn"))


def index_ids(df: DataFrame, col: str, method: str = "sorted", partitions: int | None = None) -> DataFrame:
    """Dense ids 0..n-1 for the distinct values of ``col``.

    ``sorted``: ascending value order (first appearance has no meaning in a
    distributed table). ``frequency``: most frequent first, ties by value
    (what StringIndexer does, without shipping the dictionary through the
    driver). Distributed: values are range-partitioned and sorted, each
    partition is numbered locally, and per-partition offsets (one row per
    partition) are added.
    """
    if method == "frequency":
        keys = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
        order = [F.col("_n").desc(), F.col(col).asc()]
    elif method == "sorted":
        keys = df.select(col).distinct()
        order = [F.col(col).asc()]
    else:
        raise ValueError(f"unknown method {method!r}")
    keys = cut_lineage(keys)
    # ranges follow the number of keys, not the cluster
    parts = partitions or max(MIN_RANGES, block_count(keys.count(), RANGE_KEYS))
    ranged = keys.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    tagged = ranged.select(col, F.spark_partition_id().alias("_pid"),
                           F.monotonically_increasing_id().alias("_mid"))
    tagged = cut_lineage(tagged)  # fixes partition ids and positions
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_size"))
    # one row per partition: a bounded table, ordered in one small task
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .select(F.col(col).alias(f"{col}_original"),
                    (F.col("_offset") + local).cast("long").alias(f"{col}_index")))


def apply_index(df: DataFrame, mapping: DataFrame, col: str,
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Replace ``col`` by its dense index (inner join with the mapping,
    broadcast when a bounded count shows the mapping small)."""
    m = sized_broadcast(mapping.withColumnRenamed(f"{col}_original", col), max_broadcast_rows)
    return df.join(m, col).drop(col).withColumnRenamed(f"{col}_index", col)


def dedupe_pairs(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (then the
    other columns), so the choice is deterministic. A hash aggregate with
    partial aggregation: duplicates collapse before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in list(order) + rest])).alias("_best")
    return (df.groupBy(*keys).agg(best)
            .select(*keys, *[F.col(f"_best.{c}").alias(c) for c in list(order) + rest]))
