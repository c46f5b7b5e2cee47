"""Size checks that decide broadcasts and block counts.

A side is broadcast only after a count proves it small; beyond
the bound the plan keeps a shuffle join (AQE may still split skew).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

# Bounds under which a side may be shipped to every executor: a row cap
# and a byte budget, the row width estimated from the schema.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
# assumed element count of an array column (factor vectors have rank 10)
_ARRAY_LEN = 10


def row_bytes(dtype: T.DataType, array_len: int = _ARRAY_LEN) -> int:
    """A fixed estimate of a value's in-memory width (strings 32 bytes,
    arrays of ``array_len`` elements); ``broadcast_row_bound`` adds 8 bytes
    per row."""
    if isinstance(dtype, T.StructType):
        return sum(row_bytes(f.dataType, array_len) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return 16 + array_len * row_bytes(dtype.elementType, array_len)
    if isinstance(dtype, T.MapType):
        return 16 + array_len * (row_bytes(dtype.keyType) + row_bytes(dtype.valueType))
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return 32
    if isinstance(dtype, (T.ByteType, T.BooleanType)):
        return 1
    if isinstance(dtype, (T.ShortType,)):
        return 2
    if isinstance(dtype, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(dtype, T.DecimalType):
        return 16
    return 8


def broadcast_row_bound(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                        max_bytes: int = DEFAULT_BROADCAST_BYTES,
                        array_len: int = _ARRAY_LEN) -> int:
    return max(1, min(max_rows, max_bytes // (8 + row_bytes(df.schema, array_len))))


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    materialize: bool = False) -> DataFrame:
    """``broadcast(df)`` if a count (one partial sum per partition, no rows
    moved) shows at most
    ``broadcast_row_bound`` rows (``max_rows`` and the byte budget over
    the estimated row width), else ``df`` (a shuffle join; AQE may still
    broadcast it or split a skewed key at run time).

    ``materialize``: the side is an aggregate whose computation is a full
    pass over large data; it is written once to the checkpoint folder so
    the count and the join read that copy instead of recomputing it."""
    if materialize:
        from reelrank.session import cut_lineage
        df = cut_lineage(df)
    if df.count() <= broadcast_row_bound(df, max_rows):
        return F.broadcast(df)
    return df


def block_count(n: int, per_block: int) -> int:
    return max(1, math.ceil(n / max(1, per_block)))
