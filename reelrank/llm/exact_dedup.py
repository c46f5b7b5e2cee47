"""Exact dedup by progressive refinement.

Rows are first grouped by length, then by a hash of the first characters,
and only the rows of surviving groups by the SHA-256 of the whole text. The
text is read once; what is shuffled are lengths and counts, then prefix
hashes, then digests of the survivors.

Cases: null text counts as empty (so null and empty are equal); of equal
texts the row with the largest id stays, among repeated rows with that id
exactly one; a null id is smaller than any other; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelrank.llm.common import skew_lookup, written

PREFIX_CHARS = 64


def signatures(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
               prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per input row: _row, doc_id, size (bytes), prefix, text_sha256."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.octet_length(t).alias("size"),
        F.xxhash64(F.left(t, F.lit(prefix_chars))).alias("prefix"),
        F.sha2(t.cast("binary"), 256).alias("text_sha256"))


def refine(rows: DataFrame) -> DataFrame:
    """Groups of two or more equal texts: text_sha256, group_size, keep."""
    sizes = rows.groupBy("size").agg(F.count("*").alias("n")).where("n > 1")
    left = skew_lookup(rows, sizes, ["size"], "n", ["_row"]).where("n is not null").drop("n")
    prefixes = (left.groupBy("size", "prefix").agg(F.count("*").alias("n"))
                .where("n > 1"))
    left = skew_lookup(left, prefixes, ["size", "prefix"], "n", ["_row"]).where("n is not null")
    return (left.groupBy("text_sha256")
            .agg(F.max(F.struct("doc_id", "_row")).alias("keep"),
                 F.count("*").alias("group_size"))
            .where("group_size > 1"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every input row."""
    rows = written(signatures(docs, id_col, text), "signatures")
    groups = written(refine(rows), "exact-groups")
    out = skew_lookup(rows, groups, ["text_sha256"], "group_size", ["_row"])
    single = F.col("group_size").isNull()
    return out.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("keep._row") == F.col("_row"))).alias("kept"),
        "text_sha256")


def keep_rows(docs: DataFrame, rows: DataFrame, kept: DataFrame, id_col: str = "doc_id",
              text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose (id, text) is in ``kept`` (doc_id,
    text_sha256), each once: rows that repeat id and text are one row.
    ``rows`` has the same two columns for every row of ``docs``; it tells,
    without the texts, how often each occurs. Texts are shuffled once, those
    of pairs that very many rows repeat dealt out by row; only repeated pairs
    meet a second time, after each task has left one of them."""
    def key(number: str, digest: Column) -> Column:
        return F.concat(F.coalesce(F.col(number).cast("string"), F.lit("")), F.lit(":"), digest)

    times = rows.groupBy(key("doc_id", F.col("text_sha256")).alias("_key")).agg(F.count("*").alias("_n"))
    groups = written(kept.select(key("doc_id", F.col("text_sha256")).alias("_key")).distinct()
                     .join(times, "_key"), "kept-keys")
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    # the row as one column: its own names meet no others
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                         key(id_col, digest).alias("_key"), F.monotonically_increasing_id().alias("_at"))
    found = skew_lookup(packed, groups, ["_key"], "_n", ["_at"])
    single = found.where("_n = 1").select("_doc.*")
    if groups.where("_n > 1").isEmpty():
        return single
    several = found.where("_n > 1").dropDuplicates(["_key"]).select("_doc.*")
    return single.unionByName(several)
