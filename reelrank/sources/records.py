"""CSV records that span lines, put together across file splits.

A quoted field may hold line breaks, and a line of one field is the rest of
the record before it. Files are read by lines, in as many tasks as they have
splits: each split reports how many quotes and records it holds, running sums
over the splits tell in what state a split begins, and only the lines of
records that have several are brought together. A quote counts as opening or
closing wherever it stands, as in well-formed CSV.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from reelrank.session import cut_lineage
from reelrank.sizing import sized_broadcast

# A record with more lines than this is a quote that never closes, one with
# more parts no record: their lines are rejects.
MAX_LINES = 10_000
_SPLIT = ["file", "split"]


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, split, at, line: every line with its file, where its split
    begins, and a number that rises within the split."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def _before(rows: DataFrame, amount: Column, name: str) -> DataFrame:
    """``rows`` with the sum of ``amount`` over all earlier rows of the file:
    per split, over the splits (one row each), then within the split."""
    sums = rows.groupBy(*_SPLIT).agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = sized_broadcast(sums.select(
        *_SPLIT, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start")), materialize=True)
    within = Window.partitionBy(*_SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn(name, F.coalesce(F.sum(amount).over(within), F.lit(0)))
            .join(starts, _SPLIT).withColumn(name, F.col(name) + F.col("_start")).drop("_start"))


def _gathered(rows: DataFrame, group: Column, text: str) -> DataFrame:
    """One row per ``group`` (a number within the file) at the place of its
    first line: file, split, at, first, rest (the later texts in order)."""
    held = F.array_sort(F.collect_list(F.struct("split", "at", text)))
    first = F.col("_all")[0]
    return (rows.groupBy("file", group.alias("_group")).agg(held.alias("_all"))
            .select("file", first["split"].alias("split"), first["at"].alias("at"),
                    first[text].alias("first"),
                    F.transform(F.slice("_all", F.lit(2), F.size("_all")), lambda x: x[text]).alias("rest")))


def _bounded(rows: DataFrame, number: str, most: int) -> tuple[DataFrame, DataFrame]:
    """The rows of groups of at most ``most`` rows, and the others."""
    large = (rows.groupBy("file", number).agg(F.count("*").alias("n")).where(F.col("n") > most)
             .select("file", number))
    return (rows.join(large, ["file", number], "left_anti"),
            rows.join(large, ["file", number], "left_semi"))


def csv_records(spark: SparkSession, path: str, max_lines: int = MAX_LINES
                ) -> tuple[DataFrame, DataFrame]:
    """(records, rejects): file, split, at, record of every record that is
    not blank, at the place of its first line; and the lines (``line``) of
    records that never end."""
    lines = text_lines(spark, path)
    quotes = (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))).cast("long")
    lines = _before(lines, quotes, "_quotes")
    new = (F.col("_quotes") % 2 == 0)
    lines = cut_lineage(lines.select("file", "split", "at", "line", new.alias("new"))
                        .where(~(F.col("new") & F.col("line").rlike("^,*$"))))
    numbered = _before(lines, F.col("new").cast("long"), "_records")
    number = F.col("_records") + F.col("new").cast("long")
    # a record is one line if another starts after it in the same split
    next_new = F.lead("new").over(Window.partitionBy(*_SPLIT).orderBy("at"))
    numbered = cut_lineage(numbered.select(
        "file", "split", "at", "line", number.alias("record"), (F.col("new") & F.coalesce(next_new, F.lit(False)))
        .alias("single")))
    alone = numbered.where("single").select("file", "split", "at", F.col("line").alias("record"))
    several, endless = _bounded(numbered.where("not single"), "record", max_lines)
    rejects = endless.select("line")
    joined = _gathered(several, F.col("record"), "line")
    whole = F.array_join(F.concat(F.array("first"), F.col("rest")), "\n")
    return alone.union(joined.select("file", "split", "at", whole.alias("record"))), rejects


def read_repaired(spark: SparkSession, path: str, names: tuple[str, ...], join_to: int = 2,
                  header: bool = False, max_lines: int = MAX_LINES) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): the fields of every record as strings, by position.
    Blank lines are skipped; a record of one field is added, after a space,
    to field ``join_to`` of the last record that has more. Rejects (``line``):
    records with another number of fields, one-field records with none
    before them in their file, and what has more than ``max_lines`` lines or
    parts. ``header``: the first record of each file is one."""
    records, rejects = csv_records(spark, path, max_lines)
    bare = F.regexp_replace("record", '"[^"]*"', "")
    records = cut_lineage(records.withColumn("many", F.contains(bare, F.lit(","))))
    records = _before(records, F.col("many").cast("long"), "_many")
    number = F.col("_many") + F.col("many").cast("long")
    next_many = F.lead("many").over(Window.partitionBy(*_SPLIT).orderBy("at"))
    records = cut_lineage(records.select(
        "file", "split", "at", "record", number.alias("group"),
        (F.col("many") & F.coalesce(next_many, F.lit(False))).alias("single")))
    alone = records.where("single").select(
        "group", F.col("record").alias("first"), F.array().cast("array<string>").alias("rest"))
    lead = records.where("not single and group = 0").select(F.col("record").alias("line"))
    parts, endless = _bounded(records.where("not single and group > 0"), "group", max_lines)
    joined = _gathered(parts, F.col("group"), "record")
    # which group it was: heads carry their own number
    joined = joined.join(records.where("not single").select("file", "split", "at", "group"),
                         ["file", "split", "at"]).select("group", "first", "rest")
    rows = alone.union(joined)
    if header:
        rows = rows.where("group > 1")
    options = {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_bad"}
    schema = ", ".join(f"`{n}` string" for n in names) + ", _bad string"
    field = lambda x: F.from_csv(x, F.lit("c string"), {"quote": '"', "escape": '"'})["c"]
    parsed = rows.withColumn("f", F.from_csv("first", F.lit(schema), options)).withColumn(
        "more", F.transform("rest", field))
    bad = F.col("f._bad").isNotNull()
    out = [F.when(F.size("more") > 0, F.concat_ws(" ", F.coalesce(F.col(f"f.{n}"), F.lit("")), F.col("more")))
           .otherwise(F.col(f"f.{n}")).alias(n) if k == join_to else F.col(f"f.{n}").alias(n)
           for k, n in enumerate(names)]
    wrong = parsed.where(bad).select(F.array_join(
        F.concat(F.array("first"), F.col("rest")), "\n").alias("line"))
    return parsed.where(~bad).select(*out), rejects.union(lead).union(wrong).union(
        endless.select(F.col("record").alias("line")))
