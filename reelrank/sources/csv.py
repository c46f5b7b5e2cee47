"""CSV review files: header CSV, bound by column name, every column a string.

Nothing is lost in silence: rows that do not parse are a second output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

REVIEW_COLUMNS = ("movieId", "rating", "quote", "creationDate", "userId")
CORRUPT = "_corrupt_record"


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """The header's column names, in file order."""
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .csv(path).columns)


def read_csv(spark: SparkSession, path: str, multiline: bool = False,
             names: tuple[str, ...] | None = None) -> DataFrame:
    """Every column of the header (or ``names``, for files without one: then
    by position) as a string, plus ``_corrupt_record``:
    null, or the whole line where the number of fields differs from the
    header's. Quoted commas (and with ``multiline`` quoted line breaks,
    which makes each file one task) stay inside a field."""
    header = names is None
    names = names or csv_columns(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    return (spark.read.schema(schema).option("header", header)
            .option("quote", '"').option("escape", '"').option("multiLine", multiline)
            # headers of all files must agree; every field is parsed, so that
            # a wrong number of them shows
            .option("enforceSchema", False).option("columnPruning", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path))


def read_reviews(spark: SparkSession, path: str,
                 columns: tuple[str, ...] = REVIEW_COLUMNS,
                 multiline: bool = False,
                 names: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): the named columns in the given order whatever their
    order in the file (a missing name is an error), and the lines that do
    not parse (``line``). Types are set later with ``try_cast``."""
    df = read_csv(spark, path, multiline, names)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    good = df.where(F.col(CORRUPT).isNull()).select(*columns)
    # all columns are named: a plan that needs the corrupt column alone is not allowed
    bad = df.where(F.col(CORRUPT).isNotNull()).select(
        F.coalesce(F.col(CORRUPT), *[F.col(c) for c in columns]).alias("line"))
    return good, bad
