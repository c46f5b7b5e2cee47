"""Writers. No driver-side CSV building: executors write the files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDATION_COLUMNS = ("userId", "itemId", "totalScore")
# Rows of one named object at most: one task writes them.
ONE_OBJECT_ROWS = 5_000_000


def write_recommendations(df: DataFrame, path: str, mode: str = "overwrite",
                          single_file: bool = False) -> None:
    """CSV with header. ``single_file`` coalesces to one part and is meant
    for top-N outputs only, whose size is bounded by N."""
    out = df.select(*[c for c in RECOMMENDATION_COLUMNS if c in df.columns],
                    *[c for c in df.columns if c not in RECOMMENDATION_COLUMNS])
    if single_file:
        out = out.coalesce(1)
    out.write.option("header", True).option("escape", '"').mode(mode).csv(path)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """``source`` takes the name of ``target`` in one step of the file system."""
    sc = spark.sparkContext
    rename = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, target).toUri(), sc._jsc.hadoopConfiguration())
    context.rename(_path(spark, source), _path(spark, target), options)


def _attempt(df: DataFrame, path: str, max_rows: int) -> tuple[str, list[str]]:
    """``df`` as CSV parts with headers in a folder of its own beside
    ``path``; the folder and its parts in order."""
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}.attempt-{uuid.uuid4().hex}"
    df.write.option("header", True).option("escape", '"').option("maxRecordsPerFile", max_rows).csv(folder)
    names = [s.getPath().getName() for s in _file_system(spark, folder).listStatus(_path(spark, folder))]
    return folder, [f"{folder}/{n}" for n in sorted(names) if n.startswith("part-")]


def write_one_object(df: DataFrame, path: str, max_rows: int = ONE_OBJECT_ROWS) -> None:
    """CSV with one header as one object named ``path``, replacing what had
    the name. One task writes it, so more than ``max_rows`` rows are an error
    (write parts instead). The name changes hands by a rename once all is
    written: a failed attempt leaves the old object, a second one writes
    the same."""
    spark = df.sparkSession
    folder = None
    try:
        folder, parts = _attempt(df.coalesce(1), path, max_rows)
        if len(parts) > 1:
            raise ValueError(f"more than {max_rows} rows for one object")
        _replace(spark, parts[0], path)
    finally:
        if folder is not None:
            _file_system(spark, folder).delete(_path(spark, folder), True)


def write_named_parts(df: DataFrame, folder: str, name: str) -> list[str]:
    """Every partition of ``df`` as one CSV object with a header, named
    ``folder``/``name``-00000.csv and on, in the partitions' order."""
    spark = df.sparkSession
    attempt, parts = _attempt(df, f"{folder.rstrip('/')}/{name}", 0)
    _file_system(spark, folder).mkdirs(_path(spark, folder))
    out = [f"{folder.rstrip('/')}/{name}-{i:05d}.csv" for i in range(len(parts))]
    for source, target in zip(parts, out):
        _replace(spark, source, target)
    _file_system(spark, attempt).delete(_path(spark, attempt), True)
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet (default) or CSV table; id mappings and cleaned data."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)
