"""The driver's parquet tables and the review views derived from them.

``reviews`` maps the TPC-H-like tables onto the review data model: one
review per line item, the order's customer is the user and the part is
the item. Every column is an expression, so filters and column pruning
reach the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table; filters and column pruning reach the scan, whose
    splits are for ``spark.sql.files.maxPartitionBytes`` to size."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, itemId, rating (1-5), sentimentResult (1-5), doc_id, creationDate.

    Duplicated (userId, itemId) rows are real and kept.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate")
    n_docs = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    line_key = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    return (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("userId"),
            F.col("l_partkey").alias("itemId"),
            F.ceil(F.col("l_quantity") / 10).cast("double").alias("rating"),
            (F.lit(1) + line_key % 5).cast("double").alias("sentimentResult"),
            (line_key % n_docs).alias("doc_id"),
            F.col("o_orderdate").alias("creationDate"),
        )
    )


def review_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text: the distinct texts reviews point to (scored once each)."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")
