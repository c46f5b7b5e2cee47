"""The CSV command line end to end on files made from the small tables."""

import os
import tempfile

from pyspark.sql import functions as F

from reelrank.plans.cli import run
from reelrank.sources.tables import reviews, table

from .conftest import SF_SMALL


def _write_inputs(spark):
    d = tempfile.mkdtemp(prefix="reelrank-cli-")
    r = reviews(spark, SF_SMALL).join(table(spark, SF_SMALL, "documents").select("doc_id", "text"), "doc_id")
    (r.select(F.col("itemId").alias("movieId"), "rating", F.col("text").alias("quote"),
              F.col("creationDate").cast("date").cast("string").alias("creationDate"), "userId",
              "sentimentResult")
     .coalesce(1).write.option("header", True).csv(os.path.join(d, "reviews")))
    lab = table(spark, SF_SMALL, "documents").join(table(spark, SF_SMALL, "labels"), "doc_id")
    lab.select("text", "quality").coalesce(1).write.option("header", True).csv(os.path.join(d, "labelled"))
    return d


def test_cli_commands(spark):
    d = _write_inputs(spark)
    src = os.path.join(d, "reviews")
    for cmd in ("user-knn", "item-knn", "als", "hybrid", "two-hop", "gd"):
        out = os.path.join(d, cmd)
        run(spark, [cmd, "--input", src, "--output", out, "--top", "20"])
        back = spark.read.option("header", True).csv(out)
        assert back.count() > 0
    run(spark, ["sentiment", "--input", src, "--output", os.path.join(d, "scored"),
                "--labelled", os.path.join(d, "labelled")])
    scored = spark.read.option("header", True).csv(os.path.join(d, "scored"))
    assert "sentimentResult" in scored.columns and "quote" not in scored.columns
    run(spark, ["prepare", "--input", src, "--output", os.path.join(d, "prep")])
    prep = spark.read.option("header", True).csv(os.path.join(d, "prep", "reviews"))
    users = spark.read.option("header", True).csv(os.path.join(d, "prep", "userId_mapping"))
    assert prep.count() > 0 and users.count() > 0
    idx = sorted(int(r.userId_index) for r in users.collect())
    assert idx == list(range(len(idx)))  # dense ids 0..n-1
