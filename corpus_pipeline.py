"""Corpus pipeline: documents through the training-data operators in turn.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns the rows it keeps with the columns of ``docs``; the last
returns the packed pieces. Between stages the rows are written as Parquet.

Cases, in every stage: a null text counts as empty; rows with equal or null
ids are judged each on their own; further columns of ``docs`` are kept as
they are, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from reelrank.llm import packing, quality_rules, simhash, toxicity
from reelrank.llm.common import documents, written
from reelrank.llm.exact_dedup import exact_dedup, keep_rows
from reelrank.llm.queries import SIMHASH_BITS, SIMHASH_WORDS


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored under the threshold, by a model trained on the labels of
    rows outside the held-out fold. An empty text has the score that labels
    give without any sentence; without labels of both classes all rows have
    one score, the share of toxic labels."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.clean_rows(docs, toxicity.train(docs, labels))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that break no rule of the policy; null and empty texts have too
    few words and go."""
    return quality_rules.kept_rows(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id, a null id being the
    smallest; of rows that repeat id and text, one."""
    found = written(exact_dedup(docs), "exact-dedup-rows")
    return keep_rows(docs, found, found.where("kept"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked SimHash fingerprints the row with the smallest
    id, null ids last; of rows that repeat id and text, one."""
    found = written(simhash.near_duplicates(docs, SIMHASH_WORDS, SIMHASH_BITS), "near-dedup-rows")
    return keep_rows(docs, found, simhash.group_heads(found))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in sequences; an empty text is one end token."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32",
                                       "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality rules", quality_stage),
    ("exact dedup", dedup_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("best-fit packing", packing_stage),
]
# The trained model, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
