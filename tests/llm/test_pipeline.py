"""The pipeline's stages against their operators, and the registration."""

import corpus_pipeline
from reelrank.llm import packing, queries

SF = "/root/testdata/sf0.001"


def test_stages_filter_whole_documents(spark):
    docs = corpus_pipeline.documents(spark, SF)
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.written(stage(spark, docs, SF), "test")
        assert kept.columns == docs.columns, name
        assert kept.exceptAll(docs).count() == 0, name
        assert 0.5 * before < kept.count() <= docs.count(), name
        docs = kept
    texts = [r["text"] for r in docs.collect()]
    assert len(texts) == len(set(texts))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in docs.collect()}


def test_stages_on_odd_rows_and_clashing_columns(spark, odd):
    good = "the quick brown fox jumps over one lazy dog and then runs far away "
    more = [(i, f"{good} number {i} {'abcdefghij'[i % 10] * 4} x{i}") for i in range(100, 130)]
    more += [(None, good), (None, good), (200, good), (200, good), (201, good)]
    extra = spark.createDataFrame([(i, t, "n", 1, "fp", 2.0) for i, t in more], odd.schema)
    clash = odd.unionByName(extra).selectExpr(
        "*", "1 as _n", "'k' as y", "2 as root", "3 as piece", "'x' as text_sha256",
        "4 as _at", "5 as _key", "6 as row")
    docs = corpus_pipeline.written(clash, "odd")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.written(stage(spark, docs, SF), "odd")
        assert kept.columns == docs.columns, name
        assert kept.exceptAll(docs).count() == 0, name
        docs = kept
    left = docs.where(docs.text == good).collect()
    assert [r["doc_id"] for r in left] == [201]  # the largest id of equal texts
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in docs.collect()}


def test_stages_keep_one_of_many_repeated_rows(spark, none):
    rows = [(None, "same text without an id")] * 300 + [(5, "text five")] * 40 + [(6, "text six")]
    docs = spark.createDataFrame([(i, t, "n", 1, "fp", 2.0) for i, t in rows], none.schema).repartition(4)
    for stage in (corpus_pipeline.dedup_stage, corpus_pipeline.near_dedup_stage):
        kept = sorted((r["doc_id"] or 0, r["text"]) for r in stage(spark, docs, SF).collect())
        assert kept == [(0, "same text without an id"), (5, "text five"), (6, "text six")]


def test_stages_on_an_empty_table(spark, none):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0, name


def test_run_equals_its_stages(spark):
    found = corpus_pipeline.run(spark, SF)
    rows = found.collect()
    assert rows and max(r["offset"] + r["length"] for r in rows) <= packing.CAPACITY


def test_registered():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.ORACLES) <= set(queries.QUERIES)
