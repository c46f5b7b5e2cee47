"""Streaming forms give the batch results."""

import os
import tempfile

from reelrank.functions.text import clean_text
from reelrank.operators.sentiment import polarity_lexicon, review_sentiment, sentence_scores
from reelrank.sources.tables import table
from reelrank.streaming.reviews import clean_text_stream, read_text_stream, sentiment_stream

from .conftest import SF_SMALL


def test_clean_text_stream_matches_batch(spark):
    pages = table(spark, SF_SMALL, "pages").select("page_id", "html")
    src = tempfile.mkdtemp(prefix="reelrank-src-")
    pages.write.mode("overwrite").parquet(os.path.join(src, "p"))
    out, ck = tempfile.mkdtemp(prefix="reelrank-out-"), tempfile.mkdtemp(prefix="reelrank-ck-")
    q = clean_text_stream(read_text_stream(spark, os.path.join(src, "p"), "page_id long, html string"), out, ck)
    q.awaitTermination(120)
    got = sorted(spark.read.parquet(out).collect())
    want = sorted(pages.select("page_id", clean_text("html").alias("text")).collect())
    assert got == want


def test_sentiment_stream_matches_batch(spark):
    docs = table(spark, SF_SMALL, "documents")
    lex = polarity_lexicon(docs, table(spark, SF_SMALL, "labels"))
    src = tempfile.mkdtemp(prefix="reelrank-src-")
    docs.select("doc_id", "text").write.mode("overwrite").parquet(os.path.join(src, "d"))
    out, ck = tempfile.mkdtemp(prefix="reelrank-out-"), tempfile.mkdtemp(prefix="reelrank-ck-")
    stream = read_text_stream(spark, os.path.join(src, "d"), "doc_id long, text string")
    sentiment_stream(stream, lex, out, ck).awaitTermination(180)
    got = sorted(spark.read.parquet(out).drop("epoch").collect())
    texts = docs.select("doc_id", "text")
    want = sorted(review_sentiment(texts, sentence_scores(texts, lex)).collect())
    assert got == want


def test_sentiment_stream_restart_writes_nothing_twice(spark):
    """A restarted query resumes from its checkpoint: files already
    processed are not scored again, so no rows are duplicated."""
    docs = table(spark, SF_SMALL, "documents")
    lex = polarity_lexicon(docs, table(spark, SF_SMALL, "labels"))
    src = tempfile.mkdtemp(prefix="reelrank-src-")
    docs.select("doc_id", "text").write.mode("overwrite").parquet(os.path.join(src, "d"))
    out, ck = tempfile.mkdtemp(prefix="reelrank-out-"), tempfile.mkdtemp(prefix="reelrank-ck-")
    for _ in range(2):
        stream = read_text_stream(spark, os.path.join(src, "d"), "doc_id long, text string")
        sentiment_stream(stream, lex, out, ck).awaitTermination(180)
    got = spark.read.parquet(out)
    assert got.count() == docs.count()
    assert got.select("doc_id").distinct().count() == docs.count()
