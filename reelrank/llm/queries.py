"""Registered queries over the training-data tables, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from reelrank.llm import (
    bpe, exact_dedup, licenses, lm, packing, phrases, quality_classifier, quality_rules, simhash,
    token_counts, toxicity, url_filter, variants)
from reelrank.llm.common import documents


SIMHASH_WORDS, SIMHASH_BITS = 3, 2


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.ledger(documents(spark, sf_dir))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        quality_rules.passes().alias("kept"), "failed")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"),
                      digests=True)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    return toxicity.score(docs, model, spans=False).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(documents(spark, sf_dir),
                                  public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32",
                                       "sequence_id", "offset")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), SIMHASH_WORDS, SIMHASH_BITS).select(
        "doc_id", "fingerprint", "component_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.sentencepiece_vocabulary(
        public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(documents(spark, sf_dir), vocabulary)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return url_filter.judge(pages, documents(spark, sf_dir))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    words = lm.training_words(docs)
    encoded = lm.encode(docs, words)
    return lm.score_encoded(encoded, lm.fit(encoded, words)).select(
        "doc_id", lm.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_classifier.document_statistics(documents(spark, sf_dir))
    model = quality_classifier.train(
        rows, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    return quality_classifier.score(rows, model).select(
        "doc_id", quality_classifier.held_out().alias("held_out"), "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_quality_rules, op3_bpe, op4_toxicity, op5_packing, op6_simhash, op7_token_counts,
    op8_url_filters, op9_lm_scoring, op10_licenses, op11_quality_classifier,
    op12_collocations, op13_spelling_variants)}

_DEDUP_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""

_QUALITY_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
g AS (
  SELECT r, i, list_aggregate(words[i : i + 4], 'string_agg', ' ') AS gram
  FROM w, unnest(generate_series(1, len(words) - 4)) AS s(i) WHERE len(words) >= 5),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g),
spans AS (
  SELECT r, least(5, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 5)) AS s
  FROM twice WHERE n > 1),
covered AS (SELECT r, sum(s)::BIGINT AS n_repeat_words FROM spans GROUP BY r),
m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(t) - length(replace(t, '!', '')))::BIGINT AS n_bangs,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered USING (r)),
f AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
           + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
           + CASE WHEN 10 * n_symbols > 12 * n_words THEN 4 ELSE 0 END
           + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
           + CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END
           + CASE WHEN n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines THEN 32 ELSE 0 END
           + CASE WHEN 2 * n_bangs > n_words THEN 64 ELSE 0 END)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed FROM f"""

_COLLOCATION_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
c AS MATERIALIZED (
  SELECT lang, m, phrase, count(*) AS f FROM (
    SELECT lang, m, array_to_string(words[i : i + m - 1], ' ') AS phrase
    FROM w, generate_series(1, 5) AS t(m), unnest(generate_series(1, len(words) - m + 1)) AS s(i))
  GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[: m - 1], ' '),
                            array_to_string(string_split(phrase, ' ')[2 :], ' ')]) AS phrase
    FROM c WHERE m > 2) GROUP BY ALL),
cut AS (
  SELECT c.lang, c.phrase, c.f AS a, k,
         array_to_string(string_split(c.phrase, ' ')[: k], ' ') AS first,
         array_to_string(string_split(c.phrase, ' ')[k + 1 :], ' ') AS rest
  FROM c LEFT JOIN longer AS g ON g.lang = c.lang AND g.phrase = c.phrase,
       unnest(generate_series(1, m - 1)) AS s(k)
  WHERE m > 1 AND (g.f IS NULL OR 100 * g.f < 100 * c.f)),
score AS (
  SELECT cut.lang, cut.phrase, a, k, x.f AS l, y.f AS r, n.n,
         ((1000::HUGEINT * a * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut JOIN c AS x ON x.lang = cut.lang AND x.phrase = first
           JOIN c AS y ON y.lang = cut.lang AND y.phrase = rest JOIN n ON n.lang = cut.lang),
low AS (
  SELECT * FROM score QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM low) WHERE rank <= 2000"""

ORACLES = {
    "op12_collocations": _COLLOCATION_SQL,
    "op1_exact_dedup": _DEDUP_SQL,
    "op2_quality_rules": _QUALITY_SQL,
}
