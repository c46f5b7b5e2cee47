"""Review sentiment on a 1-5 scale, all native expressions.

A token polarity lexicon is learned from labelled documents (smoothed
log ratio of document rates between quality 1 and quality 0 texts).
Each sentence gets the mean polarity of its tokens (unknown tokens
count 0), is cut into classes 0-4 at fixed points, and maps to a 1-5
score. A text's sentiment is the mean of its sentence scores (3.0 when
it has no sentence); the longest-sentence and first-sentence readings
are returned too. Whole texts are scored; each distinct text once.

A model of one's own takes the lexicon's place through ``scorer``: it is
loaded once per Python worker and gives the class of each sentence.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import Protocol

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from reelrank.functions.scalar import (class_to_label, class_to_score, label_to_score,
                                       round_ratio_half_up)
from reelrank.functions.text import sentences, tokens
from reelrank.session import cut_lineage
from reelrank.sizing import DEFAULT_BROADCAST_ROWS, broadcast_row_bound, sized_broadcast

# Class cut points on a sentence's mean token polarity.
# class 0 below -0.5, 1 below -0.1, 2 up to 0.1, 3 up to 0.5, else 4.
CUTS = (-0.5, -0.1, 0.1, 0.5)
NEUTRAL_SCORE = 3.0


def polarity_lexicon(documents: DataFrame, labels: DataFrame, min_docs: int = 1) -> DataFrame:
    """token, df1, df0, polarity = ln((df1+1)/(D1+2)) - ln((df0+1)/(D0+2)),
    with df* the number of quality-1 / quality-0 documents containing the
    token and D* the number of such documents."""
    lab = labels.select("doc_id", "quality")
    docs = documents.select("doc_id", "text").join(lab, "doc_id")
    toks = docs.select("quality", F.explode(F.array_distinct(tokens("text"))).alias("token"))
    counts = toks.groupBy("token").agg(
        F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("df1"),
        F.sum(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("df0"))
    d1 = lab.select(F.sum(F.when(F.col("quality") == 1, 1).otherwise(0))).scalar()
    d0 = lab.select(F.sum(F.when(F.col("quality") == 0, 1).otherwise(0))).scalar()
    pol = (F.log((F.col("df1") + 1.0) / (d1 + 2.0)) - F.log((F.col("df0") + 1.0) / (d0 + 2.0)))
    # a trained artifact read by a size check and a broadcast: write it once
    return cut_lineage(counts.filter(F.col("df1") + F.col("df0") >= min_docs)
                       .select("token", "df1", "df0", pol.alias("polarity")))


def polarity_class(p: Column | str, cuts=CUTS) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    return (F.when(p < cuts[0], 0).when(p < cuts[1], 1).when(p <= cuts[2], 2)
            .when(p <= cuts[3], 3).otherwise(4))


def split_lexicon(lexicon: DataFrame, max_rows: int) -> tuple[DataFrame, DataFrame]:
    """The tokens of the most documents, at most ``max_rows`` of them, and the
    others: token, polarity. Tokens in equally many documents stay together."""
    rows = lexicon.select("token", "polarity", (
        F.col("df1") + F.col("df0") if {"df1", "df0"} <= set(lexicon.columns) else F.lit(0)).alias("_df"))
    room, least = max_rows, math.inf
    # one row per document frequency
    for r in rows.groupBy("_df").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("_df")).toLocalIterator():
        room -= r["n"]
        if room < 0:
            break
        least = r["_df"]
    least = F.lit(float(least))
    return tuple(rows.where(c).select("token", "polarity")
                 for c in (F.col("_df") >= least, F.col("_df") < least))


def sentence_scores(texts: DataFrame, lexicon: DataFrame, cuts=CUTS,
                    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """doc_id, pos, n_chars, n_tokens, polarity, class, score, label per
    sentence that has at least one letter token. Tokens of one sentence
    live in one task, so the partial aggregate leaves one row per
    sentence before the shuffle; the lexicon is broadcast after a
    bounded size check. Of a larger one the tokens of the most documents are,
    and only tokens that are not among these meet the others in a shuffle."""
    sent = texts.select("doc_id", F.posexplode(sentences("text")).alias("pos", "sentence"))
    toks = sent.select("doc_id", "pos", F.length("sentence").alias("n_chars"),
                       F.explode(tokens("sentence")).alias("token"))
    lex, key = lexicon.select("token", "polarity"), ["doc_id", "pos", "n_chars"]
    known = F.coalesce(F.col("polarity"), F.lit(0.0))
    bound = broadcast_row_bound(lex, max_broadcast_rows)
    if lexicon.count() <= bound:
        per = (toks.join(F.broadcast(lex), "token", "left").groupBy(*key)
               .agg(F.count(F.lit(1)).alias("n_tokens"), F.avg(known).alias("polarity")))
    else:
        head, tail = split_lexicon(lexicon, bound)
        common = toks.join(F.broadcast(head), "token", "left").select(
            *key, F.lit(1).alias("n"), known.alias("p"))
        rare = (toks.join(F.broadcast(head.select("token")), "token", "left_anti").join(tail, "token")
                .select(*key, F.lit(0).alias("n"), known.alias("p")))
        per = (common.unionByName(rare).groupBy(*key)
               .agg(F.sum("n").alias("n_tokens"), F.sum("p").alias("p"))
               .select(*key, "n_tokens", (F.col("p") / F.col("n_tokens")).alias("polarity")))
    cls = polarity_class("polarity", cuts)
    return per.select("doc_id", "pos", "n_chars", "n_tokens", "polarity",
                      cls.alias("class"), class_to_score(cls).alias("score"),
                      class_to_label(cls).alias("label"))


class Scorer(Protocol):
    """What ``review_sentiment`` takes for a model: equal scorers must be
    hashable and compare equal, as they are found again in a worker by value."""

    def load(self) -> Callable[[list[str]], list[int]]:
        """The model: the class (0 to 4) of each of a list of sentences."""


@dataclass(frozen=True)
class LinearScorer:
    """A small linear model over counts of a sentence: letter tokens,
    characters, capitals A-Z, and characters of ``marks``; its value is cut
    into classes as a mean polarity is."""
    tokens: float = 0.0
    characters: float = 0.0
    capitals: float = 0.0
    symbols: float = 0.0
    bias: float = 0.0
    marks: str = "#*$%&"
    cuts: tuple[float, ...] = CUTS

    def load(self) -> Callable[[list[str]], list[int]]:
        letters, marks = regex.compile(r"\p{L}+"), set(self.marks)

        def classes(sentences: list[str]) -> list[int]:
            out = []
            for s in sentences:
                value = (self.bias + self.tokens * len(letters.findall(s)) + self.characters * len(s)
                         + self.capitals * sum("A" <= c <= "Z" for c in s)
                         + self.symbols * sum(c in marks for c in s))
                low, under, over, high = self.cuts
                out.append(0 if value < low else 1 if value < under else
                           2 if value <= over else 3 if value <= high else 4)
            return out
        return classes


@lru_cache(maxsize=4)
def _loaded(scorer: Scorer) -> Callable[[list[str]], list[int]]:
    return scorer.load()


def model_sentence_scores(texts: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, pos, n_chars, class, score, label per sentence that has at
    least one letter, by ``scorer`` in Arrow batches."""
    @F.pandas_udf("int")
    def classes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _loaded(scorer)
        for sentences_ in batches:
            yield pd.Series(model(sentences_.tolist()), dtype="int32")

    sent = (texts.select("doc_id", F.posexplode(sentences("text")).alias("pos", "sentence"))
            .where(F.col("sentence").rlike(r"\p{L}")))
    rows = sent.select("doc_id", "pos", F.length("sentence").alias("n_chars"),
                       classes("sentence").alias("class"))
    return rows.select("doc_id", "pos", "n_chars", "class", class_to_score("class").alias("score"),
                       class_to_label("class").alias("label"))


def review_sentiment(texts: DataFrame, scores: DataFrame | None = None,
                     scorer: Scorer | None = None) -> DataFrame:
    """doc_id, n_sentences, sentiment (mean sentence score, HALF_UP 2),
    sentiment_longest (score of the longest sentence, first on a tie),
    sentiment_first, label_first; a text with no sentence (null, empty,
    punctuation only) gets 3.0 / NEUTRAL. The sentences' scores are given, or
    come from ``scorer``."""
    if (scores is None) == (scorer is None):
        raise ValueError("give either scores or a scorer")
    scores = scores if scorer is None else model_sentence_scores(texts, scorer)
    per_doc = scores.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_sentences"),
        F.sum(F.col("score").cast("long")).alias("_sum"),
        F.max_by("score", F.struct(F.col("n_chars"), -F.col("pos"))).alias("_longest"),
        F.min_by("score", "pos").alias("_first"),
        F.min_by("label", "pos").alias("_label"))
    out = texts.select("doc_id").join(per_doc, "doc_id", "left")
    return out.select(
        "doc_id",
        F.coalesce(F.col("n_sentences"), F.lit(0)).cast("long").alias("n_sentences"),
        F.coalesce(round_ratio_half_up("_sum", "n_sentences", 2), F.lit(NEUTRAL_SCORE)).alias("sentiment"),
        F.coalesce(F.col("_longest"), F.lit(NEUTRAL_SCORE)).alias("sentiment_longest"),
        F.coalesce(F.col("_first"), F.lit(NEUTRAL_SCORE)).alias("sentiment_first"),
        F.coalesce(F.col("_label"), F.lit("NEUTRAL")).alias("label_first"))


def label_scores(sentiment: DataFrame, seed: int = 42) -> DataFrame:
    """doc_id, label, labelScore: the first-sentence label mapped to its
    score band plus a seeded fraction (positive 4-5, neutral 2-3,
    negative 0-1)."""
    lab = F.lower(F.col("label_first"))
    return sentiment.select("doc_id", lab.alias("label"),
                            label_to_score(lab, ["doc_id"], seed).alias("labelScore"))


def scored_reviews(reviews: DataFrame, sentiment: DataFrame,
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Reviews with sentimentResult replaced by the text's sentiment; the
    per-text scores (one row per distinct text) join on doc_id. Many
    reviews may share one text: the per-text side is broadcast when a
    bounded count shows it small, else AQE splits the hot doc_id."""
    s = sized_broadcast(sentiment.select("doc_id", F.col("sentiment").alias("_s")),
                        max_broadcast_rows, materialize=True)
    return (reviews.join(s, "doc_id", "left")
            .withColumn("sentimentResult", F.coalesce(F.col("_s"), F.lit(NEUTRAL_SCORE)))
            .drop("_s"))
