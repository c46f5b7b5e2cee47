"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a logistic score over a
small learned vocabulary; the document's probability is the noisy-or of its
sentences (with a leak for labels that no sentence explains). Training uses
document labels only and yet tells which sentences offend.

The fit sees a bounded sample of the labelled training documents
(``SAMPLE_DOCS`` label ids by a hash of the id, and of their rows as many by a
hash of id and text, equal rows once): their word counts per class choose the
vocabulary, and the known words of their sentences, equal sets counted, reach
the driver.

Cases: null and empty texts have no sentence and get the leak's score; rows
with equal or null ids are scored each on their own (null ids are never held
out and never train); of several labels of one id the largest counts; null
labels are left out; without both classes the score is a constant; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reelrank.llm.common import written

# Bounds of the fit: labelled documents in the sample, words in the model.
SAMPLE_DOCS, FEATURES = 40_000, 256
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")
# a sentence: a stretch without . ! ? and line feeds that holds a letter
_WORDED = re.compile(r"[^.!?\n]*?[^\W\d_][^.!?\n]*")


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    leak: float


def held_out(id_col: str = "doc_id", mod: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == fold, F.lit(False))


def features(lowered: str) -> set[str]:
    """Letter runs of a lower-case text and, as stems, their first five and
    seven letters (marked by ^)."""
    words = set(_WORD.findall(lowered))
    stems = {"^" + w[:n] for n in (5, 7) for w in words if len(w) > n}
    return words | stems


# --- what the labelled documents say about words ------------------------------

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, pos, neg): documents of either class that hold the word."""
    def flush(counts):
        words = list(set(counts[0]) | set(counts[1]))
        return pa.RecordBatch.from_pydict({
            "word": words, "pos": pa.array([counts[1][w] for w in words], pa.int64()),
            "neg": pa.array([counts[0][w] for w in words], pa.int64())})

    counts = (Counter(), Counter())
    for batch in batches:
        for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[y].update(features(t.lower()))
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield flush(counts)
                counts = (Counter(), Counter())
    yield flush(counts)


def toxic_words(labelled: DataFrame, n_pos: int, n_neg: int,
                limit: int = FEATURES) -> dict[str, float]:
    """The words and stems whose share among positives most exceeds that
    among negatives, in standard errors (at most ``limit``), each with the
    log odds of its shares."""
    counts = (labelled.select("y", "t").mapInArrow(_count_words, "word string, pos long, neg long")
              .groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    p = (F.col("pos") + F.col("neg")) / F.lit(float(n_pos + n_neg))
    z = (F.col("pos") / n_pos - F.col("neg") / n_neg) / F.sqrt(
        p * (1 - p) * (1.0 / n_pos + 1.0 / n_neg) + 1e-12)
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    best = (counts.where("pos >= 3").select("word", z.alias("z"), odds.alias("odds"))
            .where("z >= 3").orderBy(F.desc("z"), "word").limit(limit))
    return {r["word"]: r["odds"] for r in best.collect()}


def _bags(text: str, known: dict[str, int]) -> tuple[int, Counter]:
    """Number of sentences without a known word; of the others, how often
    each set of known words occurs."""
    plain, bags = 0, Counter()
    for s in _WORDED.findall(text.lower()):
        words = features(s)
        if words:
            hit = tuple(sorted(known[w] for w in words if w in known))
            if hit:
                bags[hit] += 1
            else:
                plain += 1
    return plain, bags


def _bag_task(known: dict[str, int]):
    kind = pa.list_(pa.struct([("words", pa.list_(pa.int32())), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_bags(t, known) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "y": batch.column(0),
                "plain": pa.array([p for p, _ in found], pa.int64()),
                "bags": pa.array([[{"words": w, "n": n} for w, n in b.items()]
                                  for _, b in found], kind)})
    return run


def fit_noisy_or(y: np.ndarray, plain: np.ndarray, bags: list[list[tuple[list[int], int]]],
                 prior: np.ndarray, steps: int = 400, pull: float = 0.3,
                 rate: float = 0.08) -> tuple[np.ndarray, float, float]:
    """Weights, bias and leak by Adam on the noisy-or likelihood of documents
    with ``plain`` sentences and bags (words, sentences) of the others; weights
    are pulled towards ``prior``, so that a word which others explain away
    in the sample keeps what the counts say."""
    doc, times, sent, feat = [], [], [], []
    s = 0
    for i, doc_bags in enumerate(bags):
        for b, count in doc_bags:
            doc.append(i)
            times.append(count)
            sent += [s] * len(b)
            feat += b
            s += 1
    doc, sent, feat = np.array(doc, int), np.array(sent, int), np.array(feat, int)
    times = np.array(times, float)
    n = len(y)
    n_features = len(prior)
    theta = np.concatenate([prior, [-6.0, -3.0]])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, b, leak = theta[:-2], theta[-2], theta[-1]
        z = b + np.bincount(sent, weights=w[feat], minlength=s)
        # -log(1 - P) is the sum of softplus over sentences and leak
        energy = (np.bincount(doc, weights=times * np.logaddexp(0, z), minlength=n)
                  + plain * np.logaddexp(0, b) + np.logaddexp(0, leak))
        d_energy = np.where(y == 1, -1.0 / np.expm1(np.maximum(energy, 1e-9)), 1.0)
        dz = times * d_energy[doc] / (1 + np.exp(-z))
        sig_b, sig_l = 1 / (1 + np.exp(-b)), 1 / (1 + np.exp(-leak))
        grad = np.concatenate([
            np.bincount(feat, weights=dz[sent], minlength=n_features) + pull * (w - prior),
            [dz.sum() + sig_b * (d_energy * plain).sum(), sig_l * d_energy.sum()]]) / n
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-10)
    return theta[:-2], float(theta[-2]), float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
          label: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> Model:
    marks = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()
                          & ~held_out(id_col))
             .groupBy(F.col(id_col).cast("long").alias("_id"))
             .agg(F.max(F.col(label).cast("int")).alias("y")))
    # thresholds on hashes: sample_docs ids, give or take a few hundred, the
    # same ones in every run and small enough to broadcast; and of their rows,
    # equal ones once, no more than that either, whatever an id repeats
    def drawn(n: int, *by: str) -> Column:
        cut = int(min(1.0, sample_docs / max(n, 1)) * 2**62)
        return F.shiftrightunsigned(F.xxhash64(*by), 2) <= cut

    rows = docs.select(F.col(id_col).cast("long").alias("_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn(
        "_digest", F.xxhash64("t")).join(F.broadcast(marks.where(drawn(marks.count(), "_id"))), "_id")
    texts = rows.select("_id", "_digest").distinct().count()
    labelled = written(rows.where(drawn(texts, "_digest", "_id")).groupBy("_id", "_digest").agg(
        F.first("y").alias("y"), F.first("t").alias("t")).select("y", "t"), "labelled")
    totals = {r["y"]: r["n"] for r in labelled.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = totals.get(1, 0), totals.get(0, 0)
    rate = (n_pos + 0.5) / (n_pos + n_neg + 10.0)
    words = toxic_words(labelled, n_pos, n_neg) if n_pos and n_neg else {}
    constant = Model({}, -40.0, float(np.log(rate / (1 - rate))))
    if not words:
        return constant
    known = {w: i for i, w in enumerate(words)}
    bags = labelled.select("y", "t").mapInArrow(
        _bag_task(known),
        "y int, plain long, bags array<struct<words:array<int>,n:long>>").collect()
    # an order of their own: the fit's sums do not depend on the tasks'
    bags.sort(key=lambda r: (r["y"], r["plain"], [(b["words"], b["n"]) for b in r["bags"]]))
    y = np.array([r["y"] for r in bags])
    if not len(y) or y.min() == y.max():
        return constant
    w, b, leak = fit_noisy_or(y, np.array([r["plain"] for r in bags], float),
                              [[(b["words"], b["n"]) for b in r["bags"]] for r in bags], np.array(list(words.values())))
    return Model({t: float(x) for t, x in zip(words, w)}, b, leak)


# --- scoring ------------------------------------------------------------------

class Scorer:
    """Scores texts; remembers which words hold known features (bounded)."""

    def __init__(self, model: Model):
        self.model, self._known = model, {}
        self._leak = float(np.logaddexp(0, model.leak))
        self._plain = float(np.logaddexp(0, model.bias))

    def _toxic(self, word: str) -> tuple[str, ...]:
        got = self._known.get(word)
        if got is None:
            if len(self._known) >= 300_000:
                self._known.clear()
            got = tuple(f for f in features(word) if f in self.model.weights)
            self._known[word] = got
        return got

    def __call__(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """(document score, [(start, end, score)] of sentences scored over
        0.5); offsets count characters of ``text``."""
        energy, spans = self._leak, []
        if not any(map(self._toxic, set(_WORD.findall(text.lower())))):
            energy += self._plain * len(_WORDED.findall(text))
            return -math.expm1(-energy), spans
        for m in _WORDED.finditer(text):
            hit = {f for w in _WORD.findall(m.group().lower()) for f in self._toxic(w)}
            if not hit:
                energy += self._plain
                continue
            z = self.model.bias + sum(self.model.weights[f] for f in sorted(hit))
            energy += float(np.logaddexp(0, z))
            if z > 0:
                spans.append((m.start(), m.end(), 1 / (1 + math.exp(-z))))
        return -math.expm1(-energy), spans


def _score_task(model: Model, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            n = batch.num_columns
            found = [scorer(t) for t in batch.column(n - 1).to_pylist()]
            columns = dict(zip(batch.schema.names[:n - 1], batch.columns[:n - 1]))
            columns["score"] = pa.array([s for s, _ in found], pa.float64())
            if spans:
                columns["spans"] = pa.array(
                    [[{"start": a, "end": b, "score": s} for a, b, s in x] for _, x in found],
                    pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                        ("score", pa.float64())])))
            yield pa.RecordBatch.from_pydict(columns)
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text",
          spans: bool = True) -> DataFrame:
    """doc_id, score and (``spans``) the offending sentences."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("t"))
    extra = ", spans array<struct<start:long,end:long,score:double>>" if spans else ""
    return rows.mapInArrow(_score_task(model, spans), f"doc_id long, score double{extra}")


def clean_rows(docs: DataFrame, model: Model, text: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` scored under ``threshold``, columns as given."""
    doc = F.struct(*[F.col(c) for c in docs.columns])
    rows = docs.select(doc.alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    kind = rows.schema["doc"].dataType.simpleString()
    return (rows.mapInArrow(_score_task(model, False), f"doc {kind}, score double")
            .where(F.col("score") < threshold).select("doc.*"))
