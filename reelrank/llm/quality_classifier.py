"""Quality by a regularised quadratic discriminant.

A document becomes fourteen statistics (lengths, shares of character classes,
repetition), as logarithms of smoothed ratios. Each class is a normal density
over them whose covariance is shrunk towards a multiple of the identity, by
the oracle-approximating amount that the covariance itself and the number of
rows give. The score is the difference of the two log densities (Mahalanobis
distances under Cholesky factors taken once per model), mapped to 0..1 by a
logistic curve that is fitted to the training margins.

Every text is read once; its statistics are written, and the fit and the
scores read only those. The fit needs sums per class, never single rows. The
labels used are at most about ``SAMPLE_LABELS`` ids (by a hash of the id),
so they may be broadcast; every row with a chosen id counts.

Cases: null and empty texts have the statistics of no words and are scored
like any other; rows with equal or null ids are scored each on their own
(null ids are never held out and never train); of several labels of one id
the largest counts, null labels are left out; without both classes the score
is a constant; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reelrank.llm.common import text_bytes, written

# Bounds of the fit: label ids that are broadcast, bins of the margin.
SAMPLE_LABELS, MARGIN_BINS = 200_000, 400
THRESHOLD = 0.3
# words' worth of average text that every ratio is smoothed with, so that a
# text of three words is not judged by one character
SMOOTH = 20.0
_MARGIN_LIMIT = 50.0

_KINDS = np.zeros(256, np.int64)  # 0: every other printable ASCII character
for _kind, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                b"0123456789", b".,;:'\"()-", b"!?", b" \t\n\r\x0b\x0c",
                                bytes(range(128, 192)), bytes(range(192, 256))), 1):
    _KINDS[list(_bytes)] = _kind
STATISTICS = ("words", "length", "symbols", "capitals", "exclamations", "digits", "punctuation",
              "accents", "distinct", "doubled", "commonest", "repeated_lines", "lines", "breaks")


def held_out(id_col: str = "doc_id", mod: int = 5, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == fold, F.lit(False))


def statistics(data: bytes) -> list[float]:
    """The statistics of one text (UTF-8), in the order of ``STATISTICS``."""
    words = data.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    kinds = np.bincount(_KINDS, weights=counts, minlength=9).tolist()
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]

    def share(part: float, whole: int = n) -> float:
        return math.log((part + 0.05 * SMOOTH) / (whole + SMOOTH))

    times = Counter(words)
    characters = sum(kinds) - kinds[6] - kinds[7]  # continuation bytes are no characters
    return [
        math.log1p(n), share(characters), share(kinds[0]), share(kinds[2]), share(kinds[5]),
        share(kinds[3]), share(kinds[4]), share(kinds[8]),
        math.log1p(len(times)) - 0.8 * math.log1p(n), share(sum(map(eq, words, words[1:]))),
        share(max(times.values(), default=0)), share(len(lines) - len(set(lines)), len(lines)),
        share(len(lines)), share(int(counts[10]))]


def _statistics_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "x": pa.array(rows, pa.list_(pa.float64()))})


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x) of every row, written."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text).alias("t"))
    return written(rows.mapInArrow(_statistics_task, "doc_id long, x array<double>"),
                   "document-statistics")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


# --- the fit --------------------------------------------------------------------

def _moments_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(y, i, v): sums of 1, x and x xT of the task's rows per class."""
    p = len(STATISTICS)
    sums = np.zeros((2, (p + 1) ** 2))
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.hstack([np.ones((batch.num_rows, 1)), _matrix(batch.column(1))])
        y = batch.column(0).to_numpy()
        for k in (0, 1):
            sums[k] += (x[y == k].T @ x[y == k]).ravel()
    y, i = np.indices(sums.shape)
    yield pa.RecordBatch.from_pydict({
        "y": pa.array(y.ravel(), pa.int32()), "i": pa.array(i.ravel(), pa.int32()),
        "v": pa.array(sums.ravel())})


def shrunk(covariance: np.ndarray, n: float) -> np.ndarray:
    """The covariance moved towards its mean variance times the identity by
    the oracle-approximating amount for ``n`` normal rows."""
    p = len(covariance)
    square, trace2 = float((covariance ** 2).sum()), float(np.trace(covariance)) ** 2
    spread = (n + 1 - 2 / p) * (square - trace2 / p)
    rho = min(1.0, ((1 - 2 / p) * square + trace2) / spread) if spread > 0 else 1.0
    identity = np.eye(p)
    return (1 - rho) * covariance + (rho * np.trace(covariance) / p + 1e-4) * identity


@dataclass
class Model:
    """scale: pooled standard deviations. Per class: mean, lower Cholesky
    factor of the shrunk covariance of scaled rows, its inverse, and the log
    of prior and normalising constant. slope, shift: margin to log odds."""
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    whiteners: list[np.ndarray]
    constants: list[float]
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log density (prior included) of class 1 less that of class 0."""
        if not self.means:
            return np.zeros(len(x))
        logs = []
        for mean, whitener, constant in zip(self.means, self.whiteners, self.constants):
            z = ((x - mean) / self.scale) @ whitener.T
            logs.append(constant - 0.5 * np.einsum("ij,ij->i", z, z))
        return logs[1] - logs[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * np.clip(self.margins(x), -_MARGIN_LIMIT, _MARGIN_LIMIT) + self.shift
        return 0.5 * (1 + np.tanh(0.5 * z))


def discriminant(sums: np.ndarray) -> Model | None:
    """The model of summed moments (class, row, column), if both classes occur."""
    p = sums.shape[1] - 1
    n = sums[:, 0, 0]
    if n.min() < 1:
        return None
    means = [s[0, 1:] / s[0, 0] for s in sums]
    spreads = [s[1:, 1:] / s[0, 0] - np.outer(m, m) for s, m in zip(sums, means)]
    pooled = sum(s * k for s, k in zip(spreads, n)) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 0)) + 1e-6
    factors = [np.linalg.cholesky(shrunk(s / np.outer(scale, scale), k))
               for s, k in zip(spreads, n)]
    return Model(scale, means, factors,
                 [np.linalg.solve(f, np.eye(p)) for f in factors],
                 [float(np.log(k / n.sum()) - np.log(np.diag(f)).sum())
                  for f, k in zip(factors, n)])


def calibrated(centres: np.ndarray, n: np.ndarray, n_pos: np.ndarray,
               pull: float = 4.0) -> tuple[float, float]:
    """Slope and shift of the logistic curve through a histogram of margins
    (rows and positives per bin), by Newton steps; pulled to (1, 0)."""
    theta = np.array([1.0, 0.0])
    x = np.stack([centres, np.ones_like(centres)])
    for _ in range(50):
        p = 0.5 * (1 + np.tanh(0.5 * (theta @ x)))
        gradient = x @ (n_pos - n * p) - pull * (theta - [1.0, 0.0])
        hessian = (x * (n * p * (1 - p))) @ x.T + pull * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta = theta + step * min(1.0, 0.5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(max(theta[0], 1e-3)), float(theta[1])


def train(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality",
          sample_labels: int = SAMPLE_LABELS) -> Model:
    """The model of ``document_statistics`` rows and labels outside the
    held-out fold."""
    marks = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()
                          & ~held_out(id_col))
             .groupBy(F.col(id_col).cast("long").alias("doc_id"))
             .agg(F.max((F.col(label) > 0).cast("int")).alias("y")))
    # a threshold on the id's hash: some sample_labels ids, the same in every run
    cut = int(min(1.0, sample_labels / max(marks.count(), 1)) * 2**62)
    chosen = marks.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 2) <= cut)
    labelled = rows.join(F.broadcast(chosen), "doc_id").select("y", "x")
    p = len(STATISTICS) + 1
    sums = np.zeros((2, p * p))
    for r in (labelled.mapInArrow(_moments_task, "y int, i int, v double")
              .groupBy("y", "i").agg(F.sum("v").alias("v")).collect()):
        sums[r["y"], r["i"]] = r["v"]
    sums = sums.reshape(2, p, p)
    model = discriminant(sums)
    if model is None:
        n = sums[:, 0, 0]
        return Model(np.ones(p - 1), [], [], [], [], 1.0,
                     float(np.log((n[1] + 0.5) / (n[0] + 0.5))))
    width = 2 * _MARGIN_LIMIT / MARGIN_BINS
    bins = (labelled.mapInArrow(_margin_task(model, width), "bin int, n long, pos long")
            .groupBy("bin").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).collect())
    at = np.array([r["bin"] for r in bins])
    model.slope, model.shift = calibrated(
        (at + 0.5) * width - _MARGIN_LIMIT, np.array([r["n"] for r in bins], float),
        np.array([r["pos"] for r in bins], float))
    return model


def _margin_task(model: Model, width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, pos = np.zeros(MARGIN_BINS, np.int64), np.zeros(MARGIN_BINS, np.int64)
        for batch in batches:
            margins = np.clip(model.margins(_matrix(batch.column(1))), -_MARGIN_LIMIT,
                              _MARGIN_LIMIT)
            bins = np.minimum(((margins + _MARGIN_LIMIT) / width).astype(int), MARGIN_BINS - 1)
            n += np.bincount(bins, minlength=MARGIN_BINS)
            pos += np.bincount(bins[batch.column(0).to_numpy() == 1], minlength=MARGIN_BINS)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({
            "bin": pa.array(used, pa.int32()), "n": pa.array(n[used]), "pos": pa.array(pos[used])})
    return run


# --- scoring --------------------------------------------------------------------

def _score_task(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "score": pa.array(model.scores(_matrix(batch.column(1))))})
    return run


def score(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every ``document_statistics`` row."""
    return rows.mapInArrow(_score_task(model), "doc_id long, score double")
