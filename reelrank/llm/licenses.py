"""License scans: winnowed template fingerprints, then banded alignment.

Texts are reduced to lower-case ASCII letters and digits. Each template's
hashes of ``GRAM`` characters are winnowed (the smallest of every window of
``WINDOW``) into an inverted index; a document looks up all its hashes, so
any stretch of WINDOW + GRAM - 1 characters it shares with a template is a
candidate. Hits near one diagonal, a tenth of the template's fingerprints at
least, are one candidate place, which a banded alignment compares with the
template: matched coverage and span.

Cases: null and empty texts match nothing; templates shorter than a gram are
an error; rows with equal or null ids are independent; an empty table gives
no rows; extra columns are ignored; several places of one template are
several rows; of overlapping places, of whichever template, the one with the
most matched characters stays (then the higher coverage).
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelrank.llm.license_texts import NOTICES, TEXTS

GRAM, WINDOW, BAND, LEAST_COVERAGE = 8, 6, 12, 0.8
# Share of a template's fingerprints that must stand near one diagonal for the
# place to be a candidate.
LEAST_SHARED = 0.1
TEMPLATES: dict[str, str] = {**NOTICES, **TEXTS}
_FOLD = np.zeros(256, np.uint8)
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    _FOLD[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _FOLD[_c] = _c + 32


def reduced(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(kept characters, their byte offsets)."""
    folded = _FOLD[np.frombuffer(data, np.uint8)]
    at = np.flatnonzero(folded)
    return folded[at], at


def gram_hashes(chars: np.ndarray) -> np.ndarray:
    """One mixed 64-bit number per gram: its eight characters, exactly."""
    n = len(chars) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    packed = np.lib.stride_tricks.sliding_window_view(chars, GRAM)
    h = np.ascontiguousarray(packed).view("<u8").reshape(-1)
    return h * np.uint64(0x9E3779B97F4A7C15)


def winnow(h: np.ndarray) -> list[int]:
    """Positions of the smallest hash of every window, the rightmost of equals."""
    if len(h) <= WINDOW:
        return [len(h) - 1 - int(np.argmin(h[::-1]))] if len(h) else []
    out: list[int] = []
    for i in range(len(h) - WINDOW + 1):
        p = i + WINDOW - 1 - int(np.argmin(h[i:i + WINDOW][::-1]))
        if not out or out[-1] != p:
            out.append(p)
    return out


def align(template: np.ndarray, chars: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(matched, first, last + 1) of a longest-common-subsequence alignment
    in which template[i] meets chars[i + shift - BAND .. i + shift + BAND].
    Where the template stands there as it is, nothing needs aligning."""
    size = len(template)
    if shift >= 0 and np.array_equal(template, chars[shift:shift + size]):
        return size, shift, shift + size
    width = 2 * BAND + 1
    # the characters of the whole band, 0 outside the text
    band = np.zeros(size + width, np.uint8)
    lo, hi = max(0, BAND - shift), min(size + width, len(chars) + BAND - shift)
    if lo < hi:
        band[lo:hi] = chars[lo + shift - BAND:hi + shift - BAND]
    # [k]: best of the characters up to i + shift - BAND + k; a path carries
    # its first and last place with its score, in one number
    place = np.arange(width)
    score, first, last = np.zeros(width, np.int64), np.full(width, -1), np.full(width, -1)
    for i, c in enumerate(template.tolist()):
        up = np.concatenate([score[1:], score[-1:]])
        hit = band[i:i + width] == c
        matched = np.where(hit, score + 1, -1)
        best = np.maximum(up, matched)
        # along the row the best so far goes on; of equals the earliest
        run = np.maximum.accumulate(best)
        fresh = np.concatenate([[True], best[1:] > run[:-1]])
        source = np.maximum.accumulate(np.where(fresh, place, 0))
        taken = matched > up
        above = np.minimum(place + 1, width - 1)
        begin = np.where(taken, np.where(first >= 0, first, i + place), first[above])
        end = np.where(taken, i + place + 1, last[above])
        score, first, last = run, begin[source], end[source]
    k = int(np.argmax(score))
    offset = shift - BAND
    if first[k] < 0:
        return 0, -1, -1
    return int(score[k]), int(first[k]) + offset, int(last[k]) + offset


class Index:
    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.chars, self.sizes, hashes, owners, places = [], [], [], [], []
        for t, name in enumerate(self.names):
            chars, _ = reduced(templates[name].encode())
            h = gram_hashes(chars)
            if not len(h):
                raise ValueError(f"template {name!r} is too short")
            self.chars.append(chars)
            picked = winnow(h)
            self.sizes.append(len(picked))
            for p in picked:
                hashes.append(h[p])
                owners.append(t)
                places.append(p)
        order = np.argsort(np.array(hashes, np.uint64), kind="stable")
        self.hashes = np.array(hashes, np.uint64)[order]
        self.owners, self.places = np.array(owners)[order], np.array(places)[order]
        self._aligned: dict[tuple, tuple[int, int, int]] = {}
        self._low = np.zeros(1 << 16, bool)  # a quick no for most grams
        self._low[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def _align(self, t: int, chars: np.ndarray, shift: int) -> tuple[int, int, int]:
        """``align``, remembered by what stands in the band: notices that
        repeat are compared once."""
        lo, hi = shift - BAND, shift + len(self.chars[t]) + BAND
        key = t, min(lo, 0), chars[max(lo, 0):max(hi, 0)].tobytes()
        found = self._aligned.get(key)
        if found is None:
            if len(self._aligned) >= 20_000:
                self._aligned.clear()
            matched, a, b = align(self.chars[t], chars, shift)
            found = self._aligned[key] = matched, a - shift, b - shift
        matched, a, b = found
        return matched, a + shift, b + shift

    def scan(self, data: bytes) -> list[tuple[str, int, int, float, int]]:
        """(name, start, end, coverage, matched): byte offsets of ``data``."""
        chars, at = reduced(data)
        h = gram_hashes(chars)
        if not len(h):
            return []
        maybe = np.flatnonzero(self._low[(h >> np.uint64(48)).astype(np.int64)])
        lo = np.searchsorted(self.hashes, h[maybe], "left")
        hi = np.searchsorted(self.hashes, h[maybe], "right")
        hits: dict[int, list[int]] = {}
        for p, a, b in zip(maybe[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
            for e in range(a, b):
                hits.setdefault(int(self.owners[e]), []).append(p - int(self.places[e]))
        found = []
        for t, shifts in hits.items():
            shifts.sort()
            group = [shifts[0]]
            for s in [*shifts[1:], None]:
                if s is not None and s - group[-1] <= BAND // 2 and s - group[0] <= BAND:
                    group.append(s)
                    continue
                if len(group) < LEAST_SHARED * self.sizes[t]:
                    group = [s]
                    continue
                matched, a, b = self._align(t, chars, group[len(group) // 2])
                coverage = matched / len(self.chars[t])
                if coverage >= LEAST_COVERAGE and b - a <= 1.25 * len(self.chars[t]) + BAND:
                    found.append((self.names[t], int(at[a]), int(at[b - 1]) + 1, coverage, matched))
                group = [s]
        found.sort(key=lambda f: (-f[4], -f[3], f[1], f[0]))
        # kept places lie apart: only the neighbours of a place can overlap it
        kept: list[tuple] = []
        starts: list[int] = []
        for f in found:
            i = bisect.bisect_left(starts, f[2])
            if i == 0 or kept[i - 1][2] <= f[1]:
                starts.insert(i, f[1])
                kept.insert(i, f)
        return kept


def _scan_task(templates: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for batch in batches:
            rows = [(i, *f) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for f in index.scan(t)]
            cols = list(zip(*rows)) if rows else [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["doc_id", "license", "start", "end", "coverage", "matched"])
    return run


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id",
         text: str = "text") -> DataFrame:
    """doc_id, license, start, end (bytes of the UTF-8 text), coverage (share
    of the template matched), matched: one row per place. No shuffle."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    return rows.mapInArrow(
        _scan_task(templates or TEMPLATES),
        "doc_id long, license string, start long, end long, coverage double, matched long")
