"""Spelling variants by exact-half searches in FM-indexes of the vocabulary.

Two words at one edit agree on the first or on the last half of either of
them. A search therefore matches one half of a word exactly and extends
across the other, allowing one error, once to the right from the first half
and once to the left from the last. Both run on suffix-rank intervals of an
FM-index over delimited words (of the words themselves for one direction, of
the reversed words for the other).

The vocabulary grows with the corpus, so it is indexed in parts: a word goes
to the part of each half that a word one edit away can share with it (by
length and half), where it also searches for its own. Halves that too many
words share are refined: the remaining stretch is cut in two, and the words
part by the exact half of that (a prefix and a suffix are then fixed), until
no group is large. Every pair is found in the one group of the error's
leftmost place, and only counts and the best partner leave a task.

Cases: null and empty texts have no words; a null id is written as empty
text before the colon; rows with equal or null ids and repeated rows count
each; words may be of any length; among near words of equal count the
smallest in code-point order is the form; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelrank.llm.common import skew_lookup, text_bytes, written

SHORTEST, LEAST = 5, 3
# every such share of (document, run) pairs loses a character, by its crc32
DELETE_EVERY = 97
# rows of one index, rows from which a group is refined (at least the 7,833
# strings of up to two letters), queries searched side by side
PART_ROWS, HOT_ROWS, BLOCK = 40_000, 20_000, 4096

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


# --- the vocabulary -------------------------------------------------------------

def words_of(doc_id, data: bytes, delete_every: int = DELETE_EVERY) -> Counter:
    """The words of one text with their occurrences."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, c in Counter(_RUN.findall(data.lower().decode("utf-8", "replace"))).items():
        h = zlib.crc32(run.encode(), start)
        if not h % delete_every:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= SHORTEST:
            out[run] += c
    return out


def _words_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(counts):
        return pa.RecordBatch.from_pydict({
            "word": pa.array(list(counts), pa.string()),
            "n": pa.array(list(counts.values()), pa.int64())})

    counts: Counter = Counter()
    for batch in batches:
        for doc_id, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.update(words_of(doc_id, t))
            if len(counts) > 400_000:
                yield flush(counts)
                counts = Counter()
    yield flush(counts)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
               least: int = LEAST) -> DataFrame:
    """(word, n) with n >= least, written."""
    rows = docs.select(F.col(id_col).cast("long"), text_bytes(text))
    return written(rows.mapInArrow(_words_task, "word string, n long").groupBy("word")
                   .agg(F.sum("n").alias("n")).where(F.col("n") >= least), "variant-words")


# --- the index ------------------------------------------------------------------

class SuffixRanks:
    """FM-index of distinct strings, delimited on both sides. An interval
    [lo, hi) of suffix ranks stands for a stretch read so far, and reading on
    is to the right; the suffixes are those of the reversed strings."""

    def __init__(self, strings: list[str]):
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        self.count, size = len(strings), int(lengths.sum()) + len(strings)
        ends = np.cumsum(lengths + 1) - 1  # places of the delimiters (0)
        points = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
        self.alphabet, dense = np.unique(points, return_inverse=True)
        codes = np.zeros(size, np.int64)
        inner = np.ones(size, bool)
        inner[ends] = False
        # reversed: the j-th character of a string lies as far before its end
        firsts = np.repeat(ends - lengths, lengths)
        place = np.flatnonzero(inner)
        codes[np.repeat(ends, lengths) - 1 - (place - firsts)] = dense + 1
        string_of = np.repeat(np.arange(len(strings)), lengths + 1)
        ranks = self._suffix_order(codes, ends, int(lengths.max(initial=0)))
        order = np.argsort(ranks, kind="stable")  # equal suffixes: by string
        before = np.concatenate([[0], codes[:-1]])  # at a start: the delimiter
        self.size, self.bwt = size, before[order]
        self.string = string_of[order]
        by_symbol = np.argsort(self.bwt, kind="stable")
        self._keys = self.bwt[by_symbol] * size + by_symbol
        self._starts = by_symbol[:self.count]

    def _suffix_order(self, codes: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
        """Dense ranks of the suffixes up to their delimiter, by doubling the
        compared length from as many symbols as 62 bits hold."""
        bits = max(1, len(self.alphabet).bit_length())
        step, n = 62 // bits, len(codes)
        key, alive = np.zeros(n, np.int64), np.ones(n, bool)
        for t in range(step):
            symbol = np.zeros(n, np.int64)
            symbol[:n - t] = codes[t:] if t < n else 0
            alive &= symbol > 0
            key = (key << bits) | np.where(alive, symbol, 0)
        left = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(n)  # symbols to the end
        while True:
            _, ranks = np.unique(key, return_inverse=True)
            if step >= longest:
                return ranks
            more = np.zeros(n, np.int64)
            far = np.flatnonzero(left > step)
            more[far] = ranks[far + step] + 1
            key = ranks * (n + 2) + more
            step *= 2

    def codes_of(self, text: str) -> np.ndarray:
        """Symbols of ``text``; all its characters must be in the index."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return np.searchsorted(self.alphabet, points) + 1

    def read(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """An interval's bound after reading ``symbol``."""
        return np.searchsorted(self._keys, symbol * self.size + at)

    def next_symbols(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval's number, symbol) of every symbol that can be read next."""
        n, sigma = hi - lo, len(self.alphabet)
        small = np.flatnonzero(n <= 2 * sigma)
        which = np.repeat(small, n[small])
        within = np.arange(len(which)) - np.repeat(np.cumsum(n[small]) - n[small], n[small])
        pairs = np.unique(which * (sigma + 1) + self.bwt[lo[which] + within])
        large = np.flatnonzero(n > 2 * sigma)
        every = (np.repeat(large, sigma) * (sigma + 1)
                 + np.tile(np.arange(1, sigma + 1), len(large)))
        pairs = np.concatenate([pairs, every])
        which, symbol = pairs // (sigma + 1), pairs % (sigma + 1)
        return which[symbol > 0], symbol[symbol > 0]

    def near(self, texts: list[str], first: np.ndarray, last: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
        """(text, string) pairs at exactly one insertion, deletion or
        replacement whose place is among the symbols first..last of the text;
        what lies outside agrees."""
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        start = np.cumsum(length) - length
        flat = self.codes_of("".join(texts))
        symbol_at = lambda q, p: flat[start[q] + p]
        q = np.arange(len(texts))
        lo, hi = np.zeros(len(texts), np.int64), np.full(len(texts), self.count)
        p = np.zeros(len(texts), np.int64)
        while (a := np.flatnonzero((p < first) & (hi > lo))).size:  # the exact half
            c = symbol_at(a, p[a])
            lo[a], hi[a] = self.read(c, lo[a]), self.read(c, hi[a])
            p[a] += 1
        wrong = []  # states with their one error behind them
        keep = np.flatnonzero(hi > lo + 1)  # one string alone: the text itself or none
        q, p, lo, hi = q[keep], p[keep], lo[keep], hi[keep]
        while len(q):
            a, c = self.next_symbols(lo, hi)
            l2, h2 = self.read(c, lo[a]), self.read(c, hi[a])
            some = h2 > l2
            a, c, l2, h2 = a[some], c[some], l2[some], h2[some]
            inside = p < last[q]
            wrong.append((q[a], p[a], l2, h2))  # inserted
            d = np.flatnonzero(inside)
            wrong.append((q[d], p[d] + 1, lo[d], hi[d]))  # deleted
            due = np.zeros(len(q), np.int64)
            due[d] = symbol_at(q[d], p[d])
            other = inside[a] & (c != due[a])
            wrong.append((q[a[other]], p[a[other]] + 1, l2[other], h2[other]))  # replaced
            on = inside[a] & (c == due[a]) & (h2 > l2 + 1)
            q, p, lo, hi = q[a[on]], p[a[on]] + 1, l2[on], h2[on]
        if not wrong:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, p, lo, hi = (np.concatenate(x) for x in zip(*wrong))
        found = []
        while len(q):  # the rest agrees
            done = p == length[q]
            x, y = (np.searchsorted(self._starts, b[done]) for b in (lo, hi))
            ended = y > x
            found.append(q[done][ended] * self.count + self.string[self._starts[x[ended]]])
            q, p, lo, hi = q[~done], p[~done], lo[~done], hi[~done]
            c = symbol_at(q, p)
            lo, hi = self.read(c, lo), self.read(c, hi)
            some = hi > lo
            q, p, lo, hi = q[some], p[some] + 1, lo[some], hi[some]
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return pairs // self.count, pairs % self.count


# --- parts ----------------------------------------------------------------------

def half_rows(words: DataFrame) -> DataFrame:
    """A row for each half under which a word (word, n) is found: side (1:
    reversed), q (length of the searching word), i and j (symbols that agree
    at the start and at the end), key."""
    length = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(*[
        F.struct(F.lit(side).alias("side"), (length + d).cast("int").alias("q"))
        for side in (0, 1) for d in (-1, 0, 1)])).alias("h")).select("word", "n", "h.*")
    half = F.floor(F.col("q") / 2).cast("int")
    rows = rows.where(F.col("q") >= SHORTEST).withColumns({
        "i": F.when(F.col("side") == 0, half).otherwise(F.col("q") - half),
        "j": F.lit(0)})
    return _keyed(rows)


def _keyed(rows: DataFrame) -> DataFrame:
    s = F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word"))
    end = F.when(F.col("j") > 0, F.expr("right(s, j)")).otherwise("")
    return rows.withColumn("s", s).withColumn(
        "key", F.xxhash64("side", "q", "i", "j", F.expr("left(s, i)"), end)).drop("s")


def refined(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` with every group of more than ``hot_rows`` parted by a longer
    agreeing start, or the same start and a longer agreeing end."""
    m = F.col("q") - F.col("i") - F.col("j")
    half = F.floor(m / 2).cast("int")
    while True:
        rows = written(rows, "variant-halves")
        hot = written(rows.where(m > 1).groupBy("key").agg(F.count("*").alias("size"))
                      .where(F.col("size") > hot_rows), "variant-hot")
        if hot.isEmpty():
            return rows
        marked = skew_lookup(rows, hot, ["key"], "size", ["word"])
        deeper = (marked.where(F.col("size").isNotNull() & (m > 1)).select(
            "word", "n", "side", "q", F.explode(F.array(
                F.struct((F.col("i") + half).alias("i"), F.col("j").alias("j")),
                F.struct(F.col("i").alias("i"), (F.col("j") + m - half).alias("j")))).alias("h"))
            .select("word", "n", "side", "q", "h.*"))
        rows = marked.where(F.col("size").isNull() | (m <= 1)).drop("size").unionByName(
            _keyed(deeper))


def search_part(side: int, words: list[str], n: np.ndarray, q: np.ndarray, i: np.ndarray,
                j: np.ndarray) -> list[tuple[str, int, int, str]]:
    """(word, near words found here, largest count among them, its word) of
    the searching rows of one part."""
    strings, at = np.unique(np.array(words, object), return_inverse=True)
    counts = np.zeros(len(strings), np.int64)
    counts[at] = n
    plain = strings.tolist()  # in code-point order
    turned = [w[::-1] for w in plain] if side else plain
    index = SuffixRanks(turned)
    own = np.flatnonzero(q == np.fromiter(map(len, words), np.int64, len(words)))
    out = []
    for b in range(0, len(own), BLOCK):
        rows = own[b:b + BLOCK]
        texts = [turned[x] for x in at[rows]]
        first, last = i[rows], q[rows] - j[rows]
        found = {}
        for t, x in zip(*(v.tolist() for v in index.near(texts, first, last))):
            text, other = texts[t], turned[x]
            # pairs that the other direction, or the group of an earlier place
            # of the error, finds too belong there
            if side and other.endswith(text[-(len(text) // 2):]):
                continue
            if last[t] < len(text) and other.startswith(text[:last[t]]):
                continue
            c, best, name = found.get(t, (0, 0, -1))
            if counts[x] > best:  # strings come in no order, equal counts below
                best, name = counts[x], x
            elif counts[x] == best and x < name:
                name = x
            found[t] = (c + 1, best, name)
        out += [(plain[at[rows[t]]], c, int(best), plain[name])
                for t, (c, best, name) in found.items()]
    return out


def _search_task(table: pa.Table) -> pa.Table:
    side = table.column("side")[0].as_py()
    numbers = [table.column(c).to_numpy().astype(np.int64) for c in ("n", "q", "i", "j")]
    found = search_part(side, table.column("word").to_pylist(), *numbers)
    columns = list(zip(*found)) or [[], [], [], []]
    return pa.table({"word": pa.array(columns[0], pa.string()),
                     "n_near": pa.array(columns[1], pa.int64()),
                     "best_n": pa.array(columns[2], pa.int64()),
                     "best": pa.array(columns[3], pa.string())})


def near_words(words: DataFrame, part_rows: int = PART_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """word, n_near, best_n, best (near word of the largest count) of every
    word (word, n) that has a near word."""
    rows = refined(half_rows(words), hot_rows)
    parts = max(1, -(-rows.count() // part_rows))
    part = F.pmod("key", F.lit(parts)) * 2 + F.col("side")
    found = (rows.withColumn("part", part).repartition(parts, "part").groupBy("part")
             .applyInArrow(_search_task, "word string, n_near long, best_n long, best string"))
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.minus")).alias("best_n"), "b.best")


# --- groups ---------------------------------------------------------------------

def roots(forms: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(word, root) of every (word, form): the last word that following forms
    reaches. Each round doubles the steps taken."""
    current = forms.select("word", F.col("form").alias("root"))
    for _ in range(max_rounds):
        current = written(current, "variant-roots")
        groups = (current.groupBy("root").agg(F.count("*").alias("size"))
                  .join(current.select(F.col("word").alias("root"), F.col("root").alias("next")),
                        "root"))
        if groups.isEmpty():
            return current
        current = skew_lookup(current, groups, ["root"], "size", ["word"]).select(
            "word", F.coalesce("next", "root").alias("root"))
    raise RuntimeError("forms go round in a circle")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                      least: int = LEAST) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the corpus."""
    words = vocabulary(docs, id_col, text, least)
    rows = words.join(near_words(words), "word", "left")
    chosen = F.col("best_n") >= 2 * F.col("n")
    rows = written(rows.select(
        "word", F.when(chosen, F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("best_n")).alias("form_n")), "variants")
    last = roots(rows.where("form is not null").select("word", "form"))
    return rows.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
