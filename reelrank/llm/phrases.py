"""Phrase collocations by Toivonen's mining.

A sample of the documents, mined level by level, proposes the phrases
(contiguous words of one piece of text) that are frequent there at a lowered
threshold. One pass over all documents then counts, exactly, the proposed
phrases and their negative border: every phrase that occurs and whose two
parts without its last and without its first word are proposed (of single
words: every word). A border phrase that turns out frequent is a failure of
the sample. A phrase that is frequent but not counted yet must contain one,
as all its parts are frequent too, so an expansion pass counts every longer
phrase around a failure whose parts may be frequent; after it nothing can be
missing.

That pass counts 61-bit hashes. The phrases of all hashes that are frequent,
and the longer ones around failures, are counted by their text in the
expansion pass, so equal hashes of different phrases cost a little work and
change no count. Sets of hashes reach the tasks as bitmaps of at most
``MAX_BITS`` bits, whose collisions are harmless in the same way: results are
exact at any size and what is broadcast stays bounded. Tasks count in chunks
and send one row per distinct phrase and chunk.

Cases: null and empty texts have no words; a null language counts as
``und``; rows with equal or null ids and repeated rows count each; a text may
be of any length; of equal scores the larger count, then the smaller phrase
in UTF-8 byte order ranks first; a language without a candidate gives no
rows, as does an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from reelrank.llm.common import skew_lookup, text_bytes, written

MAX_WORDS, LEAST, TOP = 5, 100, 2000
# share of the documents in the sample, and what share of the threshold to be
# expected there a phrase must reach
SAMPLE_SHARE, SAMPLE_LEAST = 1 / 16, 0.64
# bits of a bitmap for each phrase in it, and at most
BITS_EACH, MAX_BITS = 32, 2**28
# tokens counted at a time (fewer than 2^21 with one slice more), bytes of a slice
CHUNK_TOKENS, SLICE_BYTES = 600_000, 1_000_000
_ROWS, _HELD = 50_000, 400_000

_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _BREAKS,
    b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(_BREAKS))


_TIMES, _MORE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd


def word_hashes(langs: list[bytes], words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(a + b"\0" + w) for a, w in zip(langs, words)), np.uint64, len(words))


def longer_hash(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase with one word more, of the hashes of both."""
    x = (phrase * _TIMES + word) * _MORE
    return x ^ (x >> np.uint64(29))


class Bitmap:
    """A set of phrase hashes: no false negatives."""

    def __init__(self, bits: int, bitmap: np.ndarray | None = None):
        self.shift = 64 - bits.bit_length() + 1
        self.bitmap = np.zeros(bits // 8, np.uint8) if bitmap is None else bitmap

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(self.shift)
        return (self.bitmap[(at >> np.uint64(3)).astype(np.int64)]
                >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def add(self, keys: DataFrame) -> None:
        """The hashes of (key) rows; what is collected is the bitmap's blocks."""
        at = F.shiftrightunsigned("key", self.shift)
        blocks = (keys.select(at.alias("at")).groupBy(F.shiftright("at", 15).alias("block"))
                  .agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(32767)).alias("map")))
        for r in blocks.collect():
            part = slice(r["block"] * 4096, (r["block"] + 1) * 4096)
            self.bitmap[part] |= np.frombuffer(r["map"], np.uint8)[:len(self.bitmap[part])]


def bits_for(phrases: int) -> int:
    bits = 2**20
    while bits < min(MAX_BITS, BITS_EACH * phrases):
        bits *= 2
    return bits


def _outside_task(proposed) -> Callable:
    """The keys that are not in a broadcast bitmap and can be part of a longer
    phrase."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            short = keys & np.uint64(7) < MAX_WORDS
            yield batch.filter(pa.array(short & ~proposed.value.has(keys)))
    return run


def tokens_of(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text, A-Z lower-cased, with a line feed between pieces and
    after the last, in bounded lists."""
    flat = data.translate(_TABLE).replace(b"\n", b" \n ") + b" \n"
    at = 0
    while at < len(flat):
        end = flat.find(b" ", at + SLICE_BYTES)
        end = len(flat) if end < 0 else end
        if words := list(filter(None, flat[at:end].split(b" "))):
            yield words
        at = end


class _Chunk:
    """Token ids of a stretch of documents, and the phrases in them."""

    def __init__(self):
        self.next = count(1)  # 0 is the break between pieces
        self.index: dict[bytes, dict[bytes, int]] = {}
        self.parts: list[np.ndarray] = []
        self.stream: list[bytes] = []  # the tokens again, to cut phrases from
        self.begins: np.ndarray | None = None
        self.size = 0

    def add(self, lang: bytes, tokens: list[bytes]) -> None:
        index = self.index.get(lang)
        if index is None:
            index = self.index[lang] = defaultdict(self.next.__next__)
            index[b"\n"] = 0
        self.parts.append(np.fromiter(map(index.__getitem__, tokens), np.int64, len(tokens)))
        self.stream.append(b" ".join(tokens))
        self.size += len(tokens)

    def _words(self) -> tuple[np.ndarray, list[bytes], np.ndarray, list[bytes]]:
        """Token ids, and of each id its word and the place of its language."""
        at = np.concatenate(self.parts)
        self.parts.clear()
        n = next(self.next)
        names, lang_of = [b""] * n, np.zeros(n, np.int32)
        langs = list(self.index)
        for k, index in enumerate(self.index.values()):
            for w, i in index.items():
                if i:
                    names[i] = w
            lang_of[[i for i in index.values() if i]] = k
        self.index.clear()
        return at, names, lang_of, langs

    def phrases(self, proposed: Bitmap | None, own: int, level: int | None = None,
                failed: Bitmap | None = None) -> Iterator[tuple]:
        """(m, hashes, counts, place, first token, countable, language) of the
        phrases of m words that start among the first ``own`` tokens: of those
        that ``proposed`` makes countable, all or one level's; with ``failed``
        also the longer ones around its phrases (not countable)."""
        at, names, lang_of, langs = self._words()
        self.langs = langs
        n = len(names)
        hashes = np.zeros(n, np.uint64)
        hashes[1:] = word_hashes([langs[k] for k in lang_of[1:].tolist()], names[1:])
        del names
        counts, heads = np.bincount(at[:own], minlength=n), np.zeros(n, np.int64)
        heads[at[::-1]] = np.arange(len(at))[::-1]
        self.totals = np.bincount(lang_of[1:], weights=counts[1:], minlength=len(langs))
        if level in (None, 1):
            yield 1, hashes[1:], counts[1:], heads[1:], np.ones(n - 1, bool), lang_of[1:]
        if level == 1:
            return
        # of each phrase of the level: hash, hash of its last word, whether it
        # is countable and proposed, whether it holds a failure
        last, known = hashes, proposed.has(hashes)
        around = failed.has(hashes) if failed is not None else np.zeros(n, bool)
        known[0] = around[0] = False
        for m in range(2, MAX_WORDS + 1):
            alive = known | around
            starts = np.flatnonzero(alive[at[:-1]] & alive[at[1:]])
            if not len(starts):
                return
            # one sort of (first part, second part, place) packed in 63 bits
            packed = np.sort((at[starts] << 42) | (at[starts + 1] << 21) | starts)
            pair, place = packed >> 21, packed & (2**21 - 1)
            fresh = np.concatenate([[True], pair[1:] != pair[:-1]])
            ids = np.cumsum(fresh)
            heads = place[fresh]
            del packed, pair, fresh
            first, second = at[heads], at[heads + 1]
            countable = known[first] & known[second]
            hashes = np.concatenate([[np.uint64(0)], longer_hash(hashes[first], last[second])])
            last = np.concatenate([[np.uint64(0)], last[second]])
            lang_of = np.concatenate([[np.int32(0)], lang_of[first]])
            if level in (None, m):
                counts = np.bincount(ids[place < own], minlength=len(hashes))
                yield m, hashes[1:], counts[1:], heads, countable, lang_of[1:]
            if m in (MAX_WORDS, level):
                return
            at = np.zeros_like(at)
            at[place] = ids
            longer = around[first] | around[second]
            if failed is not None:
                longer |= countable & failed.has(hashes[1:])
            known = np.concatenate([[False], countable & proposed.has(hashes[1:])])
            around = np.concatenate([[False], longer])

    def texts(self, m: int, heads: np.ndarray) -> list[bytes]:
        """The phrases of m words that start at the given tokens."""
        if self.begins is None:
            stream = b" ".join(self.stream)
            self.stream = [stream]
            gaps = np.flatnonzero(np.frombuffer(stream, np.uint8) == 32)
            self.begins = np.concatenate([[0], gaps + 1])
            self.ends = np.concatenate([gaps, [len(stream)]])
        stream = self.stream[0]
        cut = zip(self.begins[heads].tolist(), self.ends[heads + m - 1].tolist())
        return [stream[x:y] for x, y in cut]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Chunk, int]]:
    """Chunks of the (lang, t) rows, each with the number of tokens at which
    its own phrases start."""
    chunk = _Chunk()
    for batch in batches:
        for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tail = []
            for tokens in tokens_of(t):
                chunk.add(lang, tokens)
                # phrases that start in the last words of an unended text
                # belong to the next chunk
                ended = tokens[-1] == b"\n"
                tail = [] if ended else (tail + tokens[1 - MAX_WORDS:])[1 - MAX_WORDS:]
                if chunk.size >= CHUNK_TOKENS:
                    yield chunk, chunk.size - len(tail)
                    chunk = _Chunk()
                    if tail:
                        chunk.add(lang, tail)
    if chunk.size:
        yield chunk, chunk.size


def _hash_task(proposed=None, level: int | None = None) -> Callable:
    """(key, c) per distinct phrase and chunk: the hash, its last three bits
    the number of words. The bitmap is broadcast."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if proposed is None else proposed.value
        for chunk, own in _chunks(batches):
            for m, hashes, counts, *_ in chunk.phrases(bitmap, own, level):
                some = counts > 0
                keys = (hashes[some] & ~np.uint64(7)) | np.uint64(m)
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(keys.view(np.int64)), "c": pa.array(counts[some], pa.int64())})
    return run


def _text_task(proposed, frequent, failed) -> Callable:
    """(lang, phrase, c) per distinct phrase and chunk: of countable ones those
    in ``frequent``, of others those around failures; each language's words
    come as an empty phrase. The bitmaps are broadcast."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for lang, counts in held.items():
                phrases = list(counts)
                for i in range(0, len(phrases), _ROWS):
                    some = phrases[i:i + _ROWS]
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([lang] * len(some), pa.binary()),
                        "phrase": pa.array(some, pa.binary()),
                        "c": pa.array([counts[p] for p in some], pa.int64())})
            held.clear()

        held: dict[bytes, Counter] = {}  # what several chunks repeat leaves once
        for chunk, own in _chunks(batches):
            for m, hashes, counts, heads, countable, lang_of in chunk.phrases(
                    proposed.value, own, failed=failed.value):
                out = np.flatnonzero((counts > 0) & (~countable | frequent.value.has(hashes)))
                for k, lang in enumerate(chunk.langs):
                    some = out[lang_of[out] == k] if len(chunk.langs) > 1 else out
                    into = held.setdefault(lang, Counter())
                    for i in range(0, len(some), _ROWS):
                        part = some[i:i + _ROWS]
                        for p, c in zip(chunk.texts(m, heads[part]), counts[part].tolist()):
                            into[p] += c
            for lang, c in zip(chunk.langs, chunk.totals.tolist()):
                held.setdefault(lang, Counter())[b""] += int(c)
            if sum(map(len, held.values())) > _HELD:
                yield from rows()
        yield from rows()
    return run


def _frequent_keys(texts: DataFrame, least: int, proposed, level: int | None = None) -> DataFrame:
    rows = texts.mapInArrow(_hash_task(proposed, level), "key long, c long")
    return written(rows.groupBy("key").agg(F.sum("c").alias("f")).where(F.col("f") >= least)
                   .select("key"), "phrase-keys")


def _bitmap(tables: list[DataFrame]) -> Bitmap:
    bitmap = Bitmap(bits_for(sum(t.count() for t in tables)))
    for t in tables:
        bitmap.add(t)
    return bitmap


def propose(sample: DataFrame, least: int) -> Bitmap:
    """The phrases with at least ``least`` occurrences in ``sample`` (lang, t),
    level by level: each level counts what the one before makes countable."""
    share, found = sample.sparkSession.sparkContext.broadcast, []
    for level in range(1, MAX_WORDS):
        proposed = share(_bitmap(found)) if found else None
        found.append(_frequent_keys(sample, least, proposed, level))
        if proposed is not None:
            proposed.destroy()
        if found[-1].isEmpty():
            break
    return _bitmap(found)


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                     lang: str = "lang", least: int = LEAST, share: float = SAMPLE_SHARE
                     ) -> tuple[DataFrame, DataFrame, int]:
    """Every phrase with at least ``least`` occurrences (lang, phrase, f), the
    words per language (lang, n), and the number of border failures."""
    send = docs.sparkSession.sparkContext.broadcast
    language = F.coalesce(F.col(lang).cast("string"), F.lit("und")).cast("binary").alias("lang")
    texts = docs.select(language, text_bytes(text).alias("t"))
    drawn = F.pmod(F.xxhash64(F.col(id_col).cast("string"), text_bytes(text)), F.lit(2**20))
    sample = written(docs.where(drawn < int(share * 2**20))
                     .select(language, text_bytes(text).alias("t")), "phrase-sample")
    proposed = send(propose(sample, max(2, int(least * share * SAMPLE_LEAST))))
    keys = _frequent_keys(texts, least, proposed)
    failures = written(keys.mapInArrow(_outside_task(proposed), "key long"), "phrase-failures")
    frequent, failed = send(_bitmap([keys])), send(_bitmap([failures]))
    rows = texts.mapInArrow(_text_task(proposed, frequent, failed),
                            "lang binary, phrase binary, c long")
    counted = written(rows.groupBy("lang", "phrase").agg(F.sum("c").alias("f")).where(
        (F.col("f") >= least) | (F.length("phrase") == 0)), "phrase-counts")
    for bitmap in (proposed, frequent, failed):
        bitmap.destroy()
    return (counted.where(F.length("phrase") > 0),
            counted.where(F.length("phrase") == 0).select("lang", F.col("f").alias("n")),
            failures.count())


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of every candidate: at the cut of the
    lowest score, without those inside a longer one that is as frequent."""
    found = found.select(F.col("lang").cast("string").alias("lang"),
                         F.col("phrase").cast("string").alias("phrase"), "f")
    words = F.split("phrase", " ")
    candidates = found.select("lang", "phrase", F.col("f").alias("a"), words.alias("w")).where(
        F.size("w") >= 2)
    # a longer candidate as frequent as a part of it is so through one that
    # is one word longer than the part
    m = F.size("w")
    parts = (candidates.where(m >= 3)
             .select("lang", "a", F.explode(F.array(
                 F.array_join(F.slice("w", 1, m - 1), " "),
                 F.array_join(F.slice("w", 2, m - 1), " "))).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    left = (candidates.join(parts, ["lang", "phrase"], "left")
            .where("longer is null or longer < a").drop("longer"))
    cuts = left.select("lang", "phrase", "a", "w", F.explode(F.sequence(
        F.lit(1), m - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, m - F.col("k")), " ").alias("rest"))
    cuts = written(cuts, "phrase-cuts")

    def looked_up(rows, part, name):
        sizes = rows.groupBy("lang", part).agg(F.count("*").alias("_size"))
        groups = sizes.join(found.select("lang", F.col("phrase").alias(part),
                                         F.col("f").alias(name)), ["lang", part])
        return skew_lookup(rows, groups, ["lang", part], "_size", ["phrase", "k"]).drop("_size")

    cuts = looked_up(looked_up(cuts, "first", "l"), "rest", "r")
    sizes = cuts.groupBy("lang").agg(F.count("*").alias("_size"))
    n = sizes.join(totals.select(F.col("lang").cast("string").alias("lang"), "n"), "lang")
    cuts = skew_lookup(cuts, n, ["lang"], "_size", ["phrase", "k"])
    score = F.expr("cast(1000 * a as decimal(19,0)) * cast(n as decimal(19,0)) "
                   "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return (cuts.groupBy("lang", "phrase", "a", "n").agg(best)
            .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))


def collocations(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
                 least: int = LEAST, top: int = TOP, share: float = SAMPLE_SHARE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top``."""
    found, totals, _ = frequent_phrases(docs, id_col, text, lang, least, share)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored(found, totals).withColumn("rank", F.row_number().over(order).cast("long"))
            .where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
