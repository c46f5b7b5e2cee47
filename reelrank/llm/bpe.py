"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling hash of the last 32 bytes meets a mask, so
equal passages give equal chunks wherever they stand. A task encodes a chunk
at its first meeting and reuses its tokens at every further one; chunks that
save the most bytes over all documents are kept to its end, others as long as
there is room. A cut may fall inside a word: each join is then repaired by
encoding the fragments on both sides together until the tokens agree.

Cases: null text is an empty text (no tokens, empty decoded text); rows
with equal or null ids are independent; extra columns are ignored; a text
without a cut is one chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelrank.llm.bpe_words import load
from reelrank.llm.common import text_bytes

# A cut about every 512 bytes; no chunk under 64 or over 4096 bytes.
CUT_MASK, MIN_CHUNK, MAX_CHUNK = 0x1FF, 64, 4096
# Chunks that a task never forgets: at most this many (so at most 8 MB of
# text), those that save the most bytes first; and the text of other chunks
# that it holds at a time. A forgotten chunk is encoded again, to the same
# tokens.
REUSED_CHUNKS, HELD_BYTES = 2048, 16 << 20
_GEAR = np.random.default_rng(20240101).integers(0, 2**32, 256, dtype=np.uint32)
# Text handled at a time inside a task.
_BATCH_BYTES = 4 << 20


def cuts(data: bytes) -> list[int]:
    """End offsets of the content-defined chunks of ``data``."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):  # doubling: the hash of the last 32 bytes
        shifted = h[:-step] << np.uint32(step)
        h = h.copy()
        h[step:] += shifted
    # the high bits depend on all 32 bytes
    at = (np.flatnonzero((h >> np.uint32(16)) & np.uint32(CUT_MASK) == 0) + 1).tolist()
    out, last = [], 0
    for p in [*at, n]:
        while p - last > MAX_CHUNK:
            last += MAX_CHUNK
            out.append(last)
        if p - last >= MIN_CHUNK or p == n and p > last:
            out.append(p)
            last = p
    return out


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, size, n, chunk): each chunk of a batch once, with its count; the
    text only where the batch itself holds it twice or for a hash pick."""
    for batch in batches:
        seen: dict[bytes, int] = {}
        for data in batch.column(0).to_pylist():
            for c in chunks(data):
                k = hashlib.blake2b(c, digest_size=16).digest()
                seen[k] = seen.get(k, (0, len(c)))[0] + 1, len(c)
        yield pa.RecordBatch.from_pydict({
            "h": pa.array(list(seen), pa.binary()),
            "n": pa.array([v[0] for v in seen.values()], pa.int64()),
            "size": pa.array([v[1] for v in seen.values()], pa.int64())})


def shared_chunks(docs: DataFrame, text: str = "text",
                  limit: int = REUSED_CHUNKS) -> DataFrame:
    """(h, n, size): the chunks that stand in more than one place, the
    ``limit`` of them that save the most bytes."""
    found = docs.select(text_bytes(text).alias("t")).mapInArrow(
        _chunk_rows, "h binary, n long, size long")
    return (found.groupBy("h").agg(F.sum("n").alias("n"), F.max("size").alias("size"))
            .where("n > 1")
            .orderBy(F.desc(F.expr("(n - 1) * size")), "h").limit(limit))


def _fragments(chunk: bytes) -> tuple[bytes, list[bytes] | None, bytes]:
    """Head fragment, inner words, tail fragment; a chunk without white space
    is all head (None)."""
    words = chunk.split()
    head = b"" if chunk[:1].isspace() or not words else words.pop(0)
    if len(head) == len(chunk):
        return head, None, b""
    tail = b"" if chunk[-1:].isspace() or not words else words.pop()
    return head, words, tail


def encode_chunks(encoder, found: dict) -> dict:
    """Of each chunk (by key) head fragment, ids and decoded text of its inner
    words, tail fragment."""
    pieces = {k: _fragments(c) for k, c in found.items()}
    get = encoder.words([w for _, words, _ in pieces.values() if words for w in words])
    out = {}
    for k, (head, words, tail) in pieces.items():
        if words is None:
            out[k] = head, None, None, b""
            continue
        values = [get[w] for w in words]
        out[k] = (head, b"".join([v[0] for v in values]),
                  b" ".join([v[1] for v in values if v[1]]), tail)
    return out


def cut_words(parts) -> list[bytes]:
    """The words that cuts have split, put together again."""
    out, open_word = [], b""
    for head, inner, _, tail in parts:
        open_word += head
        if inner is not None:
            out.append(open_word)
            open_word = tail
    return [w for w in (*out, open_word) if w]


def join_parts(encoded: dict, parts) -> tuple[bytes, bytes]:
    """The text's ids and decoded text. A word that a cut has split is
    encoded again from all its fragments (``encoded``: the value of each):
    white space bounds what can change, so beyond it the chunks' own tokens
    already agree."""
    ids, decoded, open_word = [], [], b""
    for head, inner, inner_text, tail in parts:
        open_word += head
        if inner is None:
            continue
        if open_word:
            value = encoded[open_word]
            ids.append(value[0])
            decoded.append(value[1])
        ids.append(inner)
        decoded.append(inner_text)
        open_word = tail
    if open_word:
        ids.append(encoded[open_word][0])
        decoded.append(encoded[open_word][1])
    return b"".join(ids), b" ".join([d for d in decoded if d])


class _Chunks:
    """The chunks a task has encoded, and how many bytes it has encoded and
    reused."""

    def __init__(self, encoder, wanted: frozenset):
        self.encoder, self.wanted = encoder, wanted
        self.kept: dict[bytes, tuple] = {}
        self.held, self.size = {}, 0
        self.encoded = self.reused = 0

    def parts(self, texts: list[bytes]) -> list[list[tuple]]:
        cut = [[(hashlib.blake2b(c, digest_size=16).digest(), c) for c in chunks(d)] for d in texts]
        fresh = {k: c for doc in cut for k, c in doc if k not in self.kept and k not in self.held}
        done = encode_chunks(self.encoder, fresh)
        new = sum(map(len, fresh.values()))
        self.encoded += new
        self.reused += sum(map(len, texts)) - new
        out = [[done.get(k) or self.kept.get(k) or self.held[k] for k, _ in doc] for doc in cut]
        self.kept.update((k, p) for k, p in done.items() if k in self.wanted)
        if self.size + new > HELD_BYTES:
            self.held, self.size = {}, 0
        self.held.update((k, p) for k, p in done.items() if k not in self.wanted)
        self.size += new
        return out


def _encoder_task(path: str, reused, digests: bool, counted=None):
    """``reused``: the broadcast hashes of the chunks to keep. ``counted``:
    accumulators of bytes encoded and reused."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load("word_end", path)
        known = _Chunks(encoder, reused.value)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            start = 0
            while start < batch.num_rows:
                stop, size = start, 0
                while stop < batch.num_rows and (stop == start or size < _BATCH_BYTES):
                    size += len(texts[stop].as_buffer())
                    stop += 1
                parts = known.parts(texts.slice(start, stop - start).to_pylist())
                joins = encoder.words([w for p in parts for w in cut_words(p)])
                out = [join_parts(joins, p) for p in parts]
                columns = {"doc_id": keys.slice(start, stop - start),
                           "n_tokens": pa.array([len(i) // 4 for i, _ in out], pa.int64())}
                if digests:
                    columns["ids_sha256"] = [hashlib.sha256(i).hexdigest() for i, _ in out]
                    columns["decoded_sha256"] = [hashlib.sha256(t).hexdigest() for _, t in out]
                else:
                    columns["ids"] = pa.array(
                        [np.frombuffer(i, "<u4").astype(np.int32) for i, _ in out],
                        pa.list_(pa.int32()))
                    columns["decoded"] = [t.decode() for _, t in out]
                yield pa.RecordBatch.from_pydict(columns)
                start = stop
        if counted is not None:
            counted[0].add(known.encoded)
            counted[1].add(known.reused)
    return run


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text",
           digests: bool = False, limit: int = REUSED_CHUNKS, counted=None) -> DataFrame:
    """doc_id, n_tokens and either ids array<int> and decoded string, or
    (``digests``) their SHA-256 as lowercase hex. One row per input row, no
    shuffle of texts or ids: only chunk hashes and counts are shuffled.
    ``counted``: two accumulators that receive the bytes encoded and reused."""
    spark = docs.sparkSession
    # bounded: at most `limit` hashes of 16 bytes
    hashes = frozenset(bytes(r["h"]) for r in shared_chunks(docs, text, limit).collect())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text).alias("t"))
    kind = ("ids_sha256 string, decoded_sha256 string" if digests
            else "ids array<int>, decoded string")
    return rows.mapInArrow(
        _encoder_task(tokenizer, spark.sparkContext.broadcast(hashes), digests, counted),
        f"doc_id long, n_tokens long, {kind}")
