"""Best-fit packing of token sequences by pattern packing.

Only the histogram of piece lengths (at most ``capacity`` numbers) decides
which lengths go together: patterns of few lengths that fill a sequence are
enumerated, non-negative least squares fits how often each repeats, the
counts are rounded down, and what is left is packed best-fit by decreasing
length. The resulting plan (runs of equal sequences) is joined back to the
pieces by their rank within their length.

Cases: a null text is empty (one end token); an empty table gives no rows;
rows with equal or null ids are separate documents; extra columns are
ignored; a text longer than a sequence is cut, its first piece the shorter.
"""

from __future__ import annotations

import bisect
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from reelrank.llm.bpe_words import load
from reelrank.llm.common import written

CAPACITY = 2048
# Ranks are given within (length, share); the shares of a length hold at most
# about so many pieces, whatever part of all pieces it has.
SHARE_PIECES = 1_000_000
_BATCH_CHARS = 4 << 20


def _piece_task(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = load("byte", path)
        end = array("I", [end_id]).tobytes()
        row = TaskContext.get().partitionId() << 36  # unique once written
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            start = 0
            while start < len(ids):
                stop, size = start, 0
                while stop < len(ids) and (stop == start or size < _BATCH_CHARS):
                    size += len(texts[stop].as_buffer())
                    stop += 1
                out = {k: [] for k in ("row", "doc_id", "piece", "start", "length", "ids_crc32")}
                chunk = texts.slice(start, stop - start).to_pylist()
                for doc_id, raw in zip(ids[start:stop], encoder.encode(chunk)):
                    raw += end
                    n = len(raw) // 4
                    at, piece = 0, 0
                    while at < n:
                        length = (n - at) % capacity or capacity
                        out["row"].append(row)
                        out["doc_id"].append(doc_id)
                        out["piece"].append(piece)
                        out["start"].append(at)
                        out["length"].append(length)
                        out["ids_crc32"].append(zlib.crc32(raw[4 * at: 4 * (at + length)]))
                        at, piece = at + length, piece + 1
                    row += 1
                yield pa.RecordBatch.from_pydict({
                    k: pa.array(v, pa.int32() if k == "piece" else pa.int64())
                    for k, v in out.items()})
                start = stop
    return run


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0,
                 capacity: int = CAPACITY, id_col: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """One row per piece: row (unique per document row), doc_id, piece,
    start, length, ids_crc32."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.mapInArrow(
        _piece_task(tokenizer, end_id, capacity),
        "row long, doc_id long, piece int, start long, length long, ids_crc32 long")


def nnls(i: np.ndarray, j: np.ndarray, v: np.ndarray, b: np.ndarray, columns: int,
         rounds: int = 800) -> np.ndarray:
    """min |A x - b| over x >= 0 by accelerated projected gradients, A with
    the entries v at (i, j)."""
    def times(x):
        return np.bincount(i, weights=v * x[j], minlength=len(b))

    def back(r):
        return np.bincount(j, weights=v * r[i], minlength=columns)

    x = np.ones(columns)
    for _ in range(30):  # the largest eigenvalue of A'A, from below
        x = back(times(x / max(np.linalg.norm(x), 1e-300)))
    step = 0.9 / max(np.linalg.norm(x), 1e-12)
    x = np.zeros(columns)
    y, t = x.copy(), 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * back(times(y) - b), 0.0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def patterns(counts: dict[int, int], capacity: int, least: int = 0, most: int = 1600,
             waste: int = 1) -> list[tuple[int, ...]]:
    """Patterns of few lengths, the longest at least ``least``, that fill
    ``capacity`` but for ``waste`` tokens.

    For each long length, once or as often as it fits or half of that: with
    its best partner; with each of the lengths that hold the most tokens and
    the best third; and halves of a pair. Each long length keeps its share of
    ``most``, those that can repeat most first."""
    lengths = sorted(counts)

    def best(room: int) -> int | None:
        i = bisect.bisect_right(lengths, room)
        return lengths[i - 1] if i else None

    common = sorted(lengths, key=lambda v: (-v * counts[v], v))[:48]
    long = [v for v in lengths if v >= least]
    out: list[tuple[int, ...]] = []
    for a in long:
        found: dict[tuple[int, ...], int] = {}

        def add(*p: int) -> None:
            key = tuple(sorted(p, reverse=True))
            if key[0] == a and 0 <= capacity - sum(key) <= waste:
                found[key] = min(counts[v] // key.count(v) for v in set(key))

        fits = capacity // a
        for times in {1, fits, (fits + 1) // 2, fits - 1} - {0}:
            own, rest = (a,) * times, capacity - times * a
            add(*own)
            if (b := best(rest)) is not None:
                add(*own, b)
                for c in common:
                    if c < rest and (d := best(rest - c)) is not None:
                        add(*own, c, d)
                        if (e := best(rest - c - d)) is not None:
                            add(*own, c, d, e)
        ranked = sorted((p for p in found if found[p]), key=lambda p: (-found[p] * sum(p), p))
        out += ranked[:max(2, most // len(long))]
    return out


def fit(counts: dict[int, int], capacity: int, least: int = 0) -> dict[tuple[int, ...], int]:
    """Whole repeat counts of patterns that never use more pieces of a
    length than there are; only patterns whose longest piece has ``least``
    tokens. Long pieces weigh more: short ones fit elsewhere too. Repeats are
    rounded up, the largest first, as far as pieces are left."""
    full = counts.get(capacity, 0)
    rest = {v: n for v, n in counts.items() if v < capacity and n > 0}
    plan = {(capacity,): full} if full else {}
    pats = patterns(rest, capacity, least)
    if not pats:
        return plan
    lengths = sorted({v for p in pats for v in p})
    where = {v: i for i, v in enumerate(lengths)}
    entries = np.array([(where[v], j, p.count(v)) for j, p in enumerate(pats) for v in set(p)])
    weight = (np.array(lengths) / capacity) ** 2
    repeats = nnls(entries[:, 0], entries[:, 1], entries[:, 2] * weight[entries[:, 0]],
                   np.array([rest[v] for v in lengths]) * weight, len(pats))
    left = dict(rest)
    for j in np.argsort(-repeats, kind="stable"):
        p = pats[j]
        need = {v: p.count(v) for v in p}
        k = min(int(np.ceil(repeats[j] - 0.1)), *(left[v] // n for v, n in need.items()))
        if k > 0:
            plan[p] = k
            for v, n in need.items():
                left[v] -= k * n
    return plan


def best_fit(counts: dict[int, int], capacity: int) -> dict[tuple[int, ...], int]:
    """Best-fit decreasing over counts: equal sequences are one entry with a
    number, so the work follows the histogram, not the pieces."""
    open_by_room: dict[int, dict[tuple[int, ...], int]] = {}
    rooms: list[int] = []

    def put(p: tuple[int, ...], n: int) -> None:
        room = capacity - sum(p)
        if room not in open_by_room:
            open_by_room[room] = {}
            bisect.insort(rooms, room)
        open_by_room[room][p] = open_by_room[room].get(p, 0) + n

    for v in sorted(counts, reverse=True):
        n = counts[v]
        while n > 0:
            i = bisect.bisect_left(rooms, v)
            if i == len(rooms):
                # all further pieces of this length open sequences of their own
                per = min(capacity // v, n)
                if n // per:
                    put((v,) * per, n // per)
                n -= n // per * per
                continue
            room = rooms[i]
            p, have = next(iter(open_by_room[room].items()))
            take = min(have, n)
            if take == have:
                del open_by_room[room][p]
                if not open_by_room[room]:
                    del open_by_room[room]
                    rooms.pop(i)
            else:
                open_by_room[room][p] = have - take
            put((*p, v), take)
            n -= take
    out: dict[tuple[int, ...], int] = {}
    for held in open_by_room.values():
        for p, n in held.items():
            out[p] = out.get(p, 0) + n
    return out


def fitted_plan(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = 10
                ) -> tuple[dict[tuple[int, ...], int], dict[int, int]]:
    """Repeats of patterns, and the pieces they leave. Each round fits patterns
    to what the rounds before have left, first those around the longest
    pieces, at last those of short pieces alone."""
    left, plan = dict(counts), {}
    for i in range(rounds):
        fitted = fit({v: n for v, n in left.items() if n}, capacity,
                     capacity * (rounds - 1 - i) // rounds)
        for p, k in fitted.items():
            plan[p] = plan.get(p, 0) + k
            for v in p:
                left[v] -= k
    return plan, {v: n for v, n in left.items() if n}


def pack_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Runs (length, first_rank, n, sequence, offset): the pieces of a
    length with ranks first_rank .. first_rank + n - 1 go to sequences
    sequence, sequence + 1, ... at ``offset``. Fitted patterns first, the
    residuals best-fit."""
    fitted, left = fitted_plan(counts, capacity)
    plan = [*fitted.items(), *best_fit(left, capacity).items()]
    used: dict[int, int] = {}
    runs, sequence = [], 0
    for p, n in plan:
        offset = 0
        for v in p:
            runs.append((v, used.get(v, 0), n, sequence, offset))
            used[v] = used.get(v, 0) + n
            offset += v
        sequence += n
    return runs


def _place_task(plan) -> Callable:
    """Adds sequence_id and offset to rows that end in a rank (_at) within
    their length: the last run of the length that starts at or below it.
    ``plan``: the broadcast runs, as arrays in the order of (length, rank)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rank, sequence, offset = plan.value
        for batch in batches:
            at = batch.column(batch.num_columns - 1).to_numpy()
            length = batch.column("length").to_numpy()
            i = np.searchsorted(key, (length << 48) | at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence[i] + at - rank[i]), pa.array(offset[i])],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"])
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with row, piece, length) plus sequence_id and offset."""
    spark = pieces.sparkSession
    pieces = written(pieces, "pieces")
    # at most ``capacity`` numbers
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shares = 1 + sum(counts.values()) // SHARE_PIECES
    own = pieces.columns
    dealt = pieces.withColumn("_share", F.pmod(F.xxhash64("row", "piece"), F.lit(shares)).cast("int"))
    # where each share's ranks begin: the sizes of the length's shares before it
    earlier = Window.partitionBy("length").orderBy("_share").rowsBetween(
        Window.unboundedPreceding, -1)
    first = (dealt.groupBy("length", "_share").agg(F.count("*").alias("n"))
             .select("length", "_share", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_first")))
    within = Window.partitionBy("length", "_share").orderBy("row", "piece")
    ranked = (dealt.withColumn("_in", F.row_number().over(within) - 1)
              .join(first, ["length", "_share"])
              .select(*own, (F.col("_first") + F.col("_in")).cast("long").alias("_at")))
    runs = sorted(pack_plan(counts, capacity))
    length, rank, _, sequence, offset = np.array(runs, np.int64).reshape(-1, 5).T
    plan = spark.sparkContext.broadcast(((length << 48) | rank, rank, sequence, offset))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(_place_task(plan), f"{kinds}, sequence_id long, offset long")
