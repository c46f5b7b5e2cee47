"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits; two texts link when theirs differ in at most
``bits`` of them. Bits that go together are put into one partition, every
partition gets its own threshold t (or none): if the sum of t + 1 is
bits + 1, linked fingerprints differ in at most t bits in some partition.
Dynamic programming picks the thresholds with the fewest estimated
candidates, the estimates being pair counts over all fingerprints. Equal
fingerprints are one from the start. Fingerprints that agree on a probe key
are compared in blocks of bounded size, each block giving a spanning forest
of its links instead of all pairs; components of those are the groups.

Cases: null and empty texts have fingerprint zero and link like any other;
repeated rows keep their rows; null ids are never the smallest id (a group
of only null ids has a null component_id); an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelrank.llm.common import skew_lookup, text_bytes, written
from reelrank.llm.components import star_components

SEED = 42
# Fingerprints compared in one block; larger probe groups are first probed
# again on their other bits, then split into blocks.
BLOCK = 4096
_SHINGLES = 1 << 16


def fingerprint(data: bytes, words_per_shingle: int = 3) -> int:
    """The fingerprint as a signed 64-bit number."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    k = words_per_shingle
    if len(words) < k:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*[words[i:] for i in range(k)])))
    ones = np.zeros(64, np.int64)
    for a in range(0, len(shingles), _SHINGLES):
        part = shingles[a:a + _SHINGLES]
        h = np.array(list(map(xxh64_intdigest, part, repeat(SEED))), np.uint64)
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big", signed=True)


def _fingerprint_task(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns
            fps = pa.array([fingerprint(t, k) for t in batch.column(n - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:n - 1], fps],
                                             names=[*batch.schema.names[:n - 1], "fp"])
    return run


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, id_col: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """_row, doc_id, text_sha256 (bytes), fp for every row."""
    t = text_bytes(text)
    rows = docs.select(F.monotonically_increasing_id().alias("_row"),
                       F.col(id_col).cast("long").alias("doc_id"),
                       F.sha2(t, 256).alias("text_sha256"), t.alias("t"))
    return rows.mapInArrow(_fingerprint_task(words_per_shingle),
                           "_row long, doc_id long, text_sha256 string, fp long")


# --- partitions and thresholds ---------------------------------------------

def _gram_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gram = np.zeros((64, 64), np.int64)
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
        for a in range(0, len(fps), 1 << 15):
            part = fps[a:a + (1 << 15)]
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8),
                                 axis=1, bitorder="little").astype(np.float32)
            gram += (bits.T @ bits).astype(np.int64)
    if gram.any():
        yield pa.RecordBatch.from_pydict({
            "cell": pa.array(np.arange(4096), pa.int64()), "n": pa.array(gram.ravel())})


def bit_statistics(fps: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(share of ones per bit, absolute correlation of bits): sums over all
    fingerprints; 4096 numbers reach the driver."""
    n = fps.count()
    rows = (fps.select("fp").mapInArrow(_gram_task, "cell long, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).collect())
    gram = np.zeros(4096)
    for r in rows:
        gram[r["cell"]] = r["n"]
    both = gram.reshape(64, 64) / max(n, 1)
    p = np.diag(both).copy()
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    corr = np.abs(np.divide(both - np.outer(p, p), spread, out=np.zeros((64, 64)),
                            where=spread > 1e-12))
    return p, corr


def correlated_groups(corr: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of nearly equal size; each grows from its
    most correlated pair by the bit that correlates most with it."""
    free, out = list(range(len(corr))), []
    for g in range(parts):
        size = len(free) // (parts - g)
        pairs = corr[np.ix_(free, free)].copy()
        np.fill_diagonal(pairs, -1.0)
        i, j = np.unravel_index(int(np.argmax(pairs)), pairs.shape)
        group = [free[i], free[j]] if size > 1 else [free[i]]
        rest = [b for b in free if b not in group]
        while len(group) < size:
            best = max(rest, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            rest.remove(best)
        out.append(sorted(group))
        free = rest
    return out


def _mask(bits) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >= 1 << 63 else m


def allocate(costs: list[list[float]], bits: int) -> tuple[float, list[int]]:
    """Thresholds (-1: no probe) with sum(t + 1) = bits + 1 and the least
    total cost; ``costs[i][t]`` is partition i's cost at threshold t."""
    best = {0: (0.0, [])}
    for c in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, ts) in best.items():
            for t in range(-1, bits + 1 - used):
                value = cost + (c[t] if t >= 0 else 0.0)
                if used + t + 1 not in new or value < new[used + t + 1][0]:
                    new[used + t + 1] = (value, [*ts, t])
        best = new
    return best[bits + 1]


def probe_masks(fps: DataFrame, bits: int) -> list[tuple[int, ...]]:
    """For each probe the bits that must agree. Partitionings into 2 up to
    bits + 2 parts are compared by candidates plus rows probed."""
    p, corr = bit_statistics(fps)
    n = fps.count()
    options = {m: correlated_groups(corr, m) for m in range(2, bits + 3)}
    keys = [(m, i, _mask(g)) for m, gs in options.items() for i, g in enumerate(gs)]
    probes = F.explode(F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"),
                 F.col("fp").bitwiseAND(F.lit(k).cast("long")).alias("key")) for m, i, k in keys]))
    counted = (fps.select(probes.alias("p")).groupBy("p.m", "p.i", "p.key")
               .agg(F.count("*").cast("double").alias("c"))
               .groupBy("m", "i").agg(F.sum(F.expr("c * (c - 1) / 2")).alias("pairs")))
    pairs = {(r["m"], r["i"]): r["pairs"] for r in counted.collect()}
    # how much likelier a bit differs than agrees, as if bits were independent
    odds = 2 * p * (1 - p) / np.maximum(p * p + (1 - p) * (1 - p), 1e-9)
    best = None
    for m, groups in options.items():
        costs = []
        for i, g in enumerate(groups):
            grow, row = np.zeros(bits + 1), []
            grow[0] = 1.0
            for b in g:  # elementary symmetric sums of the odds
                grow[1:] += grow[:-1] * odds[b]
            for t in range(bits + 1):
                n_probes = sum(1 for _ in combinations(g, t)) if t < 3 else len(g) ** t
                row.append(pairs.get((m, i), 0.0) * grow[: t + 1].sum() + 4.0 * n * n_probes)
            costs.append(row)
        found = allocate(costs, bits)
        if best is None or found[0] < best[0]:
            best = (*found, groups)
    _, thresholds, groups = best
    out = []
    for g, t in zip(groups, thresholds):
        if t >= 0:
            out += [tuple(sorted(set(g) - set(free))) for free in combinations(g, t)]
    return out


# --- probing and verification ------------------------------------------------

def spanning(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links (a, b) between the given distinct fingerprints that connect all
    that their links connect; at most one per fingerprint."""
    edges, rest = [], fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            a = queue.pop()
            near = np.bitwise_count(rest ^ a) <= bits
            if near.any():
                found = rest[near]
                rest = rest[~near]
                edges += [(int(a), int(b)) for b in found]
                queue += list(found)
    return edges


def _verify_task(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(key: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sizes = np.diff(np.append(starts, len(key)))
            u, v = [], []
            two = starts[sizes == 2]  # most groups: all at once
            a, b = fps[two], fps[two + 1]
            near = np.bitwise_count(a ^ b) <= bits
            u += a[near].tolist()
            v += b[near].tolist()
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                for x, y in spanning(np.unique(fps[s:s + n]), bits):
                    u.append(x)
                    v.append(y)
            if u:
                yield pa.RecordBatch.from_pydict({
                    "u": pa.array(np.array(u, np.uint64).view(np.int64)),
                    "v": pa.array(np.array(v, np.uint64).view(np.int64))})

        held_key, held = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            key = np.concatenate([held_key, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate(
                [held, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))  # the last group may go on
            yield from links(key[:last], fps[:last]) if last else ()
            held_key, held = key[last:], fps[last:]
        if len(held):
            yield from links(held_key, held)
    return run


def links(fps: DataFrame, bits: int, block: int = BLOCK) -> DataFrame:
    """(u, v): links that connect all linked fingerprints of ``fps`` (fp)."""
    masks = probe_masks(fps, bits)
    fps = fps.select("fp")

    def probed(rows: DataFrame, codes: list[tuple[int, int]]) -> DataFrame:
        return rows.select("fp", F.explode(F.array(*[
            F.struct(F.lit(c).alias("code"),
                     F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
            for c, m in codes])).alias("p")).select("fp", "p.code", "p.key")

    def sized(rows: DataFrame) -> DataFrame:
        groups = rows.groupBy("code", "key").agg(F.count("*").alias("n")).where("n > 1")
        return skew_lookup(rows, written(groups, "probe-groups"), ["code", "key"], "n",
                           ["fp"]).where("n is not null")

    first = written(sized(probed(fps, [(i, _mask(m)) for i, m in enumerate(masks)])), "probes")
    # large groups: linked members also agree on one of bits + 1 blocks of the other bits
    finer = []
    for i, m in enumerate(masks):
        rest = [b for b in range(64) if b not in m]
        for j in range(bits + 1):
            finer.append((i, len(masks) + i * (bits + 1) + j,
                          _mask([*m, *rest[j::bits + 1]])))
    large = first.where(F.col("n") > block)
    again = None
    if not large.isEmpty():
        again = large.select("fp", "code", F.explode(F.array(*[
            F.struct(F.lit(i).alias("of"), F.lit(c).alias("code2"),
                     F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key2"))
            for i, c, m in finer])).alias("p")).where("p.of = code").select(
                "fp", F.col("p.code2").alias("code"), F.col("p.key2").alias("key"))
        again = sized(again)
    rows = first.where(F.col("n") <= block)
    rows = rows if again is None else rows.unionByName(again)
    # blocks: a group of k shares is compared share against share
    share = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("_k")).cast("int")
    tiles = (rows.withColumn("_k", share)
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
             .withColumn("_own", own)
             .select("fp", F.xxhash64("code", "key", F.least("_own", "_other"),
                                      F.greatest("_own", "_other")).alias("tile")))
    # a shared hash of two tiles only compares more pairs than needed
    dealt = tiles.repartition(F.col("tile")).sortWithinPartitions("tile", "fp")
    return dealt.select("tile", "fp").mapInArrow(_verify_task(bits), "u long, v long")


def near_duplicates(docs: DataFrame, words_per_shingle: int = 3, bits: int = 2,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id for every row, with text_sha256 and
    the group's smallest fingerprint ``root``."""
    rows = written(fingerprints(docs, words_per_shingle, id_col, text), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first"),
                                         F.count("*").alias("n")), "distinct-fingerprints")
    stars = star_components(links(fps, bits))
    rooted = fps.join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    sizes = rooted.groupBy("root").agg(F.min("first").alias("component_id"),
                                       F.count("*").alias("_members"))
    members = skew_lookup(rooted.select("fp", "n", "root"), sizes, ["root"], "_members", ["fp"])
    members = written(members.drop("_members"), "members")
    out = skew_lookup(rows, members, ["fp"], "n", ["_row"])
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      "component_id", "text_sha256", "root")


def group_heads(found: DataFrame) -> DataFrame:
    """One row (doc_id, text_sha256) per group: its smallest id, null ids last."""
    return (found.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_sha256")).alias("head"))
        .select("head.doc_id", "head.text_sha256"))
