"""Language-model scoring: a gated recurrent network with class-factored output.

Unigram counts cover every training document and stay a distributed table.
The network knows the commonest words, more of them the more distinct words
there are; all others share one output class and are told apart by their
counts. Every text is read twice: for the counts, and to be encoded as network
ids, which training and scoring share. Training is truncated backpropagation
in numpy, in which every training document takes part once: all are dealt
into parts and these into shards; every shard of a part continues from the
same weights, whose results are averaged before the next part. Scoring runs
whole documents, the state being carried from window to window.

Cases: null and empty texts are one end token; rows with equal or null ids
are scored and trained on each on their own (null ids train), equal rows
being dealt to many shards; an empty table gives no
rows; without training documents every token is unknown; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reelrank.llm.common import commonest, text_bytes, written

END = b""  # the end token; no word is empty
# Network width; words in the network: at least, for each square root of the
# distinct words, and at most (network ids have 16 bits); words whose counts
# are broadcast.
MOST_WORDS = 2**16 - 1
WIDTH, LEAST_WORDS, WORDS_PER_ROOT, HEAD = 16, 1024, 0.5, 200_000
# Backpropagation window; texts side by side: at most, at least, and steps a
# shard should have; tokens that a task holds at a time; tokens per shard
# (its weights are as long as some 50,000 tokens of text); parts in turn; the
# first step size.
WINDOW, MOST_LANES, LEAST_LANES, STEPS, HELD_TOKENS = 16, 512, 16, 1000, 500_000
SHARD_TOKENS, PARTS, RATE = 8_000_000, 2, 0.02
# Window, tokens and texts that scoring and encoding hold at a time.
_SCORE_WINDOW, _SCORE_TOKENS, _TEXTS = 64, 1_000_000, 500


def held_out(id_col: str = "doc_id", mod: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == fold, F.lit(False))


def words_of(data: bytes) -> list[bytes]:
    return data.lower().split()  # bytes: A-Z and ASCII white space only


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(c):
        return pa.RecordBatch.from_pydict({
            "word": pa.array(list(c), pa.binary()), "c": pa.array(list(c.values()), pa.int64())})

    counts: Counter = Counter()
    for batch in batches:
        for t in batch.column(0).to_pylist():
            counts.update(words_of(t))
            counts[END] += 1
            if len(counts) > 400_000:
                yield flush(counts)
                counts = Counter()
    if counts:
        yield flush(counts)


def unigrams(texts: DataFrame) -> DataFrame:
    """(word, c) over every text of ``texts`` (t: bytes), the end included."""
    return (texts.select("t").mapInArrow(_count_task, "word binary, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


# --- the network ----------------------------------------------------------------

def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(x):
    """exp(x - shift), its row sums, shift. Logits are small as a rule and need
    no shift; else each row's largest is taken off."""
    ones = np.ones(x.shape[1], x.dtype)
    if x.size and x.max() < 60:
        e = np.exp(x)
        total = e @ ones
        if total.min() > 1e-30:
            return e, total, 0.0
    shift = x.max(axis=1)
    e = np.exp(x - shift[:, None])
    return e, e @ ones, shift


class Network:
    """Ids: 0 all other words, 1 the end, then words by count. Word i > 0 is
    in class (i - 1) // per, about as many classes as words in each; id 0 is
    the last class's only member."""

    SHAPES = ("emb", "wx", "wh", "b", "wc", "bc", "wo", "bo")

    def __init__(self, n_words: int, theta: np.ndarray | None = None,
                 counts: np.ndarray | None = None, width: int = WIDTH):
        self.n, self.width = n_words, width
        self.per = max(1, math.ceil(math.sqrt(n_words - 1)))
        self.classes = math.ceil((n_words - 1) / self.per) + 1
        h, c, rows = width, self.classes, (self.classes - 1) * self.per + 1
        sizes = {"emb": (n_words, h), "wx": (h, 3 * h), "wh": (h, 3 * h), "b": (3 * h,),
                 "wc": (h, c), "bc": (c,), "wo": (rows, h), "bo": (rows,)}
        total = sum(int(np.prod(s)) for s in sizes.values())
        if theta is None:
            rng = np.random.default_rng(7)
            theta = rng.normal(0, 0.1, total).astype(np.float32)
        # small integers: their stable sort is a radix sort
        ids = np.arange(n_words)
        self._class = np.where(ids == 0, self.classes - 1, (ids - 1) // self.per).astype(np.int16)
        self.theta, at = theta, 0
        for k, s in sizes.items():
            size = int(np.prod(s))
            setattr(self, k, theta[at:at + size].reshape(s))
            at += size
        if counts is not None:  # start from the counts' own probabilities
            self.bo[:] = -20.0
            self.bo[:n_words - 1] = np.log(counts[1:] + 1e-3)
            mass = [counts[1 + i * self.per: 1 + (i + 1) * self.per].sum() for i in range(c - 1)]
            self.bc[:] = np.log(np.array([*mass, counts[0]]) + 1e-3)

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return self._class[ids]

    def step(self, x: np.ndarray, h: np.ndarray):
        """x: the input's part of the three gates."""
        w = self.width
        g = h @ self.wh
        zr = _sigmoid(x[:, :2 * w] + g[:, :2 * w])
        z, r = zr[:, :w], zr[:, w:]
        cand = np.tanh(x[:, 2 * w:] + r * g[:, 2 * w:])
        return z * h + (1 - z) * cand, (z, r, cand, g[:, 2 * w:])

    def inputs(self) -> np.ndarray:
        return self.emb @ self.wx + self.b

    def output(self, h: np.ndarray, ids: np.ndarray, grads=None) -> np.ndarray:
        """Log probability of each id after state h; adds to ``grads`` and
        leaves the gradient for h there."""
        cls = self.class_of(ids)
        logits = h @ self.wc + self.bc
        rows = np.arange(len(ids))
        e, total, shift = _softmax(logits)
        out = logits[rows, cls] - shift - np.log(total)
        if grads is not None:
            d = e / total[:, None]
            d[rows, cls] -= 1
            grads.wc[:] += h.T @ d
            grads.bc[:] += d.sum(axis=0)
            grads.h = d @ self.wc.T
        order = np.argsort(cls, kind="stable")
        bounds = np.searchsorted(cls[order], np.arange(self.classes + 1)).tolist()
        order, per = order[:bounds[-2]], self.per  # the last class has one word
        if not len(order):
            return out
        hs, own, n = h[order], cls[order], np.arange(len(order))
        full = [(c, bounds[c], bounds[c + 1]) for c in range(self.classes - 1)
                if bounds[c] < bounds[c + 1]]
        inner = np.empty((len(order), per), np.result_type(hs, self.wo))
        for c, i, j in full:
            np.matmul(hs[i:j], self.wo[c * per:(c + 1) * per].T, out=inner[i:j])
        inner += self.bo[:-1].reshape(-1, per)[own]
        e, total, shift = _softmax(inner)
        member = ids[order] - 1 - own * per
        out[order] += inner[n, member] - shift - np.log(total)
        if grads is not None:
            d = e / total[:, None]
            d[n, member] -= 1
            back = np.empty_like(hs)
            for c, i, j in full:
                at = slice(c * per, (c + 1) * per)
                grads.wo[at] += d[i:j].T @ hs[i:j]
                np.matmul(d[i:j], self.wo[at], out=back[i:j])
            grads.h[order] += back
            grads.bo[:-1].reshape(-1, per)[[c for c, _, _ in full]] += np.add.reduceat(
                d, [i for _, i, _ in full], axis=0)
        return out


class Trainer:
    """Truncated backpropagation over token streams cut into lanes; Adam steps
    on ``net.theta`` in place. State and moments go on from call to call."""

    def __init__(self, net: Network, lanes: int, rates=lambda step: 0.02):
        self.net, self.lanes, self.rates, self.steps = net, lanes, rates, 0
        self.mean, self.square = np.zeros_like(net.theta), np.zeros_like(net.theta)
        self.grads = Network(net.n, np.zeros_like(net.theta), width=net.width)
        self.h = np.zeros((lanes, net.width), np.float32)

    def feed(self, ids: np.ndarray) -> None:
        lanes = max(1, min(self.lanes, len(ids) // (4 * WINDOW)))
        steps = -(-len(ids) // lanes)
        if len(ids) < 2:
            return
        # the last lane is filled up with other words
        ids = np.concatenate([ids, np.zeros(lanes * steps - len(ids), ids.dtype)])
        grid = ids.reshape(lanes, steps).T
        h = self.h[:lanes]
        for a in range(0, steps - 1, WINDOW):
            y_ids = grid[a + 1:a + WINDOW + 1]
            h = self.window(grid[a:a + len(y_ids)], y_ids, h)
            self.adam(len(y_ids) * lanes)
        self.h[:lanes] = h

    def adam(self, tokens: int) -> None:
        g = np.clip(self.grads.theta / tokens, -1, 1)
        self.steps += 1
        self.mean += 0.1 * (g - self.mean)
        self.square += 0.01 * (g * g - self.square)
        root = np.sqrt(self.square / (1 - 0.99 ** self.steps))
        root += 1e-5
        rate = self.rates(self.steps) / (1 - 0.9 ** self.steps)
        self.net.theta -= rate * self.mean / root

    def window(self, x_ids: np.ndarray, y_ids: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Gradients of one window (steps by lanes) into ``grads``; the state
        after it."""
        net, grads, w = self.net, self.grads, self.net.width
        (t_n, lanes) = x_ids.shape
        half = np.repeat(np.array([0.5, 1], np.float32), [2 * w, w])
        grads.theta.fill(0)
        # sigmoid(x) = tanh(x / 2) / 2 + 1/2: the halves are taken beforehand
        table = net.inputs() * half
        wh, xs = net.wh * half, table[x_ids]
        states = np.empty((t_n + 1, lanes, w), np.float32)
        states[0] = h
        zr = np.empty((t_n, lanes, 2 * w), np.float32)
        cand, gc = np.empty_like(states[1:]), np.empty_like(states[1:])
        for t in range(t_n):
            g = states[t] @ wh
            np.tanh(xs[t, :, :2 * w] + g[:, :2 * w], out=zr[t])
            zr[t] *= 0.5
            zr[t] += 0.5
            gc[t] = g[:, 2 * w:]
            x = zr[t, :, w:] * gc[t]
            x += xs[t, :, 2 * w:]
            np.tanh(x, out=cand[t])
            np.subtract(states[t], cand[t], out=x)
            x *= zr[t, :, :w]
            np.add(x, cand[t], out=states[t + 1])
        net.output(states[1:].reshape(-1, w), y_ids.reshape(-1), grads)
        dh_out = grads.h.reshape(t_n, lanes, w)
        before, z, r = states[:-1], zr[:, :, :w], zr[:, :, w:]
        # what a state's gradient gives to z, r and the candidate's recurrent
        # part; its input's part is not scaled by r
        by_c = (1 - z) * (1 - cand * cand)
        by = np.empty((t_n, lanes, 3, w), by_c.dtype)
        np.multiply((before - cand) * z, 1 - z, out=by[:, :, 0])
        np.multiply(by_c * gc, r * (1 - r), out=by[:, :, 1])
        np.multiply(by_c, r, out=by[:, :, 2])
        dh, dhs, dgs = np.zeros_like(states[0]), np.empty_like(cand), np.empty_like(by)
        wh = np.ascontiguousarray(net.wh.T)
        for t in range(t_n - 1, -1, -1):
            np.add(dh, dh_out[t], out=dhs[t])
            np.multiply(by[t], dhs[t, :, None], out=dgs[t])
            dh = dgs[t].reshape(lanes, 3 * w) @ wh
            dh += dhs[t] * z[t]
        flat, used = by, x_ids.reshape(-1)  # by is not needed any more
        flat[:, :, :2] = dgs[:, :, :2]
        np.multiply(by_c, dhs, out=flat[:, :, 2])
        flat, dgs = flat.reshape(-1, 3 * w), dgs.reshape(-1, 3 * w)
        grads.wh[:] = before.reshape(-1, w).T @ dgs
        grads.b[:] = flat.sum(axis=0)
        grads.wx[:] = net.emb[used].T @ flat
        order = np.argsort(used, kind="stable")
        firsts = np.flatnonzero(np.diff(used[order], prepend=-1))
        grads.emb[used[order[firsts]]] = np.add.reduceat((flat @ net.wx.T)[order], firsts, axis=0)
        return states[-1]


def falling_rate(part: int, parts: int, steps: float):
    """Step sizes that fall evenly over all parts, each of ``steps`` steps."""
    def rate(step: int) -> float:
        return RATE * (1 - 0.9 * min(1.0, (part + min(1.0, step / max(steps, 1.0))) / parts))
    return rate


def _train_task(n_words: int, theta: np.ndarray, lanes: int, rates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(n_words, theta.copy())
        trainer = Trainer(net, lanes, rates)
        parts, size, total = [np.array([1])], 0, 0
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                parts.append(np.frombuffer(ids, np.uint16).astype(np.int64))
                size += len(parts[-1])
                if size >= HELD_TOKENS:  # memory stays bounded
                    trainer.feed(np.concatenate(parts))
                    total, parts, size = total + size, [np.array([1])], 0
        if size:
            trainer.feed(np.concatenate(parts))
            total += size
        if total:
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(np.arange(len(net.theta)), pa.int32()),
                "v": pa.array(net.theta.astype(np.float64) * total),
                "n": pa.array(np.full(len(net.theta), total), pa.int64())})
    return run


def network_words(distinct: int) -> int:
    """How many words the network knows, the class of all others included."""
    return int(min(max(LEAST_WORDS, WORDS_PER_ROOT * math.sqrt(distinct)), MOST_WORDS))


@dataclass
class Words:
    """Counts of all training words, and of the commonest ones (``head``: word
    -> place in the arrays) the network's id and the log10 probabilities."""
    counts: DataFrame
    total: int
    distinct: int
    rest_scale: float  # denominator of (c + 1) among the words the network lacks
    head: dict[bytes, int]
    ids: np.ndarray
    base: np.ndarray
    rest: np.ndarray
    start: np.ndarray  # counts by network id, the first that of all other words


@dataclass
class Model:
    words: Words
    theta: np.ndarray


def training_words(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> Words:
    texts = docs.where(~held_out(id_col)).select(text_bytes(text).alias("t"))
    counts = written(unigrams(texts), "unigrams")
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums["n"] or 0, sums["v"]
    top = [(bytes(r["word"]), r["c"]) for r in commonest(counts, "c", HEAD).collect()]
    if total and END not in {w for w, _ in top}:
        top.append((END, counts.where(F.length("word") == 0).first()["c"]))
    top.sort(key=lambda r: (r[0] != END, -r[1], r[0]))  # the end first, always known
    known = network_words(distinct) - 1
    c = np.array([c for _, c in top], float)
    rest_n = total - int(c[:known].sum())
    rest_scale = float(rest_n + distinct - min(len(top), known) + 1)
    places = np.arange(len(top))
    return Words(counts, total, distinct, rest_scale, {w: i for i, (w, _) in enumerate(top)},
                 np.where(places < known, places + 1, 0),
                 np.log10((c + 1) / (total + distinct + 1)), np.log10((c + 1) / rest_scale),
                 np.array([rest_n, *c[:known]]) if len(c) else np.array([1.0, 1.0]))


_ENCODED = ("row long, doc_id long, train boolean, k long, copy long, ids binary, word binary, "
            "n long, n_known long, base double, rest double")


def _encode_task(shared):
    """A row per text: its network ids as 16-bit numbers, tokens, known ones,
    and log10 sums over the head's words; and a row per text and distinct word
    outside the head (word, n). ``copy`` counts equal keys in the task, so that
    equal rows part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        head, net_ids, base, rest = shared.value
        net_ids = np.append(net_ids, 0).astype(np.uint16)  # place -1: no word of the head
        get, row = head.get, TaskContext.get().partitionId() << 36  # unique once written
        has_end, seen = END in head, Counter()
        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("train", pa.bool_()),
                            ("k", pa.int64()), ("copy", pa.int64()), ("ids", pa.binary()),
                            ("word", pa.binary()), ("n", pa.int64()), ("n_known", pa.int64()),
                            ("base", pa.float64()), ("rest", pa.float64())])

        def sent(**columns):
            size = len(columns["row"])
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type)
                 for f in schema], schema=schema)

        def rows_of(batch):
            nonlocal row
            ids, train, keys, texts = (c.to_pylist() for c in batch.columns)
            out = {f: [] for f in ("row", "copy", "ids", "n", "n_known", "base", "rest")}
            others = {f: [] for f in ("row", "word", "n")}
            for k, t in zip(keys, texts):
                words = words_of(t)
                words.append(END)
                places = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
                missing = np.flatnonzero(places < 0)
                found = places if not len(missing) else places[places >= 0]
                numbers = net_ids[places]
                if len(missing):
                    rare = Counter([words[i] for i in missing.tolist()])
                    others["row"] += [row] * len(rare)
                    others["word"] += rare
                    others["n"] += rare.values()
                if not has_end:
                    numbers[-1] = 1
                for f, v in (("row", row), ("copy", seen[k]), ("ids", numbers.tobytes()),
                             ("n", len(words)), ("n_known", len(found)), ("base", base[found].sum()),
                             ("rest", rest[found[net_ids[found] == 0]].sum())):
                    out[f].append(v)
                seen[k] += 1
                row += 1
            if len(seen) > 500_000:  # memory stays bounded; only parts copies less
                seen.clear()
            yield sent(doc_id=ids, train=train, k=keys, **out)
            if others["row"]:
                yield sent(**others)

        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                yield from rows_of(batch.slice(at, _TEXTS))
    return run


def encode(docs: DataFrame, words: Words, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text once as network ids and sums, written; training and scoring
    read these."""
    shared = docs.sparkSession.sparkContext.broadcast((words.head, words.ids, words.base, words.rest))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), ~held_out(id_col),
                       F.xxhash64(F.col(id_col).cast("long"), text_bytes(text)).alias("k"),
                       text_bytes(text).alias("t"))
    return written(rows.mapInArrow(_encode_task(shared), _ENCODED), "lm-texts")


def fit(encoded: DataFrame, words: Words, parts: int = PARTS) -> Model:
    """The network trained on the encoded training texts."""
    n_words, total = len(words.start), words.total
    theta = Network(n_words, counts=words.start).theta
    if total:
        shards = math.ceil(total / SHARD_TOKENS)
        parts = min(parts, shards)
        lanes = total / shards / WINDOW / STEPS
        lanes = int(min(max(LEAST_LANES, lanes), MOST_LANES))
        texts = encoded.where("word is null and train").select(
            F.xxhash64("k", "copy").alias("o"), "ids")
        for p in range(parts):
            # dealt by the hash of the hash, so that shards are even
            dealt = (texts.where(F.pmod("o", F.lit(parts)) == p)
                     .repartition(math.ceil(shards / parts), "o")
                     .sortWithinPartitions("o", "ids"))
            rates = falling_rate(p, parts, total / shards / WINDOW / lanes)
            mean = (dealt.select("ids").mapInArrow(_train_task(n_words, theta, lanes, rates),
                                                   "i int, v double, n long")
                    .groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v")).collect())
            if mean:
                theta = np.zeros_like(theta)
                theta[[x["i"] for x in mean]] = [x["v"] for x in mean]
    return Model(words, theta)


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", parts: int = PARTS) -> Model:
    words = training_words(docs, id_col, text)
    return fit(encode(docs, words, id_col, text), words, parts)


# --- scoring ----------------------------------------------------------------------

def sequence_scores(net: Network, docs: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each id sequence, run side by side; the state
    goes on from window to window."""
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    lengths = np.array([len(docs[i]) for i in order])
    out = np.zeros(len(docs))
    table = net.inputs().astype(np.float32)
    h = np.zeros((len(docs), net.width), np.float32)
    last = np.ones(len(docs), np.int64)  # every text follows an end
    for a in range(0, int(lengths[0]) if len(docs) else 0, _SCORE_WINDOW):
        alive = int(np.searchsorted(-lengths, -a, side="left"))  # lengths > a
        span = min(_SCORE_WINDOW, int(lengths[0]) - a)
        grid = np.zeros((span, alive), np.int64)
        for j in range(alive):
            part = docs[order[j]][a:a + span]
            grid[:len(part), j] = part
        states, targets, owners = [], [], []
        for t in range(span):
            m = int(np.searchsorted(-lengths[:alive], -(a + t), side="left"))
            h[:m], _ = net.step(table[last[:m]], h[:m])
            states.append(h[:m].copy())
            targets.append(grid[t, :m])
            owners.append(np.arange(m))
            last[:m] = grid[t, :m]
        logp = net.output(np.concatenate(states), np.concatenate(targets))
        out[:alive] += np.bincount(np.concatenate(owners), weights=logp, minlength=alive)
    result = np.zeros(len(docs))
    result[order] = out / math.log(10)
    return result


def _score_task(shared):
    """Adds the network's score to rows that begin with a text's ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_words, theta = shared.value
        net = Network(n_words, theta.copy())

        def finish(held):
            table = pa.Table.from_batches(held)
            docs = [np.frombuffer(i, np.uint16).astype(np.int64)
                    for i in table.column("ids").to_pylist()]
            out = table.drop_columns("ids").append_column(
                "net", pa.array(sequence_scores(net, docs), pa.float64()))
            return out.to_batches()

        held, size = [], 0
        for batch in batches:
            ends = np.cumsum([len(i.as_buffer()) // 2 for i in batch.column("ids")])
            at = 0
            while at < batch.num_rows:  # texts side by side, some million tokens
                done = int(ends[at - 1]) if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, done + _SCORE_TOKENS - size)))
                held.append(batch.slice(at, stop - at))
                size += int(ends[min(stop, len(ends)) - 1]) - done
                at = stop
                if size >= _SCORE_TOKENS:
                    yield from finish(held)
                    held, size = [], 0
        if held:
            yield from finish(held)
    return run


def score_encoded(encoded: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score per row.

    Words outside the broadcast head meet their counts in a join; none of them
    is common."""
    words = model.words
    shared = encoded.sparkSession.sparkContext.broadcast((len(words.start), model.theta))
    texts = encoded.where("word is null").select("ids", "row", "doc_id", "n", "n_known", "base", "rest")
    scored = texts.mapInArrow(_score_task(shared), "row long, doc_id long, n long, n_known long, "
                              "base double, rest double, net double")
    c = F.coalesce(F.col("c"), F.lit(0))
    scale = float(words.total + words.distinct + 1)
    rare = (encoded.where("word is not null").select("row", "word", "n")
            .join(words.counts, "word", "left").groupBy("row").agg(
                F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more_known"),
                F.sum(F.col("n") * F.log10((c + 1) / scale)).alias("more_base"),
                F.sum(F.col("n") * F.log10((c + 1) / words.rest_scale)).alias("more_score")))
    return scored.join(rare, "row", "left").select(
        "doc_id", F.col("n").alias("n_tokens"),
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("net") + F.col("rest") + F.coalesce("more_score", F.lit(0.0))).alias("score"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``score_encoded``, for any documents."""
    return score_encoded(encode(docs, model.words, id_col, text), model)
