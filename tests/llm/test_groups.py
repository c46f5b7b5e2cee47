"""Dedup, near-dedup, toxicity, language model: brute force and held-out checks."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from reelrank.llm import exact_dedup, lm, simhash, toxicity
from reelrank.llm import common
from reelrank.llm.components import star_components
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


# --- exact dedup ------------------------------------------------------------------

def test_exact_dedup(odd):
    got = exact_dedup.exact_dedup(odd).collect()
    groups = {}
    for i, t in ODD:
        groups.setdefault(t or "", []).append(i)
    assert len(got) == len(ODD)
    for t, ids in groups.items():
        sha = hashlib.sha256(t.encode()).hexdigest()
        rows = [r for r in got if r["text_sha256"] == sha]
        best = max((i for i in ids if i is not None), default=None)
        assert {(r["keep_id"], r["group_size"]) for r in rows} == {(best, len(ids))}
        kept = [r for r in rows if r["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == best


def test_exact_dedup_same_length_and_prefix(make):
    head = "p" * 80
    docs = make([(1, head + "a"), (2, head + "b"), (3, head + "a"), (4, head + "c")] +
                [(i, "hot") for i in range(10, 300)])
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in
           exact_dedup.exact_dedup(docs).collect()}
    assert got[1] == (3, 2, False) and got[3] == (3, 2, True)
    assert got[2] == (2, 1, True) and got[10] == (299, 290, False) and got[299] == (299, 290, True)


def test_keep_rows(odd):
    found = exact_dedup.exact_dedup(odd)
    kept = exact_dedup.keep_rows(odd, found, found.where("kept"))
    assert kept.columns == odd.columns
    assert kept.count() == len({t or "" for _, t in ODD})


def test_exact_dedup_empty(none):
    assert exact_dedup.exact_dedup(none).collect() == []


# --- SimHash -------------------------------------------------------------------------

def fingerprint(t, k=3):
    w = WORD.findall(lower(t or ""))
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, bits):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_simhash_rows(odd):
    got = simhash.near_duplicates(odd).collect()
    short = [(i, t) for i, t in ODD if len(t or "") < 1000]
    assert sorted(r["fingerprint"] for r in got if r["doc_id"] != 6) == sorted(
        f"{fingerprint(t):016x}" for _, t in short)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["component_id"] == by_id[2]["component_id"] == by_id[11]["component_id"] == 1
    assert by_id[3]["component_id"] == by_id[5]["component_id"] == 3
    heads = simhash.group_heads(simhash.near_duplicates(odd)).collect()
    assert len(heads) == len({r["root"] for r in got})


@pytest.mark.parametrize("bits,block", [(1, 4096), (2, 4096), (2, 8), (3, 4096), (3, 16)])
def test_links_lose_no_component(spark, bits, block):
    rng = np.random.default_rng(bits * 100 + block)
    fps = set(rng.integers(0, 2**64, 300, dtype=np.uint64).tolist())
    for center in list(fps)[:6]:  # balls, chains and bits that go together
        x = center
        for _ in range(40):
            x ^= 1 << int(rng.integers(0, 64))
            fps.add(x)
            fps.add(center ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))))
    fps |= {0, 2**64 - 1, 1, 1 << 63}
    rows = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    df = spark.createDataFrame(rows, "fp long")
    stars = {r["u"]: r["v"] for r in star_components(simhash.links(df, bits, block)).collect()}
    expected = components(fps, bits)
    signed = lambda f: int(np.uint64(f).astype(np.int64))
    got = {f: stars.get(signed(f), signed(f)) for f in fps}
    for a in fps:
        for b in fps:
            assert (got[a] == got[b]) == (expected[a] == expected[b])


def test_allocate_minimises_and_covers():
    cost, ts = simhash.allocate([[5.0, 50, 99], [1.0, 4, 99], [9.0, 90, 99], [2.0, 70, 99]], 2)
    assert sum(t + 1 for t in ts) == 3
    assert (cost, ts) == (6.0, [-1, 1, -1, 0])


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "u long, v long")
    got = {r["u"]: r["v"] for r in star_components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 501: 500}


def test_simhash_empty(none):
    assert simhash.near_duplicates(none).collect() == []


# --- toxicity --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def rated(spark):
    rng = np.random.default_rng(5)
    vocab = [f"wo{chr(97 + i % 26)}{chr(97 + i // 26)}rd" for i in range(300)]
    docs, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        sentences = [" ".join(rng.choice(vocab, 8)) for _ in range(6)]
        if toxic:
            sentences[int(rng.integers(0, 6))] += " " + str(rng.choice(["vile", "foul"]))
        docs.append((i, ". ".join(sentences)))
        if i % 11:
            labels.append((i, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int"))


def test_toxicity_held_out_and_spans(rated):
    docs, labels = rated
    model = toxicity.train(docs, labels)
    rows = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    held = [i for i in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum((rows[i]["score"] >= 0.3) == (i % 5 == 0) for i in held)
    assert right >= 0.97 * len(held)
    found = [s for i in held if i % 5 == 0 for s in rows[i]["spans"]
             if re.search("vile|foul", text[i][s["start"]:s["end"]])]
    assert len(found) >= 0.9 * sum(i % 5 == 0 for i in held)


def test_toxicity_reads_no_held_out_label(rated):
    docs, labels = rated
    flipped = labels.withColumn("toxic", toxicity.F.when(
        toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    assert toxicity.train(docs, labels) == toxicity.train(docs, flipped)


def test_toxicity_odd_rows(odd, none, rated):
    model = toxicity.train(*rated)
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(none, model).collect() == []
    assert toxicity.clean_rows(odd, model).columns == odd.columns
    assert toxicity.clean_rows(odd, model).count() == sum(r["score"] < 0.3 for r in got)
    constant = toxicity.train(odd, rated[1].where("toxic = 0"))
    assert not constant.weights


def test_the_score_is_the_noisy_or_of_its_sentences():
    model = toxicity.Model({"vile": 2.0, "foul": 1.0, "^viles": 0.5}, -3.0, -4.0)
    text = "A vile day. Nothing here! vile foul\nVilesome vileness? 12 34. ok"
    sigma = lambda z: 1 / (1 + math.exp(-z))
    sentences = [{"vile"}, set(), {"vile", "foul"}, {"^viles"}, set()]
    clean = 1 - sigma(model.leak)
    for hit in sentences:
        clean *= 1 - sigma(model.bias + sum(model.weights[w] for w in hit))
    score, spans = toxicity.Scorer(model)(text)
    assert score == pytest.approx(1 - clean)
    assert [text[a:b].strip() for a, b, _ in spans] == []  # none over one half
    assert toxicity.Scorer(model)("")[0] == pytest.approx(sigma(model.leak))


def test_the_fit_climbs_the_noisy_or_likelihood():
    rng = np.random.default_rng(8)
    bags = [[(sorted(set(rng.integers(0, 4, 2).tolist())), int(rng.integers(1, 3)))
             for _ in range(rng.integers(0, 3))] for _ in range(300)]
    plain = rng.integers(0, 5, 300).astype(float)
    true, prior = np.array([3.0, 0.0, 1.0, 2.0]), np.zeros(4)

    def energies(w, b, leak):
        return np.array([np.logaddexp(0, leak) + p * np.logaddexp(0, b) + sum(
            n * np.logaddexp(0, b + w[words].sum()) for words, n in x) for p, x in zip(plain, bags)])

    def loss(theta):
        e = energies(theta[:4], theta[4], theta[5])
        return -(np.where(y == 1, np.log(-np.expm1(-e)), -e)).sum() + 0.15 * ((theta[:4] - prior) ** 2).sum()

    y = (rng.random(300) < -np.expm1(-energies(true, -3.0, -4.0))).astype(int)
    w, b, leak = toxicity.fit_noisy_or(y, plain, bags, prior, steps=4000)
    theta = np.array([*w, b, leak])
    for k in range(6):  # no step in any direction lowers the loss by much
        for step in (0.05, -0.05):
            moved = theta.copy()
            moved[k] += step
            assert loss(moved) > loss(theta) - 2e-3


def test_a_hot_labelled_id_does_not_outgrow_the_sample(spark, rated, monkeypatch):
    docs, labels = rated
    hot = spark.createDataFrame([(1, f"vile text {i}") for i in range(3000)] + [(1, "same")] * 3000,
                                "doc_id long, text string")
    seen = []
    fit = toxicity.fit_noisy_or
    monkeypatch.setattr(toxicity, "fit_noisy_or", lambda y, *a: seen.append(len(y)) or fit(y, *a))
    toxicity.train(docs.union(hot), labels, sample_docs=700)
    assert 300 < seen[0] < 850


# --- language model ----------------------------------------------------------------------

def test_base_scores(odd):
    model = lm.train(odd)
    got = lm.score(odd, model).collect()
    counts = Counter()
    for i, t in ODD:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*WORD.findall(lower(t or "")), None])
    n, v = sum(counts.values()), len(counts)
    expected = []
    for i, t in ODD:
        w = [*WORD.findall(lower(t or "")), None]
        expected.append((i, len(w), sum(counts[x] > 0 for x in w),
                         round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6)))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6))
                   for r in got), key=key) == sorted(expected, key=key)
    assert {r["train_tokens"] for r in got} == {n}
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_rare_words_meet_their_counts(odd, monkeypatch):
    whole = sorted((str(r["doc_id"]), r["n_known"], round(r["base_score"], 6))
                   for r in lm.score(odd, lm.train(odd)).collect())
    monkeypatch.setattr(lm, "HEAD", 5)
    monkeypatch.setattr(lm, "LEAST_WORDS", 4)
    monkeypatch.setattr(lm, "WORDS_PER_ROOT", 0)
    few = sorted((str(r["doc_id"]), r["n_known"], round(r["base_score"], 6))
                 for r in lm.score(odd, lm.train(odd)).collect())
    assert whole == few


def test_network_learns_more_than_unigrams(make):
    # two kinds of documents: the first words tell which words follow
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice([f"{'ab'[i % 2]}{k}" for k in range(30)], 60))) for i in range(500)]
    got = lm.score(make(rows), lm.train(make(rows))).collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 5 * len(held)


def test_network_meets_every_training_row(make, monkeypatch, tmp_path):
    # over 200,000 tokens, a third of the rows without an id, a tenth equal
    rng = np.random.default_rng(5)
    rows = [(None if i % 3 == 0 else i, " ".join(rng.choice(["a", "b", "c", "d"], 99)))
            for i in range(2700)] + [(None, "e " * 99)] * 300
    n = sum(i is None or zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows)
    folder = str(tmp_path)

    def fake(*_):  # a task writes how many rows it has been given
        def run(batches):
            import uuid
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(sum(b.num_rows for b in batches)))
            yield from ()
        return run

    monkeypatch.setattr(lm, "_train_task", fake)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 30_000)
    lm.train(make(rows))
    met = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert sum(met) == n
    assert len(met) > 5 and max(met) < 2.5 * n / len(met)


def test_gradient_matches_differences():
    net = lm.Network(9, width=4)
    net.theta[:] = np.random.default_rng(0).normal(0, 0.5, len(net.theta))
    h = np.random.default_rng(1).normal(0, 1, (6, 4)).astype(np.float32)
    ids = np.array([0, 1, 5, 8, 3, 0])
    grads = lm.Network(9, np.zeros_like(net.theta), width=4)
    net.output(h, ids, grads)
    for p in range(len(net.theta) - 60, len(net.theta), 7):
        for sign in (1, -1):
            net.theta[p] += sign * 1e-2
            value = -net.output(h, ids).sum()
            net.theta[p] -= sign * 1e-2
            up = value if sign == 1 else up
        assert abs((up - value) / 2e-2 - grads.theta[p]) < 2e-2


def test_recurrent_gradients_match_differences():
    net = lm.Network(30, np.random.default_rng(0).normal(
        0, 0.4, len(lm.Network(30, width=4).theta)), width=4)
    trainer = lm.Trainer(net, 3)
    trainer.grads = lm.Network(30, np.zeros_like(net.theta), width=4)
    ids = np.random.default_rng(1).integers(0, 30, (6, 3))
    start = np.random.default_rng(2).normal(0, 0.5, (3, 4))

    def loss():
        h, total, table = start.copy(), 0.0, net.inputs()
        for x, y in zip(ids[:-1], ids[1:]):
            h, _ = net.step(table[x], h)
            total -= net.output(h, y).sum()
        return total

    trainer.window(ids[:-1], ids[1:], start)
    for p in range(0, len(net.theta), 11):
        keep = net.theta[p]
        net.theta[p] = keep + 1e-3
        up = loss()
        net.theta[p] = keep - 1e-3
        down = loss()
        net.theta[p] = keep
        assert abs((up - down) / 2e-3 - trainer.grads.theta[p]) < 1e-2 * max(1, abs(up - down) / 2e-3)


def test_the_network_knows_more_words_of_more_distinct_ones():
    sizes = [lm.network_words(v) for v in (0, 10**6, 10**8, 10**12)]
    assert sizes == sorted(sizes) and sizes[0] == lm.LEAST_WORDS and sizes[-1] < 2**16


def test_equally_rare_words_are_not_all_dropped(spark):
    counts = spark.range(3000).selectExpr("cast(id as string) as word", "cast(1 as long) as c")
    top = spark.createDataFrame([("top", 50)], "word string, c long")
    got = [r["word"] for r in common.commonest(counts.union(top), "c", 1000).collect()]
    assert "top" in got and 700 < len(got) <= 1000 and len(set(got)) == len(got)
    assert common.commonest(counts, "c", 3000).count() == 3000
    assert common.commonest(counts.limit(0), "c", 10).count() == 0


def test_windows_carry_the_state():
    net = lm.Network(50, counts=np.ones(50))
    net.theta += np.random.default_rng(3).normal(0, 0.3, len(net.theta)).astype(np.float32)
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 50, n) for n in (1, 200, 64, 65, 3, 128)]
    together = lm.sequence_scores(net, docs)
    table = net.inputs()
    for d, s in zip(docs, together):
        h, last, total = np.zeros((1, net.width), np.float32), 1, 0.0
        for w in d:
            h, _ = net.step(table[[last]], h)
            total += float(net.output(h, np.array([w]))[0])
            last = w
        assert abs(total / math.log(10) - s) < 1e-3 * max(1, len(d))
    assert len(lm.sequence_scores(net, [])) == 0


def test_lm_empty(none):
    assert lm.score(none, lm.train(none)).collect() == []
