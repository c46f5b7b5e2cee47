"""Properties: ranges, symmetry, exclusion, caps, determinism, brute force."""

import itertools
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelrank.operators import factorize as fz
from reelrank.operators import neighbours as nb
from reelrank.operators import prepare as pr
from reelrank.operators.rank import topn_per_user
from tools.plans import recorded


def random_ratings(seed, users=25, items=30, n=220):
    rng = random.Random(seed)
    cells = {(rng.randrange(users), rng.randrange(items)) for _ in range(n)}
    return [(u, i, float(rng.randint(1, 5))) for u, i in sorted(cells)]


def brute_pairs(rows):
    by_item = defaultdict(dict)
    for u, i, r in rows:
        by_item[i][u] = r
    norms = {i: np.sqrt(sum(v * v for v in d.values())) for i, d in by_item.items()}
    out = {}
    for a, b in itertools.combinations(sorted(by_item), 2):
        common = set(by_item[a]) & set(by_item[b])
        if common:
            out[(a, b)] = sum(by_item[a][u] * by_item[b][u] for u in common) / (norms[a] * norms[b])
    return out


@pytest.fixture(scope="module")
def rand_rows():
    return random_ratings(7)


@pytest.fixture(scope="module")
def rand_df(spark, rand_rows):
    return spark.createDataFrame(rand_rows, "userId long, itemId long, rating double")


def test_item_similarity_matches_brute_force(rand_df, rand_rows):
    expected = brute_pairs(rand_rows)
    for kw in ({}, {"max_block_items": 4, "max_tile_rows": 10}):
        got = {(r.item1, r.item2): r.similarity for r in nb.item_similarity(rand_df, **kw).collect()}
        assert set(got) == set(expected)
        assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)
        assert all(0.0 <= v <= 1.0 + 1e-12 for v in got.values())
        assert all(a < b for a, b in got)


def test_two_hop_matches_path_enumeration(rand_df, rand_rows):
    s = brute_pairs(rand_rows)
    sym = defaultdict(dict)
    for (a, b), v in s.items():
        sym[a][b] = v
        sym[b][a] = v
    expected = defaultdict(float)
    has_path = set()
    for i in sym:
        for j, sij in sym[i].items():
            for k, sjk in sym[j].items():
                if k != i:
                    expected[i] += sij * sjk
                    has_path.add(i)
    got = {r.itemId: r.predictedScore for r in nb.two_hop_raw(nb.item_similarity(rand_df)).collect()}
    assert set(got) == has_path
    assert all(abs(got[i] - expected[i]) < 1e-9 for i in got)
    for kw in ({}, {"max_block_items": 4, "max_tile_rows": 10}):
        fused = {r.itemId: r.predictedScore for r in nb.two_hop_from_ratings(rand_df, **kw).collect()}
        assert set(fused) == has_path
        assert all(abs(fused[i] - expected[i]) < 1e-9 for i in fused)


def test_item_knn_matches_pair_sums(rand_df, rand_rows):
    s = brute_pairs(rand_rows)
    target = rand_rows[0][0]
    seen = {i for u, i, _ in rand_rows if u == target}
    expected = defaultdict(float)
    for (a, b), v in s.items():
        if a in seen and b not in seen:
            expected[b] += v
        if b in seen and a not in seen:
            expected[a] += v
    got = {r.itemId: r.predictedScore for r in nb.item_knn_scores(rand_df, target).collect()}
    assert set(got) == set(expected)
    assert all(abs(got[i] - expected[i]) < 1e-9 for i in got)
    top = nb.item_knn(rand_df, target, 5).collect()
    assert len(top) <= 5 and not ({r.itemId for r in top} & seen)
    assert all(0.0 <= r.totalScore <= 5.0 for r in top)


def test_unseen_pair_scores_matches_pairs(rand_df, rand_rows, monkeypatch):
    s = brute_pairs(rand_rows)
    target = rand_rows[0][0]
    seen = {i for u, i, _ in rand_rows if u == target}
    expected = defaultdict(float)
    for (a, b), v in s.items():
        if b not in seen:
            expected[a] += v
    for ranges in (3, 1, 64):
        monkeypatch.setattr(nb, "ITEM_RANGES", ranges)
        got = {r.itemId: r.predictedScore
               for r in nb.unseen_pair_scores_from_ratings(rand_df, target).collect()}
        assert set(got) == set(expected)
        assert all(abs(got[i] - expected[i]) < 1e-9 for i in got)


def test_user_knn_excludes_seen_and_caps(rand_df, rand_rows):
    target = rand_rows[0][0]
    seen = {i for u, i, _ in rand_rows if u == target}
    out = nb.user_knn(rand_df, target, 4).collect()
    assert len(out) <= 4 and not ({r.itemId for r in out} & seen)
    scores = [r.totalScore for r in out]
    assert scores == sorted(scores, reverse=True)


def test_permutation_invariance(spark, rand_rows):
    shuffled = rand_rows[:]
    random.Random(3).shuffle(shuffled)
    a = spark.createDataFrame(rand_rows, "userId long, itemId long, rating double")
    b = spark.createDataFrame(shuffled, "userId long, itemId long, rating double").repartition(5)
    t = rand_rows[0][0]
    ka = [(r.itemId, round(r.totalScore, 9)) for r in nb.user_knn(a, t, 10).collect()]
    kb = [(r.itemId, round(r.totalScore, 9)) for r in nb.user_knn(b, t, 10).collect()]
    assert ka == kb


def test_topn_per_user_at_most_n(rand_df):
    out = topn_per_user(rand_df, 3, score="rating").collect()
    per = defaultdict(list)
    for r in out:
        per[r.userId].append(r)
    assert all(len(v) <= 3 for v in per.values())
    assert all([x.rank for x in sorted(v, key=lambda x: x.rank)] == list(range(1, len(v) + 1))
               for v in per.values())


def test_index_ids_contiguous(rand_df):
    for method in ("sorted", "frequency"):
        m = pr.index_ids(rand_df, "itemId", method=method, partitions=3).collect()
        idx = sorted(r.itemId_index for r in m)
        assert idx == list(range(len(m)))
    m = {r.itemId_original: r.itemId_index for r in pr.index_ids(rand_df, "itemId").collect()}
    assert [m[k] for k in sorted(m)] == list(range(len(m)))


def test_sampling_is_deterministic(rand_df):
    a = sorted(pr.sample_fraction(rand_df, 0.4, ["userId", "itemId"], 42).collect())
    b = sorted(pr.sample_fraction(rand_df.repartition(7), 0.4, ["userId", "itemId"], 42).collect())
    assert a == b and 0 < len(a) < rand_df.count()
    n = pr.sample_n(rand_df, 17, ["userId", "itemId"], 42).collect()
    assert len(n) == 17
    split = pr.train_test_split(rand_df, ["userId", "itemId"], 0.2, 42)
    assert {r.split for r in split.collect()} == {"train", "test"}


def test_cap_and_dedupe(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 1, "b"), (1, 2, "c"), (2, 5, "d"), (1, 1, "a")],
                               "u int, t int, x string")
    out = sorted(pr.cap_per_user(df, 2, "u", ["t", "x"]).collect())
    assert [(r.u, r.t, r.x) for r in out] == [(1, 1, "a"), (1, 1, "b"), (2, 5, "d")]
    d = pr.dedupe_pairs(df, ["u"], ["t"]).collect()
    assert sorted((r.u, r.t, r.x) for r in d) == [(1, 3, "a"), (2, 5, "d")]


def test_gradient_descent_loss_falls_and_repeats(spark, rand_df):
    U0 = fz.mf_init(rand_df, "userId", 4, 1)
    M0 = fz.mf_init(rand_df, "itemId", 4, 1)
    loss0 = fz.mf_loss(rand_df, U0, M0, 4).first().loss
    U, M = fz.mf_gradient(rand_df, rank=4, iterations=5, seed=1)
    loss5 = fz.mf_loss(rand_df, U, M, 4).first().loss
    assert loss5 < loss0
    U2, _ = fz.mf_gradient(rand_df, rank=4, iterations=5, seed=1)
    a = {r.id: r.features for r in U.collect()}
    b = {r.id: r.features for r in U2.collect()}
    assert a.keys() == b.keys() and all(np.allclose(a[i], b[i], rtol=1e-12) for i in a)
    target = rand_df.first().userId
    recs = fz.recommend_from_factors(M, fz.user_vector(U, target), rand_df, target, 5).collect()
    assert all(0.0 <= r.totalScore <= 5.0 for r in recs)


def test_user_knn_for_a_set_with_heavy_items_and_users(spark):
    """One item that a third of all ratings are of, one user with very many:
    the same lists as user by user, and no task with a large share."""
    rows = [(u, 0, 1.0 + u % 5) for u in range(400)]
    rows += [(u, 1 + (u * 7 + k) % 60, 1.0 + (u + k) % 5) for u in range(400) for k in range(2)]
    rows += [(7, i, 3.0) for i in range(100, 300)]
    df = spark.createDataFrame(sorted({r[:2]: r for r in rows}.values()),
                               "userId long, itemId long, rating double")
    users = spark.createDataFrame([(3,), (7,), (50,), (999,)], "userId long")
    for share in (1, 10, 1000):  # nothing heavy, one item and one user, all
        got = defaultdict(list)
        for r in nb.user_knn_for(df, users, 6, share=share).collect():
            got[r.userId].append((r["rank"], r.itemId, round(r.totalScore, 9)))
        for u in (3, 7, 50):
            one = nb.user_knn(df, u, 6).collect()
            assert sorted(got[u]) == [(k + 1, r.itemId, round(r.totalScore, 9)) for k, r in enumerate(one)]
        assert set(got) == {3, 7, 50}
    # what the blocks hold: with 30 ratings each, no task sees a tenth of them
    heavy = nb._heavy(df, "itemId", 10)
    assert [r.itemId for r in heavy.collect()] == [0]
    own = df.where("userId in (3, 7, 50)").selectExpr("userId as target", "itemId", "rating as t_rating")
    block = nb._block_sums
    table = pa.table({"userId": list(range(30)), "itemId": [0] * 30, "rating": [2.0] * 30})
    want = pa.table({"target": [3, 50], "item": [0, 0], "t_rating": [4.0, 1.0]})
    out = block(table, want).to_pylist()
    assert len(out) == 59 and {(r["dot"], r["tt"], r["uu"]) for r in out} == {(8.0, 16.0, 4.0), (2.0, 1.0, 4.0)}
    a = {(r.target, r.userId): (r.dot, r.tt, r.uu) for r in nb.shared_item_sums(df, own, heavy, 30).collect()}
    b = {(r.target, r.userId): (r.dot, r.tt, r.uu) for r in nb.shared_item_sums(df, own, heavy.limit(0)).collect()}
    assert a == b and len(a) == 3 * 399


def test_descent_round_equals_plain_sums(spark, rand_df, rand_rows):
    """One round against sums written out; also over many small blocks."""
    rank, lam, alpha = 3, 0.1, 0.01
    U = {r.id: np.array(r.features) for r in fz.mf_init(rand_df, "userId", rank, 1).collect()}
    M = {r.id: np.array(r.features) for r in fz.mf_init(rand_df, "itemId", rank, 1).collect()}
    grads = {}
    for u, i, x in rand_rows:
        e = x - U[u] @ M[i]
        grads.setdefault(("u", u), []).append(-2 * e * M[i] + 2 * lam * U[u])
        grads.setdefault(("m", i), []).append(-2 * e * U[u] + 2 * lam * M[i])
    own = {"u": U, "m": M}
    start = fz.stack_factors(*(fz.mf_init(rand_df, k, rank, 1) for k in ("userId", "itemId")))
    for kw in ({}, {"block_rows": 7, "min_blocks": 3}):
        got = fz.mf_step(start, fz.rating_blocks(rand_df, **kw), rank, lam, alpha).collect()
        assert len(got) == len(grads)
        for r in got:
            want = own[r.side][r.id] - alpha * np.mean(grads[r.side, r.id], axis=0)
            np.testing.assert_allclose(r.features, want, rtol=1e-12)


def test_descent_moves_no_ratings(spark, rand_df):
    blocks = fz.rating_blocks(rand_df)
    factors = fz.stack_factors(*(fz.mf_init(rand_df, k, 3, 1) for k in ("userId", "itemId")))
    plan = fz.mf_step(factors, blocks, 3)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    scan = next(k for k, x in enumerate(lines) if "FileScan" in x and "rating#" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    above, level = [], depth(lines[scan])
    for x in reversed(lines[:scan]):
        if depth(x) < level:
            above.append(x)
            level = depth(x)
    under_cogroup = above[:next(k for k, x in enumerate(above) if "FlatMapCoGroups" in x)]
    assert not any("Exchange" in x for x in under_cogroup), plan


def test_a_heavy_user_is_dealt_over_blocks(spark):
    rows = [(1, i, 3.0) for i in range(2000)] + [(u, u % 50, 4.0) for u in range(2, 4002)]
    df = spark.createDataFrame(rows, "userId long, itemId long, rating double")
    sizes = [r["count"] for r in fz.rating_blocks(df, 500, 8).ratings.groupBy("block").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 2.5 * 6000 / len(sizes)


def test_descent_in_parts_equals_blocks_and_exchanges_nothing(spark, monkeypatch):
    """Ratings beyond the blocks are dealt into parts: the same factors, with no
    Python and no exchange in a round, one task per side and part, also with a
    user of a third of all ratings and a null id."""
    rows = [(1, i, 1.0 + i % 5) for i in range(60)]
    rows += [(u, (u * 7 + k) % 60, 1.0 + (u + k) % 5) for u in range(2, 42) for k in range(3)]
    df = spark.createDataFrame(rows, "userId int, itemId long, rating double")
    parts = fz.rating_parts(df.union(spark.createDataFrame([(None, 3, 2.0)], df.schema)),
                            part_rows=60, min_parts=2)
    assert parts.parts == 4 and parts.by_item.where("userId is not null").count() == len(rows)
    assert isinstance(fz.deal_ratings(df, len(rows)), fz.RatingBlocks)
    assert isinstance(fz.deal_ratings(df, len(rows) - 1), fz.RatingParts)

    def values(factors):
        return {(r.side, r.id): r.features for r in factors.collect()}
    start = fz.stack_factors(*(fz.mf_init(df, k, 3, 1) for k in ("userId", "itemId")))
    want = values(fz.mf_step(start, fz.rating_blocks(df), 3))
    got = values(fz.mf_step(start, parts, 3))
    assert got.keys() == want.keys()
    assert all(np.allclose(got[k], want[k], rtol=1e-12) for k in want)
    key = "spark.sql.maxSinglePartitionBytes"
    before = spark.conf.get(key)
    stored = fz.part_factors(start, 4)
    try:
        spark.conf.set(key, "1")
        with recorded() as plans:
            fz.part_step(stored, parts, 3)
        assert spark.conf.get(key).startswith("1")
    finally:
        spark.conf.set(key, before)
    plan = next(p for p in plans if "SortMergeJoin" in p)
    assert "Exchange" not in plan and "Arrow" not in plan and "Python" not in plan
    assert fz.part_updates(stored, parts, 3).rdd.getNumPartitions() == 8
    U, M = fz.mf_gradient(df, 3, 3, seed=1)
    monkeypatch.setattr(fz, "deal_ratings", lambda r: parts)
    U2, M2 = fz.mf_gradient(df, 3, 3, seed=1)
    for a, b in ((U, U2), (M, M2)):
        a, b = ({r.id: r.features for r in x.collect()} for x in (a, b))
        assert a.keys() == b.keys() and all(np.allclose(a[i], b[i], rtol=1e-12) for i in a)


def test_als_recommend_shape(rand_df):
    t = rand_df.first().userId
    seen = {r.itemId for r in rand_df.filter(F.col("userId") == t).collect()}
    out = fz.als_recommend(rand_df, t, 5, rank=3, max_iter=3).collect()
    assert len(out) <= 5 and not ({r.itemId for r in out} & seen)
    assert all(0.0 <= r.totalScore <= 5.0 for r in out)
    assert fz.als_recommend(rand_df, 10_000, 5, rank=3, max_iter=2).count() == 0


def test_exclude_seen(spark):
    from reelrank.operators.ratings import exclude_seen
    cand = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "userId long, itemId long")
    seen = spark.createDataFrame([(1, 10), (1, 10), (2, 12)], "userId long, itemId long")
    assert sorted(exclude_seen(cand, seen).collect()) == [(1, 11), (2, 10)]
    assert sorted(exclude_seen(cand, seen, max_broadcast_rows=0).collect()) == [(1, 11), (2, 10)]


def test_hot_item_splits_user_blocks(spark):
    """One item rated by every user: its block exceeds the row budget, so
    tiles split by user blocks; results stay exact."""
    rows = [(u, 0, 1.0 + u % 5) for u in range(60)] + random_ratings(11, users=60, items=12, n=150)
    rows = sorted({(u, i): (u, i, r) for u, i, r in rows}.values())
    df = spark.createDataFrame(rows, "userId long, itemId long, rating double")
    expected = brute_pairs(rows)
    got = {(r.item1, r.item2): r.similarity
           for r in nb.item_similarity(df, max_block_items=6, max_tile_rows=40).collect()}
    assert set(got) == set(expected)
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)


def test_sized_broadcast_bounds(spark):
    from reelrank.sizing import broadcast_row_bound, row_bytes, sized_broadcast
    df = spark.range(100).selectExpr("id", "array(1.0D, 2.0D) AS f")
    assert row_bytes(df.schema) == 8 + 16 + 10 * 8
    assert broadcast_row_bound(df, max_rows=50) == 50
    assert broadcast_row_bound(df, max_rows=10**9, max_bytes=1120) == 10
    hinted = sized_broadcast(df, max_rows=100)._jdf.queryExecution().analyzed().toString()
    plain = sized_broadcast(df, max_rows=99)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted.lower() and "broadcast" not in plain.lower()


def test_rating_rmse_train_below_holdout(rand_df):
    test = fz.rating_rmse(rand_df, rank=3, max_iter=5).first()
    train = fz.rating_rmse(rand_df, rank=3, max_iter=5, holdout=False).first()
    assert train.n_test == rand_df.count() and 0 < test.n_test < train.n_test
    assert train.rmse < test.rmse


def test_unseen_pairs_use_no_tiles(monkeypatch, rand_df, rand_rows):
    def no_tiles(*_):
        raise AssertionError("tiles planned")
    from reelrank.operators import item_pairs
    monkeypatch.setattr(item_pairs, "_tiles", no_tiles)
    assert nb.unseen_pair_scores_from_ratings(rand_df, rand_rows[0][0]).count() > 0


def test_plans_do_not_depend_on_cores(monkeypatch, rand_df, rand_rows):
    """The number of tiles and the operators of both plans are the same on 4,
    64 and 1000 cores."""
    import re

    from pyspark import SparkContext

    def shape(df):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        return re.sub(r"ExistingRDD.*", "", re.sub(r"#\d+L?|plan_id=\d+|@\w+|(?<=lambda x)_\d+", "", text))

    target, seen = rand_rows[0][0], set()
    q = nb.normalized_ratings(rand_df)
    for cores in (4, 64, 1000):
        monkeypatch.setattr(SparkContext, "defaultParallelism", property(lambda _, n=cores: n))
        seen.add((shape(nb.item_pair_stats(q)), shape(nb.unseen_pair_scores_from_ratings(rand_df, target))))
    assert len(seen) == 1


def test_als_blocks_do_not_grow_with_the_root_of_the_ratings():
    # each factor goes to every block that rates it, in every half round
    assert [fz.als_blocks(n) for n in (0, 300_000, 500_000, 36_000_000, 216_000_000)] == [1, 1, 2, 5, 5]
    assert fz.als_blocks(10**9) == 20  # a block stays bounded


def test_als_residuals_sum_in_place(spark, rand_df):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = fz.als_residuals(rand_df, rank=3, max_iter=3)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan[:plan.index("Join")]  # sums by user follow the join by user
    assert all(r.residual < 1e-3 for r in out.collect())


def test_als_fit_predict_indexes_once(rand_df):
    plan = fz.als_fit_predict(rand_df, rank=3, max_iter=2)._jdf.queryExecution().optimizedPlan().toString()
    assert "userId_original" not in plan  # the indexed ratings are read, not joined again


def test_a_large_lexicon_sends_its_common_tokens_to_the_texts(spark):
    from reelrank.operators import sentiment as se
    texts = spark.createDataFrame(
        [(d, " ".join(f"w{chr(97 + (d * k + k * k) % 26)}{chr(97 + k % (1 + d % 9))}" + "!" * (k % 5 == 0)
                      for k in range(40))) for d in range(50)] + [(50, None), (51, ""), (None, "wa wb. wc")],
        "doc_id long, text string")
    lex = se.polarity_lexicon(texts, texts.selectExpr("doc_id", "int(doc_id % 2) quality"))
    n = lex.count()
    rows = lambda *a, **k: sorted(
        ((r.doc_id or -1, r.pos, r.n_chars, r.n_tokens, round(r.polarity, 9), r["class"], r.label)
         for r in se.sentence_scores(texts, *a, **k).collect()))
    want = rows(lex)
    assert n > 60 and len(want) > 300
    for bound in (1, n // 3, n - 1):
        head, tail = se.split_lexicon(lex, bound)
        assert head.count() <= bound and head.count() + tail.count() == n
        assert rows(lex, max_broadcast_rows=bound) == want
        assert rows(lex.select("token", "polarity"), max_broadcast_rows=bound) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = se.sentence_scores(texts, lex, max_broadcast_rows=n - 1)._jdf.queryExecution()
        assert plan.executedPlan().toString().count("BroadcastHashJoin") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_user_knn_for_has_tasks_by_the_rows_it_makes(rand_df, monkeypatch):
    users = rand_df.select("userId").distinct()
    rows = lambda: sorted((r.userId, r.itemId, round(r.totalScore, 9), r.rank)
                          for r in nb.user_knn_for(rand_df, users, 6).collect())
    want = rows()
    pairs = rand_df.alias("a").join(rand_df.alias("b"), "itemId").count()
    assert nb._join_parts(rand_df, rand_df, "itemId") == nb.JOIN_PARTS
    monkeypatch.setattr(nb, "JOIN_ROWS", pairs // 20)
    assert nb._join_parts(rand_df, rand_df, "itemId") in (20, 21)
    plan = nb.user_knn_for(rand_df, users, 6)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [target" in plan and rows() == want and want
