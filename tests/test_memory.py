"""What tasks and executors hold in memory."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from reelrank.operators import factorize as fz, topn


def test_als_caches_no_ratings_in_memory(spark, monkeypatch):
    from pyspark.ml.recommendation import ALS
    ratings = spark.range(400).select((F.col("id") % 20).alias("userId"), (F.col("id") % 37).alias("itemId"),
                                      (F.col("id") % 5 + 1.0).alias("rating")).dropDuplicates(["userId", "itemId"])
    fits, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, data: fits.append(self) or fit(self, data))
    model = fz.als_fit(ratings, rank=2, max_iter=3)
    assert model.userFactors.count() == 20
    # blocks of ratings are not kept in the heap that the next ones are built in,
    # and shuffles go before all rounds are done
    assert [a.getIntermediateStorageLevel() for a in fits] == ["DISK_ONLY"]
    assert 0 < fits[0].getCheckpointInterval() <= 2


def test_scores_of_a_block_are_held_a_slice_at_a_time():
    rng = np.random.default_rng(1)
    u, m, n = rng.normal(size=(1500, 3)), rng.normal(size=(2000, 3)), 4
    rated = [(int(a), int(b)) for a, b in zip(rng.integers(0, 1500, 6000), rng.integers(0, 2000, 6000))]
    rated = sorted(set(rated) | {(7, b) for b in range(2000)}, key=lambda r: r[1])
    kinds = [0] * 1500 + [1] * len(rated)
    users = pa.table({
        "kind": pa.array(kinds, pa.int32()), "user": pa.array([*range(1500), *(r[0] for r in rated)], pa.int64()),
        "features": pa.array([*u.tolist(), *[None] * len(rated)], pa.list_(pa.float64())),
        "item": pa.array([*[None] * 1500, *(r[1] for r in rated)], pa.int64())})
    items = pa.table({"itemId": pa.array(range(2000), pa.int64()), "features": pa.array(m.tolist(), pa.list_(pa.float64()))})
    run = topn._score_task(n, False)

    def best(held):
        topn.HELD_SCORES = held
        return run(users, items)

    before = topn.HELD_SCORES
    try:
        whole, few = best(10**9), best(300_000)
        tracemalloc.start()
        run(users, items)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    finally:
        topn.HELD_SCORES = before
    assert before <= 2_000_000 and peak < 1500 * 2000 * 8  # less than one matrix of all scores
    for t in (whole, few):
        scores = u @ m.T
        scores[tuple(zip(*rated))] = -np.inf
        rank = np.lexsort((np.broadcast_to(np.arange(2000), scores.shape), -np.round(scores, 9)))[:, :n]
        expected = {(a, int(b)) for a in range(1500) for b in rank[a] if scores[a, b] > -np.inf}
        assert {(r["userId"], r["itemId"]) for r in t.to_pylist()} == expected and t.num_rows == 1499 * n
