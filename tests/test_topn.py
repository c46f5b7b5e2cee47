"""Exact inner-product search against every product."""

import numpy as np
import pytest

from reelrank.operators import factorize as fz
from reelrank.operators.topn import top_items


def factors(seed, ids, rank=4, spread=3.0):
    rng = np.random.default_rng(seed)
    # norms differ widely, so that blocks can be skipped; whole numbers tie
    out = {i: np.round(rng.normal(size=rank) * rng.lognormal(0, spread / 3), 1) for i in ids}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows.items()],
                                 "id long, features array<double>")


def brute(users, items, seen, n, positive):
    out = set()
    for u, v in users.items():
        scores = sorted((-round(float(v @ w), 9), i) for i, w in items.items() if (u, i) not in seen)
        scores = [x for x in scores if not positive or x[0] < 0][:n]
        out |= {(u, i, r + 1) for r, (_, i) in enumerate(scores)}
    return out


@pytest.mark.parametrize("n,positive,block", [(3, False, 16), (5, True, 7), (1, False, 1), (400, False, 16)])
def test_equals_every_product(spark, n, positive, block):
    users, items = factors(1, range(0, 60)), factors(2, range(1000, 1300))
    items[5] = items[1000]  # a tie
    rng = np.random.default_rng(3)
    seen = {(int(u), int(i)) for u, i in zip(rng.integers(0, 60, 900), rng.integers(1000, 1300, 900))}
    seen |= {(7, i) for i in items}  # one user has rated everything
    pairs = spark.createDataFrame(sorted(seen), "userId long, itemId long")
    got = top_items(frame(spark, users), frame(spark, items), pairs, n, positive, block, 25)
    rows = {(r.userId, r.itemId, r["rank"]) for r in got.rows.collect()}
    assert rows == brute(users, items, seen, n, positive)
    assert got.pairs == 60 * -(-301 // block)
    if n <= 5:
        assert got.skipped > 0.2 * got.pairs  # most items are never scored for most users


def test_no_users_and_no_items(spark):
    some, none = frame(spark, factors(1, range(3))), frame(spark, factors(1, range(3))).limit(0)
    seen = spark.createDataFrame([], "userId long, itemId long")
    for u, i in ((none, some), (some, none)):
        assert top_items(u, i, seen, 3).rows.count() == 0


def test_one_user_as_for_a_set(spark):
    users, items = factors(4, range(5)), factors(5, range(100, 160))
    ratings = spark.createDataFrame([(2, 101, 3.0), (2, 140, 1.0), (3, 100, 2.0)],
                                    "userId long, itemId long, rating double")
    U, M = frame(spark, users), frame(spark, items)
    wanted = spark.createDataFrame([(2,), (2,), (99,)], "userId long")
    got = {(r.itemId, r.totalScore) for r in fz.recommend_for(wanted, U, M, ratings, 9).collect()}
    one = fz.recommend_from_factors(M, fz.user_vector(U, 2), ratings, 2, 9).collect()
    assert got == {(r.itemId, r.totalScore) for r in one} and len(got) == 9
