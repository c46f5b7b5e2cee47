"""Matrix factorization: Spark ML ALS, and gradient descent on factor
DataFrames (averaged per-id gradients, lineage cut every round)."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reelrank.functions.hashing import unit_hash
from reelrank.functions.scalar import clamp_score, dot_literal, round_score
from reelrank.operators.prepare import apply_index, index_ids, train_test_split
from reelrank.operators.rank import top_n
from reelrank.operators.ratings import exclude_seen
from reelrank.operators.topn import top_items
from reelrank.session import cut_lineage, tasks_kept_whole, write_bucketed
from reelrank.sizing import (DEFAULT_BROADCAST_ROWS, block_count, broadcast_row_bound,
                             sized_broadcast)

USER, ITEM, RATING = "userId", "itemId", "rating"
# A factor row carries rank doubles (~100 bytes at rank 10): a tighter
# broadcast bound than for key-only tables.
FACTOR_BROADCAST_ROWS = 500_000
# Ratings per ALS block on either side: blocks pair up, so there are as many
# of them as the square root of the ratings over this. Each half of a round
# sends a factor to every block that rates it: more than ALS_BLOCKS only where
# a block would hold more than ALS_MOST_ROWS ratings.
ALS_BLOCK_ROWS, ALS_BLOCKS, ALS_MOST_ROWS = 100_000, 5, 50_000_000
# Rounds between two checkpoints of ALS, which delete the shuffles before them.
ALS_ROUNDS = 2
# Ratings of one block of gradient descent, and blocks at least.
MF_BLOCK_ROWS, MF_MIN_BLOCKS = 1_000_000, 8
# More ratings than these blocks hold are dealt into parts instead, of so many
# ratings and factors; the ratings of a part are written by so many tasks.
MF_PART_ROWS, MF_PART_FACTORS, MF_PART_TASKS = 10_000_000, 500_000, 4
# buckets at most (Spark's own limit is twice that); a bucket may hold several blocks
MAX_BUCKETS = 50_000
REC_SCHEMA = "userId long, itemId long, totalScore double"


# ---------------------------------------------------------------------- ALS

def als_blocks(n_rows: int) -> int:
    """Blocks of either side, from the number of ratings."""
    few = min(math.isqrt(block_count(n_rows, ALS_BLOCK_ROWS)), ALS_BLOCKS)
    return max(1, few, block_count(n_rows, ALS_MOST_ROWS))


def als_fit(ratings: DataFrame, rank: int = 10, max_iter: int = 10, reg: float = 0.1,
            seed: int = 42, blocks: int | None = None):
    """Explicit-feedback ALS. Ids must fit in 32 bits (the cast fails
    loudly under ANSI otherwise; run ``index_ids`` first for other ids). Its
    blocks of ratings are kept on disk: cached ones would hold heap that the
    next blocks are built in, which Spark does not count against them."""
    from pyspark.ml.recommendation import ALS

    spark = ratings.sparkSession
    blocks = blocks or als_blocks(ratings.count())
    data = ratings.select(F.col(USER).cast("int").alias(USER),
                          F.col(ITEM).cast("int").alias(ITEM),
                          F.col(RATING).cast("float").alias(RATING))
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed,
              userCol=USER, itemCol=ITEM, ratingCol=RATING,
              coldStartStrategy="drop", numUserBlocks=blocks, numItemBlocks=blocks,
              checkpointInterval=ALS_ROUNDS, intermediateStorageLevel="DISK_ONLY")
    return als.fit(data)


def user_vector(factors: DataFrame, target: int):
    """The target's factor vector (one row of ``rank`` numbers) or None."""
    row = factors.filter(F.col("id") == F.lit(target)).select("features").first()
    return None if row is None else [float(x) for x in row["features"]]


def recommend_from_factors(item_factors: DataFrame, vec, ratings: DataFrame, target: int,
                           n: int, positive_only: bool = False,
                           max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Score every item for one user (a projection over the item factors
    with the user's vector as literals: no join, no cartesian product),
    drop items the user rated, keep the top ``n``, clamp to [0, 5] and
    round HALF_UP to 2 digits."""
    spark = ratings.sparkSession
    if vec is None:
        return spark.createDataFrame([], REC_SCHEMA)
    scores = item_factors.select(F.col("id").cast("long").alias(ITEM),
                                 dot_literal("features", vec).alias("score"))
    cand = exclude_seen(scores, ratings.filter(F.col(USER) == F.lit(target)), [ITEM],
                        max_broadcast_rows)
    if positive_only:
        cand = cand.filter(F.col("score") > 0)
    return (top_n(cand, n, "score", ITEM)
            .select(F.lit(target).cast("long").alias(USER), ITEM,
                    round_score(clamp_score("score"), 2).alias("totalScore")))


def recommend_for(users: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
                  ratings: DataFrame, n: int, positive_only: bool = False) -> DataFrame:
    """The same for every user of ``users`` (userId): userId, itemId,
    totalScore, rank, by exact inner-product search. Users without factors
    get no rows."""
    double = F.col("features").cast("array<double>").alias("features")
    wanted = users.select(F.col(USER).alias("id")).distinct()
    found = top_items(user_factors.select("id", double).join(wanted, "id", "left_semi"),
                      item_factors.select("id", double), ratings, n, positive_only)
    return found.rows.select(USER, ITEM, round_score(clamp_score("score"), 2).alias("totalScore"),
                             F.col("rank").cast("long").alias("rank"))


def als_recommend_for(ratings: DataFrame, users: DataFrame, n: int, rank: int = 10,
                      max_iter: int = 10, reg: float = 0.1, seed: int = 42) -> DataFrame:
    """ALS trained on every rating, then the top ``n`` unseen items of every
    user of ``users``."""
    model = als_fit(ratings, rank, max_iter, reg, seed)
    return recommend_for(users, model.userFactors, model.itemFactors, ratings, n)


def als_recommend(ratings: DataFrame, target: int, n: int, rank: int = 10,
                  max_iter: int = 10, reg: float = 0.1, seed: int = 42) -> DataFrame:
    """ALS trained on every rating, then the top ``n`` unseen items for
    ``target`` (seen items are removed before the cut, not after)."""
    model = als_fit(ratings, rank, max_iter, reg, seed)
    return recommend_from_factors(model.itemFactors, user_vector(model.userFactors, target),
                                  ratings, target, n)


def als_residuals(ratings: DataFrame, rank: int = 10, max_iter: int = 10, reg: float = 0.1,
                  seed: int = 42) -> DataFrame:
    """userId, residual: the largest entry of (sum m m' + reg n I) u - sum r m
    over a user's ratings, relative to the largest entry of sum |r m|."""
    ratings = cut_lineage(ratings.select(USER, ITEM, RATING))
    model = als_fit(ratings, rank, max_iter, reg, seed)
    u = model.userFactors.select(F.col("id").cast("long").alias(USER), F.col("features").alias("u"))
    m = model.itemFactors.select(F.col("id").cast("long").alias(ITEM), F.col("features").alias("m"))
    # users last: the sums by user find their rows in place
    rows = ratings.join(m, ITEM).join(u, USER).withColumn(
        "e", _dot(F.col("u"), F.col("m"), rank) - F.col(RATING))
    sums = rows.groupBy(USER).agg(
        F.count(F.lit(1)).alias("n"), F.first("u").alias("u"),
        *[F.sum(F.col("e") * F.col("m")[k]).alias(f"g{k}") for k in range(rank)],
        *[F.sum(F.abs(F.col(RATING) * F.col("m")[k])).alias(f"s{k}") for k in range(rank)])
    left = F.greatest(*[F.abs(F.col(f"g{k}") + F.lit(reg) * F.col("n") * F.col("u")[k])
                        for k in range(rank)])
    return sums.select(USER, (left / F.greatest(*[F.col(f"s{k}") for k in range(rank)]))
                       .alias("residual"))


def als_fit_predict(ratings: DataFrame, rank: int = 10, max_iter: int = 10,
                    reg: float = 0.1, seed: int = 42) -> DataFrame:
    """Index users and items by frequency (distributed), fit ALS on the
    indices, predict every rating row (cold-start rows dropped).
    userId, itemId, rating, prediction."""
    users = index_ids(ratings, USER, method="frequency")
    items = index_ids(ratings, ITEM, method="frequency")
    # the model keeps further columns: the original ids travel along
    own = ratings.select(USER, ITEM, RATING, F.col(USER).alias("_u"), F.col(ITEM).alias("_i"))
    # read by the count, the fit and the prediction: written once
    indexed = cut_lineage(apply_index(apply_index(own, users, USER), items, ITEM).withColumns(
        {USER: F.col(USER).cast("int"), ITEM: F.col(ITEM).cast("int")}))
    model = als_fit(indexed, rank, max_iter, reg, seed)
    return model.transform(indexed).select(
        F.col("_u").alias(USER), F.col("_i").alias(ITEM), RATING,
        F.col("prediction").cast("double").alias("prediction"))


def rating_rmse(ratings: DataFrame, test_fraction: float = 0.2, seed: int = 42,
                rank: int = 10, max_iter: int = 10, reg: float = 0.1,
                holdout: bool = True) -> DataFrame:
    """Hold out a seeded hash split, train ALS on the rest, report the
    RMSE on the held-out rows: rmse, n_test, and n_cold for the held-out rows
    whose user or item the training part lacks. ``holdout=False`` trains and
    evaluates on every row (a training error, as the reference printed)."""
    if holdout:
        split = train_test_split(ratings, [USER, ITEM], test_fraction, seed)
        train = split.filter(F.col("split") == "train").drop("split")
        test = split.filter(F.col("split") == "test").drop("split")
    else:
        train = test = ratings
    model = als_fit(train, rank, max_iter, reg, seed).setColdStartStrategy("nan")
    pred = model.transform(test.select(F.col(USER).cast("int").alias(USER),
                                       F.col(ITEM).cast("int").alias(ITEM), RATING))
    cold = F.isnan("prediction")
    err = F.when(~cold, F.col(RATING) - F.col("prediction"))
    return pred.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.count(err).alias("n_test"),
                    F.count_if(cold).alias("n_cold"))


# ---------------------------------------------------------- gradient descent

def _start(key: str, rank: int, seed: int) -> Column:
    salt = 0 if key == USER else 7919
    return F.array(*[unit_hash(["id", F.lit(k)], seed + salt) for k in range(rank)])


def mf_init(ratings: DataFrame, key: str, rank: int = 10, seed: int = 42) -> DataFrame:
    """id, features: uniform [0, 1) start factors from a hash of
    (seed, id, position), so a retried task rebuilds the same values."""
    ids = ratings.select(F.col(key).alias("id")).distinct()
    return ids.select("id", _start(key, rank, seed).alias("features"))


def _dot(a: Column, b: Column, rank: int) -> Column:
    out = a[0] * b[0]
    for k in range(1, rank):
        out = out + a[k] * b[k]
    return out


def _errors(ratings: DataFrame, U: DataFrame, M: DataFrame, rank: int) -> DataFrame:
    u = U.select(F.col("id").alias(USER), F.col("features").alias("u"))
    m = M.select(F.col("id").alias(ITEM), F.col("features").alias("m"))
    return (ratings.select(USER, ITEM, RATING).join(u, USER).join(m, ITEM)
            .select(USER, ITEM, "u", "m",
                    (F.col(RATING) - _dot(F.col("u"), F.col("m"), rank)).alias("e")))


@dataclass
class RatingBlocks:
    """Ratings dealt into blocks once (block, userId, itemId, rating), and
    the blocks that read each factor (side, id, reader)."""
    ratings: DataFrame
    routes: DataFrame


def rating_blocks(ratings: DataFrame, block_rows: int = MF_BLOCK_ROWS,
                  min_blocks: int = MF_MIN_BLOCKS, written: bool = False) -> RatingBlocks:
    """Blocks of about ``block_rows`` ratings, by user; the ratings of a user
    that would fill a quarter of a block are dealt by item too. Both tables
    are bucketed by what they are joined on, so that a round of descent moves
    factors and gradients, never ratings. ``written``: the ratings are a
    written table already."""
    spark = ratings.sparkSession
    if not written:
        ratings = cut_lineage(ratings.select(USER, ITEM, RATING))
    blocks = max(block_count(ratings.count(), block_rows), min_blocks)
    heavy = sized_broadcast(ratings.groupBy(USER).count().where(F.col("count") > block_rows // 4)
                            .select(USER, F.lit(1).alias("_heavy")), materialize=True)
    part = F.when(F.col("_heavy").isNull(), F.xxhash64(USER)).otherwise(F.xxhash64(USER, ITEM))
    buckets = min(max(blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))), MAX_BUCKETS)
    dealt = write_bucketed(ratings.join(heavy, USER, "left").select(
        F.pmod(part, F.lit(blocks)).cast("int").alias("block"), USER, ITEM, RATING),
        "rating_blocks", buckets, ("block",))
    ends = [dealt.select(F.lit(side).alias("side"), F.col(key).alias("id"),
                         F.col("block").alias("reader")).distinct()
            for side, key in (("u", USER), ("m", ITEM))]
    routes = write_bucketed(ends[0].union(ends[1]), "rating_routes", buckets, ("side", "id"))
    return RatingBlocks(dealt, routes)


@dataclass
class RatingParts:
    """Ratings written twice, in a folder per part of the users and in one per
    part of the items, each bucketed by the other id (part, userId, itemId,
    rating). ``parts`` is the number of parts and of buckets."""
    by_user: DataFrame
    by_item: DataFrame
    parts: int


def _part(key: str, parts: int) -> Column:
    """The part of an id: its bucket, so that a part's factors are one bucket."""
    return F.pmod(F.hash(key), F.lit(parts)).cast("int")


def rating_parts(ratings: DataFrame, part_rows: int = MF_PART_ROWS,
                 part_factors: int = MF_PART_FACTORS,
                 min_parts: int = MF_MIN_BLOCKS) -> RatingParts:
    """Parts of about ``part_rows`` ratings and ``part_factors`` users or items
    at most. Ratings move here only; afterwards a part's task reads the factors
    of the other side from their table."""
    ratings = ratings.select(F.col(USER).cast("long").alias(USER),
                             F.col(ITEM).cast("long").alias(ITEM), RATING)
    size = ratings.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(USER).alias("u"),
                       F.approx_count_distinct(ITEM).alias("m")).first()
    parts = min(max(block_count(size["n"], part_rows), min_parts,
                    block_count(max(size["u"], size["m"]), part_factors)), MAX_BUCKETS)
    by_user, by_item = (
        write_bucketed(ratings.withColumn("part", _part(key, parts)), "rating_parts", parts,
                       (other,), ("part",), parts * MF_PART_TASKS)
        for key, other in ((USER, ITEM), (ITEM, USER)))
    return RatingParts(by_user, by_item, parts)


def deal_ratings(ratings: DataFrame, most: int = MF_MIN_BLOCKS * MF_BLOCK_ROWS):
    """``rating_blocks`` for up to ``most`` ratings, beyond them ``rating_parts``:
    with many blocks an item's factors and gradients go to nearly as many blocks
    as it has ratings, while the parts exchange nothing in a round."""
    ratings = cut_lineage(ratings.select(USER, ITEM, RATING))
    return rating_blocks(ratings, written=True) if ratings.count() <= most else rating_parts(ratings)


def part_factors(factors: DataFrame, parts: int, dealt: bool = False) -> DataFrame:
    """The factor table with a folder per side and part, bucketed by id.
    ``dealt``: its partitions are parts already, nothing moves."""
    rows = factors.select("side", F.col("id").cast("long").alias("id"), "features") \
        .withColumn("part", _part("id", parts))
    return write_bucketed(rows, "factors", parts, ("id",), ("side", "part"), 0 if dealt else None)


def part_updates(factors: DataFrame, dealt: RatingParts, rank: int = 10, lam: float = 0.1,
                 alpha: float = 0.01) -> DataFrame:
    """The next factors from a table of ``part_factors``, one task per side and
    part: its ratings meet the factors of the other side bucket by bucket, then
    those of its own part, and are summed where they are. Errors are computed
    once per side; no ratings, factors or sums are exchanged."""
    def updated(ratings: DataFrame, side: str, part: int) -> DataFrame:
        key, other = (USER, ITEM) if side == "u" else (ITEM, USER)
        theirs = factors.where(F.col("side") != side).select(
            F.col("id").alias(other), F.col("features").alias("other"))
        own = factors.where((F.col("side") == side) & (F.col("part") == part)).select(
            F.col("id").alias(key), F.col("features").alias("own"))
        rows = (ratings.where(F.col("part") == part).select(key, other, RATING)
                .join(theirs.hint("merge"), other).coalesce(1)
                .join(own.coalesce(1).hint("shuffle_hash"), key)
                .select(F.col(key).alias("id"), "own", "other",
                        (F.col(RATING) - _dot(F.col("own"), F.col("other"), rank)).alias("e")))
        sums = rows.groupBy("id").agg(
            F.count(F.lit(1)).alias("n"), *[F.first(F.col("own")[k]).alias(f"f{k}") for k in range(rank)],
            *[F.sum(F.col("e") * F.col("other")[k]).alias(f"s{k}") for k in range(rank)])
        return sums.select(F.lit(side).alias("side"), "id", F.array(*[
            F.col(f"f{k}") - F.lit(alpha) * (F.lit(2.0 * lam) * F.col(f"f{k}")
                                             - F.lit(2.0) * F.col(f"s{k}") / F.col("n"))
            for k in range(rank)]).alias("features"))

    tasks = [updated(ratings, side, part) for part in range(dealt.parts)
             for side, ratings in (("u", dealt.by_user), ("m", dealt.by_item))]
    return reduce(DataFrame.union, tasks)


def part_step(factors: DataFrame, dealt: RatingParts, rank: int = 10, lam: float = 0.1,
              alpha: float = 0.01) -> DataFrame:
    """The round of ``mf_step`` from one table of ``part_factors`` to the next."""
    with tasks_kept_whole(factors.sparkSession):
        return part_factors(part_updates(factors, dealt, rank, lam, alpha), dealt.parts, dealt=True)


def block_gradients(ratings: pa.Table, factors: pa.Table, rank: int, lam: float) -> pa.Table:
    """Sums over one block: for each (side, id) its ratings' number, its own
    factors and the sum of -2*e*other + 2*lam*own, e = r - u.m."""
    side = factors.column("side").to_numpy(zero_copy_only=False) == "u"
    ids = factors.column("id").to_numpy()
    values = factors.column("features").combine_chunks().flatten().to_numpy().reshape(-1, rank)
    place, own, keys = [], [], []
    for mine, key in ((side, USER), (~side, ITEM)):
        order = np.argsort(ids[mine], kind="stable")
        keys.append(ids[mine][order])
        own.append(values[mine][order])
        place.append(np.searchsorted(keys[-1], ratings.column(key).to_numpy()))
    u, m = (o[p] for o, p in zip(own, place))
    e = ratings.column(RATING).to_numpy() - np.einsum("ij,ij->i", u, m)
    columns = {"side": pa.array(np.repeat(["u", "m"], [len(k) for k in keys])),
               "id": pa.array(np.concatenate(keys), pa.int64())}
    n = [np.bincount(p, minlength=len(k)) for p, k in zip(place, keys)]
    columns["n"] = pa.array(np.concatenate(n), pa.int64())
    for k in range(rank):
        columns[f"f{k}"] = pa.array(np.concatenate([o[:, k] for o in own]))
        sums = [np.bincount(p, weights=-2.0 * e * other[:, k], minlength=len(o)) + 2.0 * lam * c * o[:, k]
                for p, other, o, c in zip(place, (m, u), own, n)]
        columns[f"g{k}"] = pa.array(np.concatenate(sums))
    return pa.table(columns)


def mf_step(factors: DataFrame, blocks: RatingBlocks | RatingParts, rank: int = 10,
            lam: float = 0.1, alpha: float = 0.01) -> DataFrame:
    """One round on the stacked factor table (side 'u'/'m', id, features):
    per rating e = r - u.m, a user gradient -2*e*m + 2*lam*u and an item
    gradient -2*e*u + 2*lam*m; both are averaged per (side, id) and applied
    with rate alpha. Factors go to the blocks that read them, each block sums
    its gradients in one Arrow task, and the sums per id meet in one
    aggregate; for ``RatingParts`` see ``part_step``."""
    if isinstance(blocks, RatingParts):
        stored = part_factors(factors, blocks.parts)
        return part_step(stored, blocks, rank, lam, alpha).select("side", "id", "features")

    def run(ratings: pa.Table, own: pa.Table) -> pa.Table:
        return block_gradients(ratings, own, rank, lam)

    schema = "side string, id long, n long, " + ", ".join(
        f"f{k} double, g{k} double" for k in range(rank))
    sent = blocks.routes.join(factors, ["side", "id"])
    sums = (blocks.ratings.groupBy("block").cogroup(sent.groupBy("reader"))
            .applyInArrow(run, schema).groupBy("side", "id").agg(
                F.sum("n").alias("n"), *[F.first(f"f{k}").alias(f"f{k}") for k in range(rank)],
                *[F.sum(f"g{k}").alias(f"g{k}") for k in range(rank)]))
    return sums.select("side", "id", F.array(*[
        F.col(f"f{k}") - F.lit(alpha) * F.col(f"g{k}") / F.col("n") for k in range(rank)])
        .alias("features"))


def stack_factors(U: DataFrame, M: DataFrame) -> DataFrame:
    return (U.select(F.lit("u").alias("side"), "id", "features")
            .unionByName(M.select(F.lit("m").alias("side"), "id", "features")))


def split_factors(factors: DataFrame):
    return (factors.filter(F.col("side") == "u").select("id", "features"),
            factors.filter(F.col("side") == "m").select("id", "features"))


def mf_gradient(ratings: DataFrame, rank: int = 10, iterations: int = 10,
                lam: float = 0.1, alpha: float = 0.01, seed: int = 42):
    """Gradient-descent factorization: (U, M) after ``iterations`` rounds.
    The ratings are dealt into blocks or parts once; each round's factors are
    checkpointed to the shared checkpoint folder, so the plan stays one round
    deep and a lost executor recomputes at most one round."""
    blocks = deal_ratings(ratings)
    if isinstance(blocks, RatingParts):
        factors = part_factors(stack_factors(mf_init(blocks.by_user, USER, rank, seed),
                                             mf_init(blocks.by_item, ITEM, rank, seed)), blocks.parts)
        for _ in range(iterations):
            factors = part_step(factors, blocks, rank, lam, alpha)
        return split_factors(factors)
    factors = blocks.routes.select("side", "id").distinct().select(
        "side", "id", F.when(F.col("side") == "u", _start(USER, rank, seed))
        .otherwise(_start(ITEM, rank, seed)).alias("features"))
    small = factors.count() <= broadcast_row_bound(factors, FACTOR_BROADCAST_ROWS, array_len=rank)
    for _ in range(iterations):
        sent = F.broadcast(factors) if small else factors
        factors = cut_lineage(mf_step(sent, blocks, rank, lam, alpha))
    return split_factors(factors)


def mf_loss(ratings: DataFrame, U: DataFrame, M: DataFrame, rank: int = 10,
            lam: float = 0.1) -> DataFrame:
    """sse = sum(e^2), reg = lam * (|U|^2 + |M|^2), loss = sse + reg: one row."""
    err = _errors(ratings, U, M, rank)

    def sumsq(df: DataFrame) -> Column:
        return df.select(F.sum(F.aggregate("features", F.lit(0.0), lambda a, x: a + x * x))).scalar()

    reg = F.lit(lam) * (sumsq(U) + sumsq(M))
    return (err.agg(F.sum(F.col("e") * F.col("e")).alias("sse"))
            .select("sse", reg.alias("reg"))
            .select("sse", "reg", (F.col("sse") + F.col("reg")).alias("loss")))


def score_items(U: DataFrame, M: DataFrame, target: int) -> DataFrame:
    """userId, itemId, score: clamped [0, 5] prediction of every item for
    one user. Scoring all users x all items is a cartesian product; this
    scores the requested user only."""
    vec = user_vector(U, target)
    spark = U.sparkSession
    if vec is None:
        return spark.createDataFrame([], "userId long, itemId long, score double")
    return M.select(F.lit(target).cast("long").alias(USER), F.col("id").cast("long").alias(ITEM),
                    clamp_score(dot_literal("features", vec)).alias("score"))


def mf_recommend(ratings: DataFrame, target: int, n: int, rank: int = 10,
                 iterations: int = 10, lam: float = 0.1, alpha: float = 0.01,
                 seed: int = 42) -> DataFrame:
    """Gradient-descent factors, then the top ``n`` unseen items with a
    positive score for ``target``, clamped and rounded HALF_UP 2."""
    U, M = mf_gradient(ratings, rank, iterations, lam, alpha, seed)
    return recommend_from_factors(M, user_vector(U, target), ratings, target, n,
                                  positive_only=True)


def mf_recommend_for(ratings: DataFrame, users: DataFrame, n: int, rank: int = 10,
                     iterations: int = 10, lam: float = 0.1, alpha: float = 0.01,
                     seed: int = 42) -> DataFrame:
    """Gradient-descent factors, then the top ``n`` unseen items with a
    positive score of every user of ``users``."""
    U, M = mf_gradient(ratings, rank, iterations, lam, alpha, seed)
    return recommend_for(users, U, M, ratings, n, positive_only=True)
