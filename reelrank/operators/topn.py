"""Top-N items for a requested set of users from factor tables: exact
maximum-inner-product search.

Items are ordered by the norm of their factors and cut into blocks. A user's
score in a block is at most user norm x largest norm of the block, so once
that falls under the user's N-th best score so far, this and all later blocks
are skipped. Blocks are visited in rounds of 1, 2, 4, ... blocks; in each
round the users that may still gain go to their blocks, one Arrow task scores
a block with some thousand users by one matrix product, and each user's N
best so far set the bound of the next round. Users x items is never formed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from reelrank.operators.prepare import index_ids
from reelrank.operators.rank import topn_per_user
from reelrank.session import cut_lineage
from reelrank.sizing import block_count

USER, ITEM = "userId", "itemId"
# Items of a block, users scored in one task, scores held at a time.
BLOCK_ITEMS, GROUP_USERS, HELD_SCORES = 4096, 4096, 2_000_000
# Scores closer than this are taken as equal when a block is skipped.
_SLACK = 1e-9


@dataclass
class TopItems:
    """The rows (userId, itemId, score, rank) and how many of all
    (user, block) pairs were not scored."""
    rows: DataFrame
    pairs: int
    skipped: int


def _norm(c: str):
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))


def item_blocks(items: DataFrame, block_items: int) -> DataFrame:
    """itemId, features, norm, block: blocks of equal size by falling norm."""
    rows = cut_lineage(items.select(F.col("id").cast("long").alias(ITEM), "features",
                                    _norm("features").alias("norm")))
    # dense positions by (falling norm, id), without one task that sees all
    order = F.struct((-F.col("norm")).alias("n"), F.col(ITEM).alias("i"))
    places = index_ids(rows.select(order.alias("k")), "k", method="sorted")
    return cut_lineage(places.select(F.col("k_original.i").alias(ITEM), F.col("k_index").alias("at"))
                       .join(rows, ITEM)
                       .withColumn("block", F.floor(F.col("at") / block_items).cast("int"))
                       .drop("at"))


def _score_task(n: int, positive_only: bool) -> Callable:
    """Users (kind 0: id, features) and pairs that users have rated (kind 1:
    id, itemId) against a block's items: each user's n best unseen items."""
    def run(users: pa.Table, items: pa.Table) -> pa.Table:
        ids, matrix = (items.column(c).combine_chunks() for c in (ITEM, "features"))
        ids = ids.to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        matrix = matrix.flatten().to_numpy().reshape(len(ids), -1)[order]
        wanted = users.filter(pc.equal(users.column("kind"), 0))
        seen = users.filter(pc.equal(users.column("kind"), 1))
        who = wanted.column("user").to_numpy()
        order = np.argsort(who, kind="stable")
        who = who[order]
        vectors = wanted.column("features").combine_chunks().flatten().to_numpy()
        vectors = vectors.reshape(len(who), -1)[order]
        # what users have rated, by user
        row = np.searchsorted(who, seen.column("user").to_numpy())
        col = np.searchsorted(ids, seen.column("item").to_numpy())
        by = np.argsort(row, kind="stable")
        row, col = row[by], col[by]
        keep, step, found = min(n, len(ids)), max(1, HELD_SCORES // len(ids)), []
        for x in range(0, len(who), step):
            scores = vectors[x:x + step] @ matrix.T
            a, b = np.searchsorted(row, [x, x + step])
            scores[row[a:b] - x, col[a:b]] = -np.inf
            if positive_only:
                scores[scores <= 0] = -np.inf
            # by score as ranked (9 decimals), then the smaller id
            rounded = np.round(scores, 9)
            cut = -np.partition(-rounded, keep - 1, axis=1)[:, keep - 1:keep]
            r, c = np.nonzero((rounded >= cut) & np.isfinite(scores))
            best = np.lexsort((c, -rounded[r, c], r))
            r, c = r[best], c[best]
            top = np.arange(len(r)) - np.searchsorted(r, r) < keep
            found.append((who[x:x + step][r[top]], ids[c[top]], scores[r[top], c[top]]))
        users, items, scores = map(np.concatenate, zip(*found))
        return pa.table({USER: pa.array(users, pa.int64()), ITEM: pa.array(items, pa.int64()),
                         "score": pa.array(scores, pa.float64())})
    return run


def top_items(users: DataFrame, items: DataFrame, seen: DataFrame, n: int,
              positive_only: bool = False, block_items: int = BLOCK_ITEMS,
              group_users: int = GROUP_USERS) -> TopItems:
    """The ``n`` best items of every user of ``users`` (id, features) among
    ``items`` (id, features) that are not in ``seen`` (userId, itemId); ties
    go to the smaller item. Rows: userId, itemId, score, rank."""
    spark = users.sparkSession
    schema = f"{USER} long, {ITEM} long, score double"
    blocks = item_blocks(items, block_items)
    wanted = cut_lineage(users.select(F.col("id").cast("long").alias("user"), "features",
                                      _norm("features").alias("norm")))
    norms = blocks.groupBy("block").agg(F.max("norm").alias("most"), F.count("*").alias("size"))
    n_blocks, n_users = norms.count(), wanted.count()
    if not n_blocks or not n_users:
        return TopItems(spark.createDataFrame([], schema + ", rank int"), 0, 0)
    groups = block_count(n_users, group_users)
    group = F.pmod(F.xxhash64("user"), F.lit(groups)).cast("int")
    rated = cut_lineage(seen.select(F.col(USER).alias("user"), F.col(ITEM).alias("item"))
                        .join(wanted.select("user"), "user", "left_semi")
                        .join(blocks.select(F.col(ITEM).alias("item"), "block"), "item").distinct())
    best, scored, start, width = None, 0, 0, 1
    while start < n_blocks:
        # the users for which a block of this round may hold a better item
        todo = F.explode(F.sequence(F.lit(start), F.lit(min(start + width, n_blocks) - 1))).alias("block")
        todo = wanted.select("user", "features", "norm", todo)
        if best is not None:
            bound = best.where(F.col("rank") == n).select(F.col(USER).alias("user"), F.col("score").alias("nth"))
            todo = (todo.join(bound, "user", "left").join(norms.select("block", "most"), "block")
                    .where(F.col("nth").isNull() | (F.col("norm") * F.col("most") >= F.col("nth") - _SLACK)))
        todo = cut_lineage(todo.select("user", "features", "block"))
        pairs = todo.count()
        if not pairs:
            break
        scored += pairs
        left = todo.select("block", group.alias("group"), F.lit(0).alias("kind"), "user", "features",
                           F.lit(None).cast("long").alias("item"))
        left = left.unionByName(
            rated.join(todo.select("user", "block"), ["user", "block"], "left_semi").select(
                "block", group.alias("group"), F.lit(1).alias("kind"), "user",
                F.lit(None).cast("array<double>").alias("features"), "item"))
        right = (blocks.where(F.col("block").between(start, start + width - 1))
                 .select(F.col("block").alias("b"), ITEM, "features")
                 .join(todo.select(F.col("block").alias("b"), group.alias("g")).distinct(), "b"))
        found = (left.groupBy("block", "group").cogroup(right.groupBy("b", "g"))
                 .applyInArrow(_score_task(n, positive_only), schema))
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = cut_lineage(topn_per_user(found, n, score="score"))
        start, width = start + width, 2 * width
    return TopItems(best, n_blocks * n_users, n_blocks * n_users - scored)
