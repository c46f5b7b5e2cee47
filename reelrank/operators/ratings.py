"""Rating tables: per-pair averages, statistics, seen sets, pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from reelrank.functions.scalar import blend_rating
from reelrank.sizing import DEFAULT_BROADCAST_ROWS, sized_broadcast

USER, ITEM, RATING = "userId", "itemId", "rating"


def prepare_reviews(reviews: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    """Keep the columns the recommenders use, typed by name: ids as long,
    scores as double (``try_cast``: bad values become null, ANSI-safe)."""
    cols = [F.expr(f"try_cast({user} AS BIGINT)").alias(USER),
            F.expr(f"try_cast({item} AS BIGINT)").alias(ITEM),
            F.expr(f"try_cast({RATING} AS DOUBLE)").alias(RATING)]
    if "sentimentResult" in reviews.columns:
        cols.append(F.expr("try_cast(sentimentResult AS DOUBLE)").alias("sentimentResult"))
    if "creationDate" in reviews.columns:
        cols.append(F.col("creationDate").cast("date").cast("string").alias("creationDate"))
    return reviews.select(*cols)


def user_item_ratings(reviews: DataFrame, weight: float = 1.0, clamp: bool = False,
                      sentiment: str = "sentimentResult") -> DataFrame:
    """One rating per (user, item): the average of its reviews. With
    ``weight < 1`` each review is first blended with its sentiment.
    Partial aggregation combines duplicates before the shuffle."""
    value = blend_rating(RATING, sentiment, weight, clamp) if weight != 1.0 or clamp \
        else F.col(RATING)
    return (reviews.groupBy(USER, ITEM)
            .agg(F.avg(value).alias(RATING))
            .fillna(0.0, subset=[RATING]))


def dataset_stats(reviews: DataFrame) -> DataFrame:
    """Row count and distinct users and items, one row."""
    return reviews.agg(F.count(F.lit(1)).alias("n_reviews"),
                       F.count_distinct(USER).alias("n_users"),
                       F.count_distinct(ITEM).alias("n_items"))


def seen_items(ratings: DataFrame, users: Sequence[int] | None = None) -> DataFrame:
    """Distinct (userId, itemId) pairs, optionally for some users only."""
    df = ratings.select(USER, ITEM)
    if users is not None:
        df = df.filter(F.col(USER).isin(list(users)))
    return df.distinct()


def seen_report(ratings: DataFrame) -> DataFrame:
    """Per user of one-row-per-pair ratings: how many items were rated (a bounded report;
    the item lists themselves stay in long form)."""
    return ratings.groupBy(USER).agg(F.count(ITEM).alias("n_seen"))


def exclude_seen(candidates: DataFrame, seen: DataFrame,
                 keys: Sequence[str] = (USER, ITEM),
                 max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Candidates whose keys are not in ``seen`` (a left anti join; no list
    is collected). The distinct seen keys are broadcast only after a
    bounded size check; beyond it the anti join shuffles (AQE splits a
    skewed candidate key)."""
    seen = seen.select(*keys).distinct()
    if max_broadcast_rows:
        seen = sized_broadcast(seen, max_broadcast_rows)
    return candidates.join(seen, list(keys), "left_anti")


def pivot_ratings(ratings: DataFrame, items: Sequence, fill: float = 0.0) -> DataFrame:
    """Wide user x item matrix for an explicit short item list (one column
    per item, missing = ``fill``). The long form is what the recommenders
    use; a full pivot of every item does not scale."""
    items = list(items)
    wide = ratings.groupBy(USER).pivot(ITEM, items).agg(F.first(RATING))
    return wide.fillna(fill)
