"""Composed recommender: the hybrid of ALS and user-KNN."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reelrank.operators.blend import blend_recommendations
from reelrank.operators.factorize import als_recommend
from reelrank.operators.neighbours import user_knn


def hybrid_recommendations(ratings: DataFrame, target: int, n: int,
                           rank: int = 10, max_iter: int = 10, reg: float = 0.1,
                           seed: int = 42) -> DataFrame:
    """The deployed path: ALS top-n and user-KNN top-n for one user,
    blended by a full outer join (missing score = 0)."""
    mf = als_recommend(ratings, target, n, rank, max_iter, reg, seed)
    knn = user_knn(ratings, target, n)
    return blend_recommendations(mf, knn)
