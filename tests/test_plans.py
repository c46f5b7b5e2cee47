"""Physical-plan guards for scale: no cartesian products, pushed filters,
pre-shuffle limits on per-user top-N."""

import pytest

import __spark_entry__ as entry
from reelrank.plans.queries import QUERIES

from .conftest import SF_SMALL


from tools.plans import all_plans, plan_of, recorded


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_products(spark, name):
    """In no execution of a query, eager steps included."""
    for plan in all_plans(entry.queries()[name], spark, SF_SMALL):
        assert "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan


def test_eager_steps_are_recorded(spark):
    with recorded() as plans:
        spark.range(3).crossJoin(spark.range(2).hint("shuffle_replicate_nl")).count()
        spark.range(5).write.format("noop").mode("overwrite").save()
    assert len(plans) == 2 and "CartesianProduct" in plans[0]
    for name, least in (("two_hop_scores", 5), ("mf_recommend", 12)):
        assert len(all_plans(entry.queries()[name], spark, SF_SMALL)) >= least


def test_target_filter_reaches_scan(spark):
    from reelrank.operators.neighbours import user_similarity
    from reelrank.operators.ratings import user_item_ratings
    from reelrank.sources.tables import reviews
    plan = plan_of(user_similarity(user_item_ratings(reviews(spark, SF_SMALL)), 26))
    assert "EqualTo(o_custkey,26)" in plan


@pytest.mark.parametrize("name", ["topn_per_user", "cap_per_user"])
def test_per_user_limit_before_shuffle(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_SMALL))
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) and final


@pytest.mark.parametrize("name", ["user_similarity", "user_knn", "als_recommend"])
def test_target_filter_reaches_written_ratings(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_SMALL))
    assert "EqualTo(userId,26)" in plan
