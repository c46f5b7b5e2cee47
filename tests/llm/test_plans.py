"""No execution of a training-data query plans a product of two tables."""

import pytest

from reelrank.llm.queries import QUERIES
from tools.plans import all_plans


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_products(spark, name):
    plans = all_plans(QUERIES[name], spark, "/root/testdata/sf0.001")
    assert not any("CartesianProduct" in p or "BroadcastNestedLoopJoin" in p for p in plans)
