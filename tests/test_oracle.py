"""Every SQL-checkable registered query equals its DuckDB oracle (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as entry
from reelrank.sources.tables import TABLES
from tools.compare import rows_of

from .conftest import SF_SMALL

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(orows)
    assert rows_of(df.columns, rows) == rows_of(cols, orows)


RATINGS = """SELECT o_custkey AS userId, l_partkey AS itemId FROM lineitem
JOIN orders ON l_orderkey = o_orderkey"""


@pytest.mark.parametrize("name", ["als_recommend", "hybrid_recommendations"])
def test_als_lists_are_new_items_ranked(spark, con, name):
    rows = entry.queries()[name](spark, SF_SMALL).collect()
    items = [r.itemId for r in rows]
    seen = {i for (i,) in con.execute(f"SELECT DISTINCT itemId FROM ({RATINGS}) WHERE userId = 26").fetchall()}
    assert 0 < len(rows) <= 1000 and len(set(items)) == len(items)
    assert not seen & set(items) and {r.userId for r in rows} == {26}
    assert all(0.0 <= r.totalScore <= 5.0 for r in rows)


def test_als_fit_predict_covers_every_rating(spark, con):
    rows = entry.queries()["als_fit_predict"](spark, SF_SMALL).collect()
    keys = con.execute(f"SELECT DISTINCT userId, itemId FROM ({RATINGS})").fetchall()
    assert sorted((r.userId, r.itemId) for r in rows) == sorted(keys)
    wrong = sum((r.rating - r.prediction) ** 2 for r in rows) / len(rows)
    mean = sum(r.rating for r in rows) / len(rows)
    assert wrong < 0.5 * sum((r.rating - mean) ** 2 for r in rows) / len(rows)


def test_rating_rmse_counts_every_held_out_row(spark, con):
    row = entry.queries()["rating_rmse"](spark, SF_SMALL).first()
    split = entry.oracle_sql()["train_test_split"]
    held, cold = con.execute(f"""WITH s AS ({split}) SELECT count(*), count_if(
        userId NOT IN (SELECT userId FROM s WHERE split = 'train')
        OR itemId NOT IN (SELECT itemId FROM s WHERE split = 'train')) FROM s
        WHERE split = 'test'""").fetchone()
    assert (row.n_test + row.n_cold, row.n_cold) == (held, cold)
    assert 0 < row.rmse < 5


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["userId", "itemId", "totalScore"]
    assert df.count() > 0
