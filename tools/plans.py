"""The physical plans of everything a query executes, eager steps included."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.readwriter import DataFrameWriter

_ACTIONS = ("collect", "count", "first", "head", "take", "isEmpty", "toPandas", "checkpoint")
_WRITES = ("parquet", "save", "saveAsTable", "csv", "text", "json")


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def recorded() -> Iterator[list[str]]:
    """While it lasts, the plan of every DataFrame that is collected, counted
    or written is added to the list."""
    plans: list[str] = []
    inside = [False]

    def wrap(owner, name, frame):
        plain = getattr(owner, name)

        def run(self, *args, **kwargs):
            if inside[0]:  # one action calls another
                return plain(self, *args, **kwargs)
            inside[0] = True
            try:
                plans.append(plan_of(frame(self)))
                return plain(self, *args, **kwargs)
            finally:
                inside[0] = False
        setattr(owner, name, run)
        return owner, name, plain

    kept = [wrap(DataFrame, n, lambda df: df) for n in _ACTIONS]
    kept += [wrap(DataFrameWriter, n, lambda w: w._df) for n in _WRITES]
    try:
        yield plans
    finally:
        for owner, name, plain in kept:
            setattr(owner, name, plain)


def all_plans(query, spark, sf_dir: str) -> list[str]:
    """The plans of a query's eager steps, and of its result."""
    with recorded() as plans:
        df = query(spark, sf_dir)
        plans.append(plan_of(df))
    return plans
