"""Shared test helpers."""

from __future__ import annotations


def rows(df, *columns):
    """Rows as sorted tuples, optionally of some columns."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def hot_groups(spark, n=3_000):
    """(grp, pos, value): one group holds two thirds of all rows, positions have gaps."""
    return spark.createDataFrame(
        [("hot" if i % 3 else f"g{i % 17}", i * 3 + i % 2, i % 11) for i in range(n)],
        "grp string, pos bigint, value bigint",
    )
