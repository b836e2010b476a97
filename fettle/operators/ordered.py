"""Running totals and neighbours over an order, without one task holding a whole group.

A SQL window puts each group into one task, and a window without groups puts everything into
one. Here rows are range-partitioned by (group, order), so a group of any size is spread over
as many partitions as it fills. Totals are then taken in two levels: a window inside each
partition, plus what earlier partitions carry over. At most one group can continue into a
partition, so the carried table never has more rows than there are partitions, which is what
makes it safe to broadcast.

Only the key columns and the summed value travel through this; callers join the result back to
wide rows on the (unique) key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fettle.functions.hashing import any_null, columns_of
from fettle.shared import cut

PART = "__part"


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join in which a null key meets a null key, as it does in a grouping."""
    renamed = right.withColumnsRenamed({key: f"__right_{key}" for key in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"__right_{k}" for k in keys])


def _ranged(df: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows in ranges of (group, order), with the number of their range.

    Range boundaries come from a sample, so the result is materialised: a second evaluation
    could draw them elsewhere. A null in the order is an error.
    """
    if not order:
        raise ValueError("an order is needed: tables have none of their own")
    part = F.when(
        any_null(order), F.raise_error(F.lit(f"null in the order {list(order)}"))
    ).otherwise(F.spark_partition_id())
    return cut(df.repartitionByRange(*groups, *order).withColumn(PART, part))


def _unique(value: Column, keys: Sequence[str]) -> Column:
    """``value``, or an error where two rows have the same keys.

    Equal keys share a range and are neighbours in it, so looking one row back is enough.
    """
    here = F.struct(*keys)
    before = F.lag(here).over(Window.partitionBy(PART).orderBy(*keys))
    repeated = F.raise_error(F.lit(f"{list(keys)} is not unique"))
    return F.when(before.eqNullSafe(here), repeated).otherwise(value)


def running_total(df: DataFrame, value: Column, order_by: str | Sequence[str],
                  group_by: str | Sequence[str] = (), inclusive: bool = False,
                  name: str = "running_total") -> DataFrame:
    """(group, order, ``name``): sum of ``value`` over the rows before each row of its group.

    ``inclusive`` counts the row itself as well. (group, order) must be unique.
    """
    order, groups = columns_of(order_by), columns_of(group_by)
    keys = [*groups, *order]
    ranged = _ranged(df.select(*keys, value.alias("__value")), groups, order)

    totals = ranged.groupBy(PART, *groups).agg(F.sum("__value").alias("__total"))
    earlier = Window.partitionBy(*groups).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        totals.withColumn("__carried", F.sum("__total").over(earlier))
        .where(F.col("__carried").isNotNull())
        .drop("__total")
        .withColumnsRenamed({n: f"__to_{n}" for n in (PART, *groups)})
    )
    same_group = reduce(
        lambda a, b: a & b,
        [F.col(n).eqNullSafe(F.col(f"__to_{n}")) for n in (PART, *groups)],
    )

    inside = Window.partitionBy(PART, *groups).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    within = ranged.select(
        "*",
        _unique(F.coalesce(F.sum("__value").over(inside), F.lit(0)), keys).alias("__within"),
    )
    return within.join(F.broadcast(carried), same_group, "left").select(
        *keys,
        (F.col("__within") + F.coalesce(F.col("__carried"), F.lit(0))).alias(name),
    )


def ordinals(df: DataFrame, order_by: str | Sequence[str], name: str = "ordinal") -> DataFrame:
    """(order, ``name``): 0-based position of every row in the order."""
    return running_total(df, F.lit(1).cast("bigint"), order_by, name=name)


def with_ordinal(df: DataFrame, order_by: str | Sequence[str],
                 name: str = "ordinal") -> DataFrame:
    """``df`` with each row's 0-based position; the wide rows are shuffled once, by their key."""
    return df.join(ordinals(df, order_by, name), columns_of(order_by))


def with_neighbour(df: DataFrame, columns: Sequence[str], order_by: str | Sequence[str],
                   group_by: str | Sequence[str] = (), step: int = -1,
                   prefix: str = "previous_") -> DataFrame:
    """``df`` with columns of the row before (``step=-1``) or after (``step=1``) in its group.

    All of ``df`` is materialised, so pass the needed columns only.
    """
    if step not in (-1, 1):
        raise ValueError("step must be -1 or 1")
    order, groups = columns_of(order_by), columns_of(group_by)
    keys = [*groups, *order]
    ranged = _ranged(df, groups, order)
    offset = F.lag if step < 0 else F.lead
    edge = F.max_by if step < 0 else F.min_by

    seen = F.struct(*[F.col(n).alias(f"g_{n}") for n in groups], *columns)
    edges = ranged.groupBy(PART).agg(edge(seen, F.struct(*keys)).alias("__edge"))
    across = edges.select(PART, offset("__edge").over(Window.orderBy(PART)).alias("__edge"))

    within = ranged.select(
        "*",
        _unique(offset(seen).over(Window.partitionBy(PART).orderBy(*keys)), keys)
        .alias("__inside"),
    )
    found = F.coalesce(F.col("__inside"), F.col("__edge"))
    in_group = reduce(
        lambda a, b: a & b,
        [found[f"g_{n}"].eqNullSafe(F.col(n)) for n in groups],
        found.isNotNull(),
    )
    return within.join(F.broadcast(across), PART, "left").select(
        *df.columns,
        *[F.when(in_group, found[c]).alias(f"{prefix}{c}") for c in columns],
    )
