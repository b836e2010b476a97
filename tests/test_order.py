import pytest
from pyspark.sql import functions as F

from fettle.operators.ordered import PART, running_total, with_neighbour, with_ordinal
from tests.helpers import hot_groups, rows


def test_totals_inside_groups_of_any_size(spark):
    df = hot_groups(spark)
    sums, expected = {}, []
    for grp, pos, value in sorted(tuple(r) for r in df.collect()):
        before = sums.get(grp, 0)
        sums[grp] = before + value
        expected.append((grp, pos, before, before + value))
    before = running_total(df, F.col("value"), "pos", "grp", name="t")
    after = running_total(df, F.col("value"), "pos", "grp", inclusive=True, name="t")
    assert rows(before) == sorted((e[:3] for e in expected), key=repr)
    assert rows(after) == sorted(((e[0], e[1], e[3]) for e in expected), key=repr)


def test_a_hot_group_is_spread_over_ranges(spark):
    from fettle.operators.ordered import _ranged

    ranged = _ranged(hot_groups(spark), ["grp"], ["pos"])
    sizes = [r["count"] for r in ranged.groupBy(PART).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 1_000  # the hot group has 2,000 rows


def test_ordinals_do_not_depend_on_partitions(spark):
    df = spark.range(1_000).select((F.col("id") * 7919 % 1_000_003).alias("k"), "id")
    expected = {k: i for i, k in enumerate(sorted(r["k"] for r in df.collect()))}
    for parts in (1, 4, 16):
        found = with_ordinal(df.repartition(parts), "k").collect()
        assert {r["k"]: r["ordinal"] for r in found} == expected


@pytest.mark.parametrize("step", [-1, 1])
def test_neighbours_across_range_borders(spark, step):
    df = hot_groups(spark)
    groups = {}
    for grp, pos, value in sorted(tuple(r) for r in df.collect()):
        groups.setdefault(grp, []).append((pos, value))
    expected = []
    for grp, members in groups.items():
        for i, (pos, value) in enumerate(members):
            at = i + step
            other = members[at][1] if 0 <= at < len(members) else None
            expected.append((grp, pos, value, other))
    found = with_neighbour(df, ["value"], "pos", "grp", step=step, prefix="other_")
    assert rows(found, "grp", "pos", "value", "other_value") == sorted(expected, key=repr)


def test_null_groups_are_a_group(spark):
    df = spark.createDataFrame(
        [(None if i % 2 else "a", i, 1) for i in range(400)], "grp string, pos int, v int"
    )
    totals = running_total(df, F.col("v"), "pos", "grp", inclusive=True, name="t")
    assert rows(totals.groupBy("grp").agg(F.max("t"), F.sum("t"))) == rows(
        spark.createDataFrame([("a", 200, 20_100), (None, 200, 20_100)], "g string, a int, b int")
    )


def test_an_order_must_decide(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "k int, v int")
    with pytest.raises(Exception, match="not unique"):
        with_ordinal(df, "k").collect()
    with pytest.raises(Exception, match="not unique"):
        with_neighbour(df, ["v"], "k").collect()
    nulls = spark.createDataFrame([(1, 1), (None, 2)], "k int, v int")
    with pytest.raises(Exception, match="null in the order"):
        with_ordinal(nulls, "k").collect()
    with pytest.raises(ValueError):
        with_ordinal(df, [])
