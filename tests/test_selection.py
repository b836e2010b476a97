"""The n-th key by counts, against sorting."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fettle.operators import selection, split
from fettle.operators.selection import nth_by_hash, nth_key, share_of


@pytest.fixture(params=[(50_000, 1_024, 64), (20, 16, 4), (1, 64, 8)])
def small_ranges(request, monkeypatch):
    """The last ones cut ranges again and again."""
    for name, value in zip(("RANGE_ROWS", "SAMPLE", "RANGES"), request.param):
        monkeypatch.setattr(selection, name, value)


def test_nth_key_equals_sorting(spark, small_ranges):
    rng = random.Random(1)
    keys = sorted({(rng.randrange(40), f"k{rng.randrange(300)}") for _ in range(900)})
    df = spark.createDataFrame(rng.sample(keys, len(keys)), "a int, b string").repartition(5)
    for n in (1, 2, 17, len(keys) // 2, len(keys) - 1, len(keys)):
        assert tuple(nth_key(df, n, ["a", "b"])) == keys[n - 1]
    assert nth_key(df, len(keys) + 1, ["a", "b"]) is None
    assert nth_key(df.limit(0), 1, ["a", "b"]) is None


@pytest.mark.parametrize("kind, values", [
    ("double", [-1.5, 0.0, 2.25, float("inf"), float("nan"), 1e300]),
    ("float", [0.1, 0.2, -3.7]), ("string", ["", "a", "Z", "é", "中", "\U0001f600"]),
    ("date", [dt.date(2020, 1, 1), dt.date(1950, 5, 5)]),
    ("timestamp", [dt.datetime(2024, 1, 1, 0, 0, 7, 179575), dt.datetime(2024, 1, 1, 0, 0, 7)]),
    ("decimal(20,3)", None), ("binary", [b"", b"\x00", b"\xff", b"a"]), ("boolean", [True, False]),
])
def test_keys_of_any_type(spark, monkeypatch, kind, values):
    monkeypatch.setattr(selection, "RANGE_ROWS", 1)
    df = (spark.range(9).select(((F.col("id") - 4) / 7).cast(kind).alias("k")) if values is None
          else spark.createDataFrame([(v,) for v in values], f"k {kind}"))
    want = [r.k for r in df.orderBy("k").collect()]
    for n in range(1, len(want) + 1):
        found = nth_key(df, n, ["k"])["k"]
        assert found == want[n - 1] or found != found and want[n - 1] != want[n - 1]


def test_repeats_at_the_border_are_found_in_any_range(spark, small_ranges):
    df = spark.createDataFrame([(k,) for k in [*range(200), 100, 100]], "k int")
    for n in (101, 102):
        with pytest.raises(ValueError, match="not unique"):
            nth_key(df, n, ["k"])
    hot = spark.range(500).select(F.lit(7).alias("k"))
    with pytest.raises(ValueError, match="not unique"):
        nth_key(hot, 250, ["k"])


def test_nulls_are_found_wherever_they_lie(spark, small_ranges):
    df = spark.createDataFrame([(k,) for k in [*range(200), None]], "k int")
    with pytest.raises(ValueError, match="null"):
        nth_key(df, 1, ["k"])
    with pytest.raises(ValueError, match="null"):
        split.fraction_split(df, "k", 0.01, 0)


def test_nth_by_hash_equals_sorting(spark, small_ranges):
    hashed = lambda k: hashlib.md5(f"3|{k}".encode()).hexdigest()
    df = spark.range(700).select("id", F.md5(F.concat(F.lit("3|"), F.col("id"))).alias("h"))
    order = sorted((hashed(k), k) for k in range(700))
    for n in (1, 5, 350, 700):
        assert tuple(nth_by_hash(df, "h", ["id"], lambda rows: n)) == order[n - 1]  # noqa: B023
    assert nth_by_hash(df, "h", ["id"], share_of(0.0)) is None
    assert nth_by_hash(df.limit(0), "h", ["id"], share_of(1.0)) is None
    assert share_of(0.37)(700) == 259


def test_one_key_in_all_rows_is_no_endless_search(spark, small_ranges):
    df = spark.range(300).select(F.lit(1).alias("k"))
    with pytest.raises(ValueError, match="not unique"):
        split.fraction_split(df, "k", 0.5, 0)


def test_only_counts_are_moved(spark, monkeypatch):
    """Rows counted, drawn or put in order are bounded, whatever the size of the table."""
    moved = []
    real = selection._nth_of_few
    monkeypatch.setattr(selection, "RANGE_ROWS", 500)
    monkeypatch.setattr(selection, "_nth_of_few",
                        lambda rows, n, order: (moved.append(rows.count()), real(rows, n, order))[1])
    df = spark.range(50_000).select((F.col("id") * 7919 % 1_000_003).alias("k"))
    want = sorted(k * 7919 % 1_000_003 for k in range(50_000))
    for n in (1, 100, 25_000, 50_000):
        assert nth_key(df, n, ["k"])["k"] == want[n - 1]
    split.fraction_split(df, "k", 0.3, 0)
    assert len(moved) == 5 and max(moved) <= 500
    counted = df.groupBy(F.lit(0).alias("place")).count()
    assert "partial_count" in counted._jdf.queryExecution().executedPlan().toString()
