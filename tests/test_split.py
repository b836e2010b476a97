import hashlib
import math

import pytest
from pyspark.sql import functions as F

from fettle.operators import shuffle, split
from fettle.streaming.streams import hash_split
from tests.helpers import plan_of, rows


def hashed(seed, key):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


def ids(spark, n):
    return spark.range(n).toDF("k")


@pytest.mark.parametrize("n", [0, 1, 40, 100, 250])
def test_take_skip(spark, n):
    df = ids(spark, 100).withColumn("extra", F.col("k") * 2)
    expected = [(k, 2 * k, "take" if k < n else "skip") for k in range(100)]
    assert rows(split.take_skip(df, n, "k")) == sorted(expected, key=repr)


def test_take_skip_on_two_columns(spark):
    df = spark.createDataFrame([(i // 5, i % 5) for i in range(60)], "a int, b int")
    taken = split.take_skip(df, 23, ["a", "b"]).where("split = 'take'")
    assert rows(taken, "a", "b") == [(i // 5, i % 5) for i in range(23)]


def test_ambiguous_heads_are_refused(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    for n in (1, 2, 3):  # wherever the repeated key lies
        with pytest.raises(Exception, match="not unique"):
            split.take_skip(df, n, "k")
        with pytest.raises(Exception, match="not unique"):
            split.head_rows(df, n, "k")
    nulls = spark.createDataFrame([(1, 1), (1, None), (2, 1), (2, 2)], "a int, b int")
    with pytest.raises(Exception, match="null"):
        split.take_skip(nulls, 3, ["a", "b"])
    with pytest.raises(ValueError, match="split"):
        split.take_skip(ids(spark, 3).withColumn("Split", F.lit(1)), 2, "k")


def test_head_rows(spark):
    df = ids(spark, 50).repartition(5)
    for n in (0, 7, 50, 60):
        expected = rows(df.where(f"k < {n}"))
        assert rows(split.head_rows(df, n, "k")) == expected


@pytest.mark.parametrize("test_size", [0.0, 0.005, 0.1, 0.37, 1.0])
def test_fraction_split_is_exact(spark, test_size):
    n = 700
    order = sorted(range(n), key=lambda k: (hashed(11, k), k))
    expected = set(order[: math.ceil(test_size * n)])
    found = split.fraction_split(ids(spark, n), "k", test_size, 11)
    assert {r["k"] for r in found.where("split = 'test'").collect()} == expected
    assert found.count() == n
    assert "Exchange" not in plan_of(found)


def test_fraction_split_does_not_depend_on_partitions(spark):
    base = rows(split.fraction_split(ids(spark, 300), "k", 0.1, 0))
    for parts in (1, 4, 16):
        again = split.fraction_split(ids(spark, 300).repartition(parts), "k", 0.1, 0)
        assert rows(again) == base


def test_splits_by_repeated_or_null_keys_are_refused(spark):
    df = spark.createDataFrame([(5,)] * 10, "k int")
    for test_size in (0.5, 1.0):
        with pytest.raises(Exception, match="not unique"):
            split.fraction_split(df, "k", test_size, 0)
    with pytest.raises(Exception, match="null"):
        split.fraction_split(spark.createDataFrame([(None,)], "k int"), "k", 1.0, 0)
    with pytest.raises(Exception, match="null"):
        shuffle.shuffle_rows(spark.createDataFrame([(None,), (1,)], "k int"), "k", 0).collect()


def test_hash_split_is_close_and_nested(spark):
    df = ids(spark, 4_000)
    small = {r["k"] for r in df.where(hash_split("k", 0.1, 2) == "test").collect()}
    large = {r["k"] for r in df.where(hash_split("k", 0.3, 2) == "test").collect()}
    assert small < large and 320 < len(small) < 480 and 1_080 < len(large) < 1_320


def test_shuffle_is_the_seeded_order(spark):
    found = shuffle.shuffle_rows(ids(spark, 500).withColumn("x", F.lit("y")), "k", 4)
    order = sorted(range(500), key=lambda k: (hashed(4, k), k))
    assert [r["k"] for r in found.orderBy("shuffle_pos").collect()] == order
    assert found.columns == ["k", "x", "shuffle_pos"]
    with pytest.raises(Exception, match="not unique"):
        shuffle.shuffle_rows(ids(spark, 5).union(ids(spark, 5)), "k", 4).collect()
    assert found.agg(F.max("shuffle_pos")).first()[0] == 499


def test_blocks_stay_where_they_are(spark):
    found = shuffle.shuffle_blocks(ids(spark, 230), "k", 4, 50).collect()
    assert sorted(r["shuffle_pos"] for r in found) == list(range(230))
    assert all(r["block"] == r["k"] // 50 == r["shuffle_pos"] // 50 for r in found)
    first = [r["k"] for r in sorted(found, key=lambda r: r["shuffle_pos"])[:50]]
    assert first == sorted(range(50), key=lambda k: (hashed(4, k), k))


def test_repetition(spark):
    assert rows(shuffle.repeat_rows(ids(spark, 2), 2)) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    found = shuffle.repeat_until(ids(spark, 7), "k", 17).orderBy("position").collect()
    assert [r["k"] for r in found] == [i % 7 for i in range(17)]
    assert [r["epoch"] for r in found] == [i // 7 for i in range(17)]


def steps(df, step):
    return {r["epoch_progress"] for r in df.where(f"step = {step}").collect()}


def test_plans_agree_with_logged_epochs(spark):
    # 100 rows, one per micro-batch, four micro-batches a step: step 5 ends at epoch 0.2.
    plan = shuffle.plan_batches(ids(spark, 100), "k", 1, 4, drop_last=True, max_steps=20)
    assert plan.count() == 80 and steps(plan, 5) == {0.2} and steps(plan, 20) == {0.8}
    # 50 prompts with two completions, two completions a step: step 5 ends at epoch 0.1.
    plan = shuffle.plan_batches(ids(spark, 50), "k", 1, 2, generations=2, max_steps=20)
    assert steps(plan, 5) == {0.1} and steps(plan, 20) == {0.4}
    assert rows(plan.where("step = 3"), "k", "gen_id", "micro_step") == [(2, 0, 0), (2, 1, 1)]


def test_existing_columns_are_not_overwritten(spark):
    with pytest.raises(ValueError, match="step"):
        shuffle.plan_batches(ids(spark, 3).withColumn("step", F.lit(1)), "k", 1)
    with pytest.raises(ValueError, match="epoch"):
        shuffle.repeat_rows(ids(spark, 3).withColumn("Epoch", F.lit(1)), 2)


def test_the_last_unfilled_batch(spark):
    kept = shuffle.plan_batches(ids(spark, 11), "k", 4, 2)
    dropped = shuffle.plan_batches(ids(spark, 11), "k", 4, 2, drop_last=True)
    assert kept.count() == 11 and steps(kept, 2) == {1.0}
    assert rows(dropped, "k") == [(k,) for k in range(8)]


def test_description(spark):
    facts = split.describe_corpus(spark.createDataFrame([(2, "b"), (1, "a")], "k int, t string"),
                                  "k").first()
    assert facts["n_rows"] == 2 and facts["columns"] == ["k", "t"]
    assert tuple(facts["first_row"]) == (1, "a")
    empty = split.describe_corpus(spark.createDataFrame([], "k int, t string"), "k").first()
    assert empty["n_rows"] == 0 and empty["first_row"] is None
