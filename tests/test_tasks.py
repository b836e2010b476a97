import pytest
from pyspark.sql import functions as F

from fettle.operators import tasks
from tests.helpers import plan_of, rows


@pytest.mark.parametrize("difficulty, n", [(0, 1), (4, 5), (298, 299), (299, 299), (500, 299)])
def test_task_sizes(spark, difficulty, n):
    found = tasks.generate_tasks(spark, 20, difficulty, seed=3).collect()
    assert len(found) == 20
    for task in found:
        ids = task["item_ids"]
        assert len(ids) == n == len(set(ids))
        assert ids == sorted(ids) and 1 <= ids[0] and ids[-1] <= 300
        assert task["target_id"] == ids[0]


def test_negative_difficulty_is_refused(spark):
    with pytest.raises(ValueError):
        tasks.generate_tasks(spark, 1, -1)
    samples = spark.createDataFrame([(1, -1)], "sample_id bigint, d int")
    with pytest.raises(Exception, match="negative"):
        tasks.tasks_for(samples, "sample_id", F.col("d")).collect()


def test_tasks_depend_on_seed_and_sample_alone(spark):
    base = rows(tasks.generate_tasks(spark, 50, 4, seed=1))
    assert rows(tasks.generate_tasks(spark, 50, 4, seed=2)) != base
    for parts in (1, 7):
        samples = spark.range(50).toDF("sample_id").repartition(parts)
        assert rows(tasks.tasks_for(samples, "sample_id", 4, 1)) == base


def test_every_id_is_drawn_about_equally_often(spark):
    drawn = tasks.generate_tasks(spark, 6_000, 9, seed=5).select(F.explode("item_ids").alias("i"))
    counts = drawn.groupBy("i").count().agg(F.min("count"), F.max("count"), F.count("*")).first()
    # 200 expected per id; five standard deviations.
    assert counts[2] == 300 and counts[0] > 130 and counts[1] < 270


def test_tasks_need_no_shuffle(spark):
    assert "Exchange" not in plan_of(tasks.agent_dataset(spark, 100, 4))


def test_dataset_columns(spark):
    row = tasks.agent_dataset(spark, 1, 1, seed=9).first()
    ids = row["item_ids"]
    assert row["item_ids_str"] == f"{ids[0]} {ids[1]}"
    assert row["prompt"].startswith(f"<|obs|><ID_{ids[0]}> <ID_{ids[1]}><|agent|>")
    assert tasks.agent_dataset(spark).count() == 32


def test_special_tokens(spark):
    vocabulary = tasks.special_tokens(spark)
    assert vocabulary.count() == 305 == vocabulary.select("token").distinct().count()
    assert rows(vocabulary.where("kind = 'item'").agg(F.min("item_id"), F.max("item_id"))) == [
        (1, 300)
    ]
    texts = spark.createDataFrame([("<ID_1><ID_1> <ID_301><|pad|>",), (None,)], "text string")
    usage = {r["token"]: r["n_uses"] for r in tasks.special_token_usage(texts, "text").collect()}
    assert len(usage) == 305
    assert {t: n for t, n in usage.items() if n} == {"<ID_1>": 2, "<|pad|>": 1}


def test_expand_generations(spark):
    found = rows(tasks.expand_generations(spark.range(2), 3))
    assert found == [(i, g) for i in range(2) for g in range(3)]
