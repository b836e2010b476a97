import statistics

import pytest
from pyspark.sql import functions as F

from fettle.functions.rewards import task_reward
from fettle.operators import groups, scoring
from fettle.plans.jobs import agent_round
from tests.helpers import plan_of, rows


def scored(spark):
    data = [("a", i, r) for i, r in enumerate([1.0, -0.5, -1.0, -1.0])]
    data += [("same", i, 0.3) for i in range(3)] + [("alone", 0, 1.0), (None, 0, 1.0),
                                                    (None, 1, 0.0)]
    data += [("hot", i, float(i % 5)) for i in range(2_000)]
    return spark.createDataFrame(data, "grp string, gen_id int, reward double")


def advantages(df, **options):
    found = groups.group_advantage(df, "grp", **options).collect()
    return {(r["grp"], r["gen_id"]): r["advantage"] for r in found}


def test_advantages(spark):
    found = advantages(scored(spark))
    rewards = [1.0, -0.5, -1.0, -1.0]
    mean, std = statistics.mean(rewards), statistics.stdev(rewards)
    for i, reward in enumerate(rewards):
        assert found["a", i] == pytest.approx((reward - mean) / (std + 1e-4))
    assert [found["same", i] for i in range(3)] == pytest.approx([0, 0, 0], abs=1e-9)
    assert found["alone", 0] == 0.0
    assert found[None, 0] == pytest.approx(-found[None, 1]) and found[None, 0] > 0.7
    assert sum(v for (g, _), v in found.items() if g == "hot") == pytest.approx(0, abs=1e-6)


def test_statistics_are_joined_back(spark):
    """No window gathers a group; a hot one is a stretch of a join, which can be split."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(groups.group_advantage(scored(spark), "grp"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" not in plan and "SortMergeJoin" in plan and "Broadcast" not in plan


def test_group_stats_use_the_sample_deviation(spark):
    stats = {r["grp"]: r for r in groups.group_reward_stats(scored(spark), "grp").collect()}
    assert stats["a"]["reward_std"] == pytest.approx(statistics.stdev([1.0, -0.5, -1.0, -1.0]))
    assert stats["alone"]["reward_std"] is None and stats["alone"]["n"] == 1


def test_preference_pairs(spark):
    df = spark.createDataFrame(
        [("a", 0, "x", 0.1), ("a", 1, "y", 0.9), ("a", 2, "z", 0.9), ("a", 3, "w", 0.1),
         ("tie", 0, "p", 0.5), ("tie", 1, "q", 0.5), ("n", 0, "u", None), ("n", 1, "v", 1.0)],
        "grp string, gen_id int, text string, reward double",
    ).withColumn("question", F.concat(F.lit("q-"), "grp"))
    pairs = groups.preference_pairs(df, "grp", "question", "text")
    assert rows(pairs) == [("a", "q-a", "y", "x")]
    assert pairs.columns == ["grp", "question", "response_j", "response_k"]
    twice = df.union(df.where("gen_id = 1").withColumn("text", F.lit("other")))
    with pytest.raises(Exception, match="not unique"):
        groups.preference_pairs(twice, "grp", "question", "text").collect()


def test_alignment(spark):
    completions = spark.createDataFrame(
        [(i % 3, g, f"<END_THINK><ID_{g}>") for i in range(3) for g in range(300)],
        "k int, gen_id int, completion string",
    )
    targets = spark.createDataFrame([(0, 0), (1, 1), (2, 2)], "k int, target_id int")
    aligned = scoring.align(completions, targets, "k")
    reward = task_reward(F.col("completion"), F.col("target_id"))
    assert aligned.count() == 900
    assert rows(aligned.where(reward == 1.0), "k", "gen_id") == [(0, 0), (1, 1), (2, 2)]
    for broken in (targets.where("k < 2"), targets.union(targets.limit(1)),
                   targets.union(spark.createDataFrame([(9, 9)], targets.schema))):
        with pytest.raises(ValueError, match="do not align"):
            scoring.align(completions, broken, "k")


def test_named_rewards(spark):
    df = spark.createDataFrame([("ab",)], "t string")
    length, one = F.length("t"), F.lit(1)
    assert scoring.apply_rewards(df, {"a": length}).first()["reward"] == 2.0
    weighted = scoring.apply_rewards(df, {"a": length, "b": lambda: one}, {"a": 0.5}).first()
    assert (weighted["a"], weighted["b"], weighted["reward"]) == (2.0, 1.0, 2.0)
    with pytest.raises(ValueError):
        scoring.apply_rewards(df, {"a": length}, {"c": 1.0})


def test_outcomes(spark):
    df = spark.createDataFrame(
        [("x", "CORRECT")] * 3 + [("x", "INCORRECT")] + [("y", "INVALID ACTION")],
        "run string, outcome string",
    )
    assert rows(scoring.outcome_summary(df, "run")) == [
        ("x", "CORRECT", 3, 0.75), ("x", "INCORRECT", 1, 0.25), ("y", "INVALID ACTION", 1, 1.0)
    ]
    assert rows(scoring.outcome_summary(df, [])) == [
        ("CORRECT", 3, 0.6), ("INCORRECT", 1, 0.2), ("INVALID ACTION", 1, 0.2)
    ]
    assert rows(scoring.accuracy(df, "run")) == [("x", 0.75), ("y", 0.0)]


def test_a_round_asks_once_per_completion(spark):
    def complete(asked):
        answer = F.when(F.col("gen_id") == 0, F.concat(
            F.lit("<END_THINK><ID_"), F.col("target_id"), F.lit(">"))).otherwise("?")
        return asked.withColumn("completion", answer)

    found = agent_round(spark.range(10).toDF("k"), "k", complete, 2, generations=4)
    assert found.count() == 40
    assert rows(found.groupBy("gen_id", "outcome").count()) == [
        (0, "CORRECT", 10), (1, "INVALID ACTION", 10), (2, "INVALID ACTION", 10),
        (3, "INVALID ACTION", 10),
    ]
    assert found.where("gen_id = 0 and advantage <= 0").count() == 0
    for wrong in (lambda asked: complete(asked).where("gen_id < 1"),
                  lambda asked: complete(asked).union(complete(asked).limit(1))):
        with pytest.raises(ValueError, match="do not align"):
            agent_round(spark.range(10).toDF("k"), "k", wrong, 2, generations=4)
