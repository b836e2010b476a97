import pytest
from pyspark.sql import functions as F

from fettle.functions import rewards
from tests.helpers import rows

ACTIONS = [
    ("<END_THINK> <ID_7>", True, 7, "CORRECT", 1.0),
    ("x<END_THINK><ID_007>", True, 7, "CORRECT", 1.0),
    ("<END_THINK> <ID_7>", True, 7, "CORRECT", 1.0),
    ("<END_THINK>\x1c <ID_7>", True, 7, "CORRECT", 1.0),
    ("<END_THINK>\n<ID_9> <END_THINK><ID_7>", True, 9, "INCORRECT", -0.5),
    ("<END_THINK><ID_" + "9" * 44 + ">", True, None, "INCORRECT", -0.5),
    ("<END_THINK><ID_٧>", True, 7, "CORRECT", 1.0),
    ("<END_THINK><ID_\U0001d7d5>", True, 7, "CORRECT", 1.0),
    ("<END_THINK><ID_-7>", False, None, "INVALID ACTION", -1.0),
    ("<ID_7>", False, None, "INVALID ACTION", -1.0),
    ("", False, None, "INVALID ACTION", -1.0),
    (None, False, None, "INVALID ACTION", -1.0),
]


def test_actions_and_their_rewards(spark):
    df = spark.createDataFrame(
        [(i, a[0], 7) for i, a in enumerate(ACTIONS)], "i int, text string, target bigint"
    )
    text, target = F.col("text"), F.col("target")
    parsed = rewards.parse_action(text)
    found = df.select(
        "i", parsed["matched"], parsed["action"], rewards.action_outcome(text, target),
        rewards.task_reward(text, target),
    )
    expected = [(i, *action[1:]) for i, action in enumerate(ACTIONS)]
    assert [tuple(r) for r in found.orderBy("i").collect()] == expected


@pytest.mark.parametrize("text, count, scaled", [
    ("", 0, 0.0),
    ("abca", 3, 0.03),
    ("a😀😀é\n", 4, 0.04),
    ("a😀😀e\u0301\n", 5, 0.05),
    ("".join(chr(0x4E00 + i) for i in range(120)), 120, 1.0),
    (None, None, None),
])
def test_unique_chars(spark, text, count, scaled):
    df = spark.createDataFrame([(text,)], "text string")
    n, reward = df.select(
        rewards.unique_chars(F.col("text")), rewards.unique_chars_reward(F.col("text"))
    ).first()
    assert (n, reward) == (count, scaled)


def test_unique_chars_matches_a_set(spark):
    texts = ["naïve — ﬁn", "\t\r\n \u0000x", "éé", "👩‍👩‍👧", "aA" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = rows(df.select("text", rewards.unique_chars(F.col("text"))))
    assert found == sorted(((t, len(set(t))) for t in texts), key=repr)
