import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fettle.functions import hooks
from tests.helpers import rows


def test_row_function(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, t string")
    shaped = hooks.map_rows(df, lambda row: {"k": row["k"], "u": f"<{row['t']}>"},
                            "k int, u string")
    assert rows(shaped) == [(1, "<a>"), (2, "<None>")]
    numbers = spark.createDataFrame([(None,), (2**60 + 1,)], "k bigint")
    shown = hooks.map_rows(numbers, lambda row: {"u": repr(row["k"])}, "u string")
    assert rows(shown) == [("1152921504606846977",), ("None",)]


def test_reward_function_gets_its_columns(spark):
    df = spark.createDataFrame([("ab", 2), ("abc", 5)], "t string, target int")

    def score(completions, **columns):
        return [float(len(c) == n) for c, n in zip(completions, columns["target"])]

    reward = hooks.reward_udf(score, ["target"])
    assert rows(df.select("t", reward(F.col("t")))) == [("ab", 1.0), ("abc", 0.0)]
    seen = hooks.reward_udf(lambda completions, **columns: [
        float(value is None) for value in columns["target"]], ["target"])
    nulls = spark.createDataFrame([("a", None), ("b", 1)], "t string, target bigint")
    assert rows(nulls.select("t", seen(F.col("t")))) == [("a", 1.0), ("b", 0.0)]


def test_a_reward_function_must_answer_for_all(spark):
    reward = hooks.reward_udf(lambda completions: [1.0])
    with pytest.raises(Exception, match="1 rewards for 2 completions"):
        spark.range(2, numPartitions=1).select(reward(F.lit("x"))).collect()


def test_tokenizer_and_generator(spark):
    df = spark.createDataFrame([("a b",), (None,)], "t string")
    words = hooks.tokenizer_udf(str.split)
    assert rows(df.select(words(F.col("t")))) == [(None,), (["a", "b"],)]

    def shout(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(completion=batch["t"].str.upper())

    assert rows(hooks.generate_with(df.dropna(), shout, "t string, completion string")) == [
        ("a b", "A B")
    ]


def test_a_tokenizer_gets_texts_in_slices(monkeypatch):
    monkeypatch.setattr(hooks, "SLICE", 4)
    texts = pa.array(["ab", None, "cd", "e", "0123456789", "", "f"])
    parts = [part.to_pylist() for part in hooks._slices(texts.slice(1))]
    assert parts == [[None, "cd", "e"], ["0123456789"], ["", "f"]]
    assert list(hooks._slices(texts.slice(0, 0))) == []


def test_tokenizer_over_many_slices(spark):
    words = hooks.tokenizer_udf(str.split)
    df = spark.range(30, numPartitions=1).selectExpr(
        "id", "if(id % 10 = 3, null, repeat(concat('w', id, ' '), 50000)) AS text")
    found = {r.id: (r.n, r.first) for r in df.select("id", F.size(words(F.col("text"))).alias("n"),
                                                     words(F.col("text"))[0].alias("first")).collect()}
    assert found == {k: (None, None) if k % 10 == 3 else (50000, f"w{k}") for k in range(30)}
