import random

import pytest
from pyspark.sql import functions as F

from fettle.functions.hooks import tokenizer_udf
from fettle.operators.packing import chars_per_token, chunk_estimate, pack_sequences
from fettle.plans.jobs import packed_answers
from tests.helpers import plan_of


def texts(spark, data):
    return spark.createDataFrame(data, "k bigint, text string")


def packed(df, group=()):
    return [tuple(r) for r in df.orderBy(*group, "chunk_id").collect()]


def brute(streams, length):
    """Chunks of (order, text) lists whose texts are already spaced tokens."""
    tokens = [t for _, text in sorted(streams) for t in [*(text or "").split(), "<eos>"]]
    return [tokens[i: i + length] for i in range(0, len(tokens) - length + 1, length)]


def test_the_small_case(spark):
    df = texts(spark, [(2, "d e f"), (0, "a b"), (1, "c")])
    assert packed(pack_sequences(df, "text", "k", 4)) == [
        (0, ["a", "b", "<eos>", "c"]), (1, ["<eos>", "d", "e", "f"])
    ]


@pytest.mark.parametrize("length", [1, 3, 64, 1000])
def test_packing_keeps_every_token_in_order(spark, length):
    draw = random.Random(length)
    data = [
        (k * 3, " ".join(str(draw.randrange(90)) for _ in range(draw.choice([0, 1, 5, 40]))))
        for k in range(200)
    ]
    data.append((301, " ".join(str(i) for i in range(6_000))))  # one text with most tokens
    data.append((302, None))
    df = texts(spark, data)
    expected = list(enumerate(brute(data, length)))
    assert packed(pack_sequences(df, "text", "k", length)) == expected
    assert packed(pack_sequences(df.repartition(13), "text", "k", length)) == expected


def test_groups_are_streams_of_their_own(spark):
    draw = random.Random(1)
    data = [("big" if k % 4 else f"s{k % 3}", k, " ".join("x" * draw.randrange(9)))
            for k in range(400)]
    df = spark.createDataFrame(data, "grp string, k bigint, text string")
    found = packed(pack_sequences(df, "text", "k", 7, group_by="grp"), ["grp"])
    expected = []
    for grp in sorted({d[0] for d in data}):
        chunks = brute([d[1:] for d in data if d[0] == grp], 7)
        expected += [(grp, i, chunk) for i, chunk in enumerate(chunks)]
    assert found == expected


def test_own_tokenizer_and_separator(spark):
    letters = tokenizer_udf(lambda text: list(text))
    df = texts(spark, [(0, "ab"), (1, "c d")])
    found = packed(pack_sequences(df, "text", "k", 3, sep="|", tokenizer=letters))
    assert found == [(0, ["a", "b", "|"]), (1, ["c", " ", "d"])]


def test_no_window_over_all_rows(spark):
    plan = plan_of(pack_sequences(texts(spark, [(0, "a")]), "text", "k", 4))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_ratio_of_sums(spark):
    df = texts(spark, [(0, "a b"), (1, "abcd"), (2, "ignored entirely")])
    assert tuple(chars_per_token(df, "text", "k", n=2).first()) == (7, 3, 7 / 3)
    assert chars_per_token(df, "text", "k").first()["n_tokens"] == 5
    estimate = chunk_estimate(df, "text", "k", 2, n=2).first()
    assert tuple(estimate) == (23, pytest.approx(23 / (7 / 3) / 2))
    assert chars_per_token(texts(spark, [(0, "")]), "text", "k").first()[2] is None


def test_training_rows_repeat_and_test_rows_do_not(spark):
    pairs = spark.createDataFrame(
        [(k, f"q{k}", f"a{k}") for k in range(40)], "k int, question string, response_j string"
    )
    once = packed_answers(pairs, "k", test_size=0.25, seq_length=8)
    thrice = packed_answers(pairs, "k", test_size=0.25, seq_length=8, epochs=3)

    def tokens(df, split):
        return df.where(F.col("split") == split).count()

    # Each text is "Question : q Answer : a" and a separator: 7 tokens.
    assert tokens(once, "train") == 30 * 7 // 8 and tokens(thrice, "train") == 90 * 7 // 8
    assert tokens(once, "test") == tokens(thrice, "test") == 10 * 7 // 8


def test_a_text_is_tokenized_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def letters(text):
        calls.add(1)
        return list(text)

    df = texts(spark, [(k, "ab" * k) for k in range(20)])
    found = pack_sequences(df, "text", "k", 3, tokenizer=tokenizer_udf(letters)).collect()
    assert len(found) == (20 + 380) // 3
    assert calls.value == 20
