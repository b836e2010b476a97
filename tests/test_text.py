import pytest
from pyspark.sql import functions as F

from fettle.functions import text, tokens
from fettle.operators.chat import chat_pieces, dialogue_pairs, render_chat
from tests.helpers import plan_of, rows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_templates(spark):
    df = spark.createDataFrame([("p", "c"), ("p", None)], "prompt string, completion string")
    assert rows(text.with_tldr_text(df), "text") == [("Post: p\n\nTL;DR: c",), (None,)]
    shown = rows(text.with_tldr_text(df, null_text="None"), "text")
    assert ("Post: p\n\nTL;DR: None",) in shown
    qa = spark.createDataFrame(
        [("q", "a", "b", 5)], "question string, response_j string, response_k string, x int"
    )
    assert rows(text.with_qa_text(qa)) == [("q", "a", "b", 5, "Question: q\n\nAnswer: a")]


def test_observation_prompt(spark):
    prompt = text.observation_prompt(F.array(F.lit(3), F.lit(15)))
    assert one(spark, prompt) == (
        "<|obs|><ID_3> <ID_15><|agent|><THINK>The items are <ID_3> <ID_15>. "
        "I need to identify the first item and select it.<END_THINK>"
    )


def test_generated_part(spark):
    part = text.generated_part(F.lit("aé😀"), F.lit("aé😀bc"))
    assert one(spark, part) == "bc"
    assert one(spark, text.generated_part(F.lit("xyz"), F.lit("abcde"))) == "de"
    assert one(spark, text.generated_part(F.lit("xyz"), F.lit("abcde"), True)) is None
    assert one(spark, text.generated_part(F.lit("abc"), F.lit("abc"), True)) == ""


def test_strip_special_tries_longer_tokens_first(spark):
    assert one(spark, text.strip_special(F.lit("a<x>>b<x>c.d"), ["<x>", "<x>>", "."])) == "abcd"


def test_truncation_keeps_prompt_ends_and_completion_starts(spark):
    listed = F.array(*[F.lit(c) for c in "abcde"])
    assert one(spark, tokens.truncate_tokens(listed, 2, "prompt")) == ["d", "e"]
    assert one(spark, tokens.truncate_tokens(listed, 2, "completion")) == ["a", "b"]
    assert one(spark, tokens.truncate_tokens(listed, 9, "prompt")) == list("abcde")
    assert one(spark, tokens.generated_tokens(F.slice(listed, 1, 3), listed)) == ["d", "e"]
    assert one(spark, tokens.generated_tokens(listed, listed)) == []
    assert one(spark, tokens.is_clipped(F.size(listed), 5)) is True
    assert one(spark, tokens.completion_length(F.size(listed), 3)) == 3
    with pytest.raises(ValueError):
        tokens.truncate_tokens(listed, 2, "middle")


def test_tokens(spark):
    assert one(spark, tokens.tokenize(F.lit("Été 2x, ok!\n😀"))) == [
        "Été", "2x", ",", "ok", "!", "😀"
    ]
    assert one(spark, tokens.token_count(F.lit(""))) == 0


MESSAGES = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"),
    (2, 0, "system", "be brief"), (2, 1, "user", "why?"), (2, 2, "assistant", None),
]
PLAIN = "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n"
FIRST = PLAIN + "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n"
SECOND = (
    "<|im_start|>system\nbe brief<|im_end|>\n<|im_start|>user\nwhy?<|im_end|>\n"
    "<|im_start|>assistant\n<|im_end|>\n"
)


def messages(spark, data=MESSAGES):
    return spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string")


def test_chat(spark):
    assert rows(render_chat(messages(spark))) == [(1, 0, FIRST), (2, 0, SECOND)]
    opened = rows(render_chat(messages(spark), add_generation_prompt=True))
    opening = "<|im_start|>assistant\n"
    assert opened == [(1, 0, FIRST + opening), (2, 0, SECOND + opening)]


def test_long_chats_come_in_parts_that_join_to_the_whole(spark):
    data = [(1, t, ("user", "assistant")[t % 2], f"message {t} " * (t % 7)) for t in range(900)]
    data += [(c, t, "user", f"{c}/{t}") for c in range(2, 30) for t in range(3)]
    whole = {r["conv_id"]: r["prompt"] for r in render_chat(messages(spark, data)).collect()}
    parts = render_chat(messages(spark, data), max_part_chars=2_000)
    assert parts.where("conv_id = 1").count() > 10
    assert parts.agg(F.max(F.length("prompt"))).first()[0] < 2_000 + 200
    joined = {}
    for row in parts.orderBy("conv_id", "part").collect():
        joined[row["conv_id"]] = joined.get(row["conv_id"], "") + row["prompt"]
    assert joined == whole
    assert chat_pieces(messages(spark, data)).count() == len(data) + 29


def test_chats_that_cannot_be_ordered_are_refused(spark):
    with pytest.raises(Exception, match="not unique"):
        render_chat(messages(spark, MESSAGES + MESSAGES[:1])).collect()
    with pytest.raises(Exception, match="null in role"):
        render_chat(messages(spark, MESSAGES + [(1, 2, None, "x")])).collect()
    fractions = spark.createDataFrame(
        [(1, 1.7, "assistant", "a"), (1, 1.2, "user", "b")],
        "conv_id bigint, turn double, role string, text string")
    assert render_chat(fractions).first()["prompt"].index("b<") < render_chat(
        fractions).first()["prompt"].index("a<")


def brute_pairs(data):
    found, ordered = [], sorted(data)
    for (conv, turn, role, question), (other, _, reply_role, reply) in zip(ordered, ordered[1:]):
        if conv == other and (role, reply_role) == ("user", "assistant"):
            found.append((conv, turn, question, reply))
    return sorted(found, key=repr)


@pytest.mark.parametrize("gap", [1, 3])
def test_pairs_with_and_without_gaps_in_one_large_conversation(spark, gap):
    data = [
        (0 if i % 3 else i % 5 + 1, i // 15 * 15 * gap + i % 15 * gap,
         ("user", "assistant", "user", "system", "assistant")[(i * 7 + i // 11) % 5], f"t{i}")
        for i in range(1_500)
    ]
    if gap == 1:
        turns, dense = {}, []
        for conv, _, role, words in sorted(data):
            dense.append((conv, turns.get(conv, 0), role, words))
            turns[conv] = turns.get(conv, 0) + 1
        data = dense
    pairs = dialogue_pairs(messages(spark, data))
    assert rows(pairs) == brute_pairs(data)
    assert "Window" not in plan_of(pairs) or gap > 1


def test_repeated_turns_are_an_error(spark):
    with pytest.raises(ValueError, match="not unique"):
        dialogue_pairs(messages(spark, MESSAGES + MESSAGES[:1]))
    with pytest.raises(ValueError, match="null"):
        dialogue_pairs(messages(spark, MESSAGES + [(None, 0, "user", "x")]))
