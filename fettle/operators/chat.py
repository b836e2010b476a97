"""Conversations: rendering in chat markup, and question/answer pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.functions.hashing import any_null
from fettle.functions.text import CHAT_START, DEFAULT_SYSTEM_MESSAGE, chat_message
from fettle.operators.ordered import join_null_safe, running_total, with_neighbour

# Characters of one rendered value: at most 256 MB of UTF-8, well inside what a row can hold.
MAX_PART_CHARS = 1 << 26


def chat_pieces(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                text: str = "text", add_generation_prompt: bool = False) -> DataFrame:
    """(key, place, order, piece): the rendered pieces of every conversation, row by row.

    Sorted by (place, order) and joined, they are the rendered chat: a default system message
    where the first message is none, the messages, and on request an open assistant header.
    A message without a role is an error; the order keeps its own type.
    """
    no_role = F.raise_error(F.lit(f"null in {role}"))
    messages = df.select(
        key,
        F.lit(1).alias("place"),
        F.col(order).alias("order"),
        F.when(F.col(role).isNull(), no_role)
        .otherwise(chat_message(F.col(role), F.col(text))).alias("piece"),
    )
    starts_with_system = F.min_by(F.col(role) == "system", order).alias("has_system")
    header = F.when(
        ~F.col("has_system"),
        chat_message(F.lit("system"), F.lit(DEFAULT_SYSTEM_MESSAGE)),
    )
    frame = [F.struct(F.lit(0).alias("place"), header.alias("piece"))]
    if add_generation_prompt:
        opening = F.lit(f"{CHAT_START}assistant\n")
        frame.append(F.struct(F.lit(2).alias("place"), opening.alias("piece")))
    added = (
        df.groupBy(key).agg(starts_with_system)
        .select(key, F.inline(F.array(*frame)))
        .where(F.col("piece").isNotNull())
        .select(key, "place", F.lit(0).cast(df.schema[order].dataType).alias("order"), "piece")
    )
    return messages.unionByName(added)


def render_chat(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                text: str = "text", add_generation_prompt: bool = False,
                max_part_chars: int = MAX_PART_CHARS) -> DataFrame:
    """(key, ``part``, ``prompt``): each conversation in chat markup.

    A conversation up to ``max_part_chars`` characters is part 0. A longer one has several:
    joined in order of ``part`` they are the whole chat, and no task has to hold a conversation
    that does not fit. (key, order) must be unique and the order not null.
    """
    pieces = chat_pieces(df, key, order, role, text, add_generation_prompt)
    n_chars = F.length("piece").cast("bigint")
    position = ["place", "order"]
    starts = running_total(pieces, n_chars, position, key, name="start")
    placed = join_null_safe(pieces, starts, [key, *position]).withColumn(
        "part", F.expr(f"start div {int(max_part_chars)}")
    )
    gathered = placed.groupBy(key, "part").agg(
        F.array_sort(F.collect_list(F.struct("place", "order", "piece"))).alias("pieces")
    )
    return gathered.select(key, "part", F.array_join("pieces.piece", "").alias("prompt"))


def _turns_have_gaps(df: DataFrame, key: str, order: str) -> bool:
    turns = df.groupBy(key, order).agg(F.count("*").alias("n"))
    spans = turns.groupBy(key).agg(
        (F.max(order) - F.min(order) + 1 != F.sum("n")).alias("gap"),
        (F.max("n") > 1).alias("twice"),
        F.bool_or(any_null([key, order])).alias("null_key"),
    )
    found = spans.agg(
        *[F.bool_or(name).alias(name) for name in ("gap", "twice", "null_key")]
    ).first()
    if found["null_key"]:
        raise ValueError(f"null in ({key}, {order})")
    if found["twice"]:
        raise ValueError(f"({key}, {order}) is not unique")
    return bool(found["gap"])


def dialogue_pairs(df: DataFrame, key: str = "conv_id", order: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """(key, order, ``question``, ``response_j``): each user message answered by the next one.

    Where turns are numbered without gaps, the answer is found by joining on (key, order + 1).
    That key is unique, so a conversation of any length is spread evenly, and texts are
    shuffled once. With gaps the following turn is looked up on the keys alone before that.
    """
    questions = df.where(F.col(role) == "user").select(
        key, order, F.col(text).alias("question")
    )
    answers = df.where(F.col(role) == "assistant").select(
        key, F.col(order).alias("answer_at"), F.col(text).alias("response_j")
    )
    if _turns_have_gaps(df, key, order):
        turns = with_neighbour(
            df.select(key, order, role), [order, role], order, key, step=1, prefix="next_"
        )
        answered = turns.where(
            (F.col(role) == "user") & (F.col(f"next_{role}") == "assistant")
        ).select(key, order, F.col(f"next_{order}").alias("answer_at"))
        questions = questions.join(answered, [key, order])
    else:
        questions = questions.withColumn("answer_at", F.col(order) + 1)
    return questions.join(answers, [key, "answer_at"]).select(
        key, order, "question", "response_j"
    )
