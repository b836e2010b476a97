"""Templates, prompts and cuts of text."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The formats of the training texts, the agent prompt and the chat messages.
TLDR_PARTS = ("Post: ", "\n\nTL;DR: ")
QA_PARTS = ("Question: ", "\n\nAnswer: ")
OBSERVATION_PROMPT = (
    "<|obs|>{ids}<|agent|><THINK>The items are {ids}. "
    "I need to identify the first item and select it.<END_THINK>"
)
CHAT_START = "<|im_start|>"
CHAT_END = "<|im_end|>"
DEFAULT_SYSTEM_MESSAGE = "You are a helpful assistant."


def _labelled(first_label: str, first: Column, second_label: str, second: Column,
              null_text: str | None) -> Column:
    def shown(column: Column) -> Column:
        return column if null_text is None else F.coalesce(column, F.lit(null_text))

    return F.concat(F.lit(first_label), shown(first), F.lit(second_label), shown(second))


def tldr_text(prompt: Column, completion: Column, null_text: str | None = None) -> Column:
    """A post and its summary as one training text.

    A null field makes the text null; ``null_text`` names a word to print instead.
    """
    return _labelled(TLDR_PARTS[0], prompt, TLDR_PARTS[1], completion, null_text)


def qa_text(question: Column, answer: Column, null_text: str | None = None) -> Column:
    """A question and its preferred answer as one training text; nulls as in ``tldr_text``."""
    return _labelled(QA_PARTS[0], question, QA_PARTS[1], answer, null_text)


def with_tldr_text(df: DataFrame, null_text: str | None = None) -> DataFrame:
    """Add ``text`` from ``prompt`` and ``completion``."""
    return df.withColumn("text", tldr_text(F.col("prompt"), F.col("completion"), null_text))


def with_qa_text(df: DataFrame, null_text: str | None = None) -> DataFrame:
    """Add ``text`` from ``question`` and ``response_j``."""
    return df.withColumn("text", qa_text(F.col("question"), F.col("response_j"), null_text))


def id_token(item_id: Column) -> Column:
    """The vocabulary token of an item id."""
    return F.concat(F.lit("<ID_"), item_id.cast("string"), F.lit(">"))


def observation_prompt(item_ids: Column) -> Column:
    """The prompt that shows an agent its items, up to the end of its given thought."""
    shown = F.array_join(F.transform(item_ids, id_token), " ")
    return F.replace(F.lit(OBSERVATION_PROMPT), F.lit("{ids}"), shown)


def chat_message(role: Column, content: Column) -> Column:
    """One message in chat markup; a null content counts as empty."""
    shown = F.coalesce(content, F.lit(""))
    return F.concat(
        F.lit(CHAT_START), role, F.lit("\n"), shown, F.lit(CHAT_END), F.lit("\n")
    )


def generated_part(prompt: Column, full: Column, require_prefix: bool = False) -> Column:
    """What follows the prompt's length in a full sequence.

    The prefix itself is not compared unless ``require_prefix`` is set; then a sequence that
    does not start with the prompt gives null.
    """
    rest = F.substring(full, F.length(prompt) + 1, F.length(full))
    return F.when(F.startswith(full, prompt), rest) if require_prefix else rest


def special_pattern(tokens: Iterable[str]) -> str:
    """A pattern for any of the tokens, the longer ones tried first."""
    return "|".join(re.escape(t) for t in sorted(set(tokens), key=lambda t: (-len(t), t)))


def strip_special(text: Column, tokens: Iterable[str]) -> Column:
    """Text without the given tokens."""
    return F.regexp_replace(text, F.lit(special_pattern(tokens)), F.lit(""))
