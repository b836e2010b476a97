"""Scoring of completions as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The agent's action format, the rewards and the outcome names.
# Unicode classes are switched on; \x1c-\x1f count as space in the action format as well.
ACTION_PATTERN = r"(?U)<END_THINK>[\s\x1c-\x1f]*<ID_(\d+)>"
REWARD_CORRECT = 1.0
REWARD_WRONG = -0.5
REWARD_INVALID = -1.0
CORRECT = "CORRECT"
INCORRECT = "INCORRECT"
INVALID = "INVALID ACTION"
UNIQUE_CHARS_SCALE = 100.0

_OTHER_DIGITS = [
    chr(code)
    for code in range(128, 0x110000)
    if unicodedata.category(chr(code)) == "Nd"
]
_FOLDED = "".join(str(unicodedata.decimal(digit)) for digit in _OTHER_DIGITS)


def parse_action(completion: Column) -> Column:
    """struct(matched, action) of the first action in a completion.

    ``action`` is null when nothing matched, and also when the number is too large for a
    BIGINT: such a completion did choose an item, just none that exists.
    """
    digits = F.regexp_extract(F.coalesce(completion, F.lit("")), ACTION_PATTERN, 1)
    ascii_digits = F.translate(digits, "".join(_OTHER_DIGITS), _FOLDED)
    return F.struct(
        (digits != "").alias("matched"),
        ascii_digits.try_cast("bigint").alias("action"),
    )


def _judged(completion: Column, target_id: Column, correct, wrong, invalid) -> Column:
    parsed = parse_action(completion)
    return (
        F.when(~parsed["matched"], F.lit(invalid))
        .when(parsed["action"].eqNullSafe(target_id) & target_id.isNotNull(), F.lit(correct))
        .otherwise(F.lit(wrong))
    )


def task_reward(completion: Column, target_id: Column) -> Column:
    """1.0 for the target item, -0.5 for another item, -1.0 for no recognisable action.

    Only the completion is read. A prompt already ends its thought, but a completion has to
    end the thought itself before it names an item.
    """
    return _judged(completion, target_id, REWARD_CORRECT, REWARD_WRONG, REWARD_INVALID)


def action_outcome(completion: Column, target_id: Column) -> Column:
    """The outcome in words, judged like ``task_reward``."""
    return _judged(completion, target_id, CORRECT, INCORRECT, INVALID)


def unique_chars(text: Column) -> Column:
    """Number of different characters (code points) of a text."""
    chars = F.size(F.array_distinct(F.split(text, "")))
    return F.when(text == "", F.lit(0)).when(text.isNotNull(), chars).cast("bigint")


def unique_chars_reward(text: Column) -> Column:
    """Different characters scaled to hundredths, at most 1.0; null for a null text."""
    # least() passes over nulls, so the bound is null as well; counting is written once only.
    bound = F.when(text.isNotNull(), F.lit(1.0))
    return F.least(unique_chars(text) / F.lit(UNIQUE_CHARS_SCALE), bound)
