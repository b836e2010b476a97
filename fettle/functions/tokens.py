"""Token expressions. The default tokenizer is a pattern, so it stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Our definition of a token: a run of letters and digits, or one other visible character.
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"


def tokenize(text: Column) -> Column:
    """Tokens of a text, in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def token_count(text: Column) -> Column:
    """Number of tokens of a text."""
    return F.size(tokenize(text)).cast("bigint")


def truncate_tokens(tokens: Column, limit: int, side: str) -> Column:
    """At most ``limit`` tokens. Our definition: ``side="prompt"`` keeps the last ones,
    ``side="completion"`` the first ones."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    if side == "completion":
        return F.slice(tokens, 1, limit)
    if side == "prompt":
        first = F.greatest(F.size(tokens) - F.lit(limit - 1), F.lit(1))
        return F.slice(tokens, first, F.lit(limit))
    raise ValueError(f"side must be 'prompt' or 'completion', not {side!r}")


def generated_tokens(prompt: Column, full: Column) -> Column:
    """The tokens of a full sequence after as many as the prompt has."""
    return F.slice(full, F.size(prompt) + 1, F.greatest(F.size(full), F.lit(1)))


def completion_length(n_tokens: Column, limit: int) -> Column:
    """Length of a completion after the limit."""
    return F.least(n_tokens, F.lit(limit)).cast("bigint")


def is_clipped(n_tokens: Column, limit: int) -> Column:
    """Whether a completion used up its limit and so did not end by itself."""
    return n_tokens >= F.lit(limit)
