"""Seeded hashes of row keys: the only source of randomness in the package.

``md5(seed|key)`` depends on the row alone, so a split or a shuffle gives the same rows under
any partitioning, after any retry, and in any other SQL engine.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEX_DIGITS = 32


def columns_of(names: str | Sequence[str]) -> list[str]:
    """A column-name argument as a list."""
    return [names] if isinstance(names, str) else list(names)


def any_null(names: Sequence[str]) -> Column:
    """Whether one of the columns is null."""
    return reduce(lambda a, b: a | b, [F.col(name).isNull() for name in names])


def require_new(df: DataFrame, *names: str) -> None:
    """Refuse to add columns a frame already has."""
    taken = sorted({c.lower() for c in df.columns} & {name.lower() for name in names})
    if taken:
        raise ValueError(f"columns {taken} exist already; rename them first")


def seeded_hash(seed: int, *keys: Column | str) -> Column:
    """32 hex digits: md5 of the seed and the keys, joined by ``|``."""
    parts = [F.lit(str(seed))] + [F.coalesce(_col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def hash_number(hashed: Column, start: int = 1, digits: int = 8) -> Column:
    """``digits`` hex digits of a hash as a BIGINT."""
    return F.conv(F.substring(hashed, start, digits), 16, 10).cast("bigint")


def _col(key: Column | str) -> Column:
    return F.col(key) if isinstance(key, str) else key
