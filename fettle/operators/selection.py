"""The n-th key of an order, found by counting: no row and no key is moved to find it.

A head, a take/skip and an exact split need one key, the last one taken. It is found by counts
per range of keys, taken on the map side: the range that holds the n-th key is cut again until
it has at most ``RANGE_ROWS`` keys, and only those are put in order, in one task. Each pass reads
the key columns of the rows that are still in question.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from fettle.functions.hashing import HEX_DIGITS, any_null

RANGE_ROWS = 50_000  # keys that are put in order at last
SAMPLE = 1_024  # keys drawn to cut a range
RANGES = 64  # ranges a pass counts
PREFIX_DIGITS = 3  # hex digits of a hash that a pass counts by: 4,096 counts


def _literal(name: str, value, df: DataFrame) -> Column:
    return F.lit(value).cast(df.schema[name].dataType)


def at_or_before(names: Sequence[str], bound: Row, df: DataFrame) -> Column:
    """Whether (names) is at or before the bound, column by column."""
    found = None
    for name in reversed(list(names)):
        limit = _literal(name, bound[name], df)
        if found is None:
            found = F.col(name) <= limit
        else:
            found = (F.col(name) < limit) | ((F.col(name) == limit) & found)
    return found


def nth_key(df: DataFrame, n: int, order: Sequence[str]) -> Row | None:
    """Key of the n-th row (from 1) of any order, None if there are fewer than ``n`` rows.

    Ranges are cut at keys drawn by their hash, so the same rows give the same cuts. A null in
    the order is an error. So is a repeated key in the range that is put in order at last or
    among the keys drawn, and always where the n-th and the next key are equal.
    """
    rows, checked = df.select(*order), False
    while True:
        drawn = (rows.where(~any_null(order)).orderBy(F.xxhash64(*order)).limit(SAMPLE)
                 .orderBy(*order).collect())
        if any(a == b for a, b in zip(drawn, drawn[1:])):
            raise ValueError(f"{list(order)} is not unique")
        step = max(1, len(drawn) // RANGES)
        borders = drawn[step - 1::step]
        counts = _counted(rows, order, borders, not checked)
        checked = True
        before = 0
        for place, count in enumerate(counts):
            if n <= before + count:
                break
            before += count
        else:
            return None
        if place:
            rows = rows.where(~at_or_before(order, borders[place - 1], df))
        if place < len(borders):
            rows = rows.where(at_or_before(order, borders[place], df))
        n -= before
        if count <= RANGE_ROWS:
            return _nth_of_few(rows, n, order)


def _counted(rows: DataFrame, order: Sequence[str], borders: list[Row],
             check_nulls: bool) -> list[int]:
    """Number of keys up to each border and beyond the last, in one pass."""

    def place(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(at_or_before(order, borders[middle], rows), place(low, middle)).otherwise(
            place(middle + 1, high))

    where = place(0, len(borders))
    if check_nulls:
        where = F.when(any_null(order), F.lit(-1)).otherwise(where)
    found = {r["place"]: r["count"] for r in rows.groupBy(where.alias("place")).count().collect()}
    if -1 in found:
        raise ValueError(f"null in the order {list(order)}")
    return [found.get(k, 0) for k in range(len(borders) + 1)]


def _nth_of_few(rows: DataFrame, n: int, order: Sequence[str]) -> Row:
    """The n-th of at most ``RANGE_ROWS`` rows; the next one is looked at too."""
    one_task = Window.orderBy(*order)
    here = F.struct(*order)
    numbered = rows.select(
        here.alias("key"), F.row_number().over(one_task).alias("place"),
        F.lag(here).over(one_task).eqNullSafe(here).alias("again"))
    found = numbered.agg(
        F.max(F.when(F.col("place") == n, F.col("key"))).alias("key"),
        F.bool_or("again").alias("again")).first()
    if found["again"]:
        raise ValueError(f"{list(order)} is not unique")
    return found["key"]


def nth_by_hash(df: DataFrame, hashed: str, order: Sequence[str],
                wanted: Callable[[int], int]) -> Row | None:
    """(hash, order) of the n-th row in the order of a hash, then key; n is ``wanted(rows)``.

    Hashes of hex digits are even, so they need no sample: rows are counted by the next digits
    of the hash, among those that share the digits known so far. None where n is 0. Nulls and
    repeated keys are errors as for ``nth_key``.
    """
    full = [hashed, *order]
    rows, known, n = df.select(*full), "", None
    while True:
        digits = F.substring(hashed, len(known) + 1, PREFIX_DIGITS)
        if n is None:
            digits = F.when(~any_null(order), digits)
        counts = {r["digits"]: r["count"]
                  for r in rows.groupBy(digits.alias("digits")).count().collect()}
        if n is None:
            if None in counts:
                raise ValueError(f"null in the order {list(order)}")
            n = wanted(sum(counts.values()))
            if n <= 0:
                return None
        for prefix in sorted(counts):
            if n <= counts[prefix]:
                break
            n -= counts[prefix]
        else:
            raise ValueError("there are fewer rows than wanted")
        known += prefix
        rows = rows.where(F.col(hashed).startswith(known))
        if counts[prefix] <= RANGE_ROWS:
            return _nth_of_few(rows, n, full)
        if len(known) >= HEX_DIGITS:  # so many rows of one hash are one key
            raise ValueError(f"{list(order)} is not unique")


def share_of(fraction: float) -> Callable[[int], int]:
    """ceil(fraction * rows)."""
    return lambda rows: math.ceil(fraction * rows)
