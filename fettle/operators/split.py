"""Heads, take/skip and exact-fraction splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.functions.hashing import any_null, columns_of, require_new, seeded_hash
from fettle.operators.selection import at_or_before, nth_by_hash, nth_key, share_of


def head_rows(df: DataFrame, n: int, order_by: str | Sequence[str]) -> DataFrame:
    """The first ``n`` rows of the order, unsorted.

    The n-th key is found by counts per range of keys (``selection.nth_key``); the rows are then
    selected by a filter on the key that files can be skipped by.
    """
    order = columns_of(order_by)
    if n <= 0:
        return df.limit(0)
    last = nth_key(df, n, order)
    return df if last is None else df.where(at_or_before(order, last, df))


def take_skip(df: DataFrame, n: int, order_by: str | Sequence[str],
              labels: tuple[str, str] = ("take", "skip")) -> DataFrame:
    """Add ``split``: the first label for the first ``n`` rows of the order, else the second.

    Found like a head; the rows are compared with the n-th key where they are.
    """
    require_new(df, "split")
    order = columns_of(order_by)
    first, rest = F.lit(labels[0]), F.lit(labels[1])
    if n <= 0:
        return df.withColumn("split", rest)
    last = nth_key(df, n, order)
    if last is None:
        return df.withColumn("split", first)
    return df.withColumn("split", F.when(at_or_before(order, last, df), first).otherwise(rest))


def fraction_split(df: DataFrame, key: str | Sequence[str], test_size: float,
                   seed: int) -> DataFrame:
    """Add ``split``: exactly ``ceil(test_size * rows)`` rows are ``test``, the rest ``train``.

    Our definition: the test rows are those with the smallest ``md5(seed|key)``. The last of
    them is found by counts per prefix of the hash (``selection.nth_by_hash``); the labels are
    then a comparison inside each row. Neither rows nor keys are shuffled. The key must not be
    null, and not repeated where the border falls.
    """
    if not 0.0 <= test_size <= 1.0:
        raise ValueError("test_size must lie between 0 and 1")
    require_new(df, "split")
    order = columns_of(key)
    hashed = df.withColumn("__hash", seeded_hash(seed, *order))
    last = nth_by_hash(hashed, "__hash", order, share_of(test_size))
    if last is None:  # a test part of no rows
        return df.withColumn("split", F.lit("train"))
    is_test = at_or_before(["__hash", *order], last, hashed)
    return hashed.withColumn(
        "split", F.when(is_test, F.lit("test")).otherwise(F.lit("train"))
    ).drop("__hash")


def split_sizes(df: DataFrame) -> DataFrame:
    """Rows per split."""
    return df.groupBy("split").agg(F.count("*").alias("n_rows"))


def describe_corpus(df: DataFrame, order_by: str | Sequence[str]) -> DataFrame:
    """One row: number of rows, column names, and the first row of the order as a struct.

    Keys are read for all rows, the other columns only where the first key is found.
    """
    order = columns_of(order_by)
    facts = df.agg(
        F.count("*").alias("n_rows"),
        F.min(F.struct(*order)).alias("first_key"),
        F.bool_or(any_null(order)).alias("has_null"),
    ).first()
    if facts["has_null"]:
        raise ValueError(f"null in the order {list(order)}")
    described = [
        F.lit(facts["n_rows"]).cast("bigint").alias("n_rows"),
        F.array(*[F.lit(name) for name in df.columns]).alias("columns"),
    ]
    if facts["first_key"] is None:
        return df.agg(F.first(F.struct(*df.columns)).alias("first_row")).select(
            *described, "first_row"
        )
    first = df.where(at_or_before(order, facts["first_key"], df))
    return first.limit(1).select(*described, F.struct(*df.columns).alias("first_row"))
