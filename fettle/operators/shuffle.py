"""Seeded shuffles, repetition of data, and batch plans."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fettle.functions.hashing import any_null, columns_of, require_new, seeded_hash
from fettle.operators.ordered import ordinals, with_ordinal
from fettle.operators.tasks import expand_generations

# 16**4 = 65,536 hash buckets at most; this also bounds the broadcast table of their starts.
BUCKET_DIGITS = 4


def shuffle_rows(df: DataFrame, key: str | Sequence[str], seed: int) -> DataFrame:
    """Add ``shuffle_pos``: the 0-based position in a seeded order of all rows.

    Our definition: the order of ``md5(seed|key)``, then key; the key must be unique and not null. Hash
    digits form even buckets, so the position is the bucket's start plus the rank inside it:
    one shuffle and no window over all rows.
    """
    order = columns_of(key)
    hashed = df.withColumn("__hash", seeded_hash(seed, *order)).withColumn(
        "__bucket", F.substring("__hash", 1, BUCKET_DIGITS)
    )
    counts = hashed.groupBy("__bucket").agg(F.count("*").alias("__n"))
    starts = counts.select(
        "__bucket",
        (F.sum("__n").over(Window.orderBy("__bucket")) - F.col("__n")).alias("__start"),
    )
    inside = Window.partitionBy("__bucket").orderBy("__hash", *order)
    here = F.struct(*order)
    repeated = F.raise_error(F.lit(f"{order} is not unique"))
    null_key = F.raise_error(F.lit(f"null in {order}"))
    rank = (
        F.when(any_null(order), null_key)
        .when(F.lag(here).over(inside).eqNullSafe(here), repeated)
        .otherwise(F.row_number().over(inside))
    )
    return (
        hashed.withColumn("__rank", rank)
        .join(F.broadcast(starts), "__bucket")
        .select(*df.columns, (F.col("__start") + F.col("__rank") - 1).alias("shuffle_pos"))
    )


def shuffle_blocks(df: DataFrame, key: str | Sequence[str], seed: int, buffer: int = 5000,
                   order_by: str | Sequence[str] | None = None) -> DataFrame:
    """Add ``block`` and ``shuffle_pos``: rows shuffled inside blocks of ``buffer`` rows.

    Our definition: consecutive blocks of the order, each put into ``md5(seed|key)`` order. It
    keeps the point of a shuffle buffer, that rows move a bounded distance, but does not
    reproduce a reservoir's draws.
    """
    if buffer < 1:
        raise ValueError("buffer must be at least 1")
    order = columns_of(key)
    numbered = with_ordinal(df, order_by or order, "__ordinal").withColumn(
        "block", F.floor(F.col("__ordinal") / F.lit(buffer))
    )
    inside = Window.partitionBy("block").orderBy(seeded_hash(seed, *order), *order)
    return numbered.withColumn(
        "shuffle_pos", F.col("block") * buffer + F.row_number().over(inside) - 1
    ).select(*df.columns, "block", "shuffle_pos")


def repeat_rows(df: DataFrame, epochs: int) -> DataFrame:
    """Each row once per epoch, with ``epoch`` from 0."""
    if epochs < 1:
        raise ValueError("epochs must be at least 1")
    require_new(df, "epoch")
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))


def repeat_until(df: DataFrame, order_by: str | Sequence[str], rows_needed: int) -> DataFrame:
    """Endless data cut at ``rows_needed`` rows: whole epochs, then the head of one more.

    Adds ``epoch`` and ``position``, the 0-based place in the repeated sequence.
    """
    order = columns_of(order_by)
    placed = ordinals(df, order, "__ordinal")
    n_rows = placed.count()
    if n_rows == 0:
        raise ValueError("no rows to repeat")
    epochs = max(1, math.ceil(rows_needed / n_rows))
    numbered = df.join(placed, order)
    position = F.col("epoch").cast("bigint") * n_rows + F.col("__ordinal")
    return (
        repeat_rows(numbered, epochs)
        .withColumn("position", position)
        .where(F.col("position") < rows_needed)
        .select(*df.columns, "epoch", "position")
    )


def plan_batches(df: DataFrame, order_by: str | Sequence[str], batch: int, accum: int = 1,
                 generations: int = 1, drop_last: bool = False,
                 max_steps: int | None = None) -> DataFrame:
    """Place every sample into a training step.

    A sample is a row, or with several ``generations`` one of a row's completions. In order,
    ``batch`` samples form a micro-batch and ``accum`` micro-batches a step. Adds
    ``micro_step`` (0-based inside its step), ``step`` (1-based), ``epoch_progress`` at the end
    of the step, and ``gen_id`` if there are several. ``drop_last`` leaves out an unfilled last
    micro-batch, ``max_steps`` the later steps.
    """
    if min(batch, accum, generations) < 1:
        raise ValueError("batch, accum and generations must be at least 1")
    added = ["gen_id"] if generations > 1 else []
    require_new(df, "step", "micro_step", "epoch_progress", *added)
    order = columns_of(order_by)
    places = ordinals(df, order, "__ordinal")
    n_samples = places.count() * generations
    samples, number = df.join(places, order), F.col("__ordinal")
    if generations > 1:
        samples = expand_generations(samples, generations)
        number = number * generations + F.col("gen_id")
    planned = samples.withColumn("__micro", F.floor(number / F.lit(batch))).select(
        *df.columns,
        *added,
        (F.floor(F.col("__micro") / F.lit(accum)) + 1).alias("step"),
        (F.col("__micro") % accum).alias("micro_step"),
        "__micro",
    )
    if drop_last:
        planned = planned.where(F.col("__micro") < n_samples // batch)
    if max_steps is not None:
        planned = planned.where(F.col("step") <= max_steps)
    seen = F.least(F.col("step") * (batch * accum), F.lit(n_samples))
    return planned.withColumn(
        "epoch_progress", seen / F.lit(float(n_samples))
    ).drop("__micro")
