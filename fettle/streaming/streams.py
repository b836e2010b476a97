"""Splits, shuffles and log windows on streams.

Results go to Parquet folders, not through the driver. A micro-batch is written into a folder
of its own number and overwrites it when it is retried, so a restart repeats nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fettle.functions.hashing import columns_of, hash_number, seeded_hash
from fettle.operators.runs import log_windows, step_completion_stats
from fettle.operators.shuffle import shuffle_rows

HASH_DIGITS = 8
HASH_RANGE = 16**HASH_DIGITS


def hash_split(key: str | Sequence[str], test_size: float, seed: int) -> Column:
    """``test`` for rows whose hash falls into the lowest part of its range, else ``train``.

    The share of test rows is near ``test_size`` but not exact; it is the most a row can know
    about itself. The same expression labels a batch.
    """
    if not 0.0 <= test_size <= 1.0:
        raise ValueError("test_size must lie between 0 and 1")
    number = hash_number(seeded_hash(seed, *columns_of(key)), 1, HASH_DIGITS)
    return F.when(number < int(test_size * HASH_RANGE), F.lit("test")).otherwise(F.lit("train"))


def stream_split(df: DataFrame, key: str | Sequence[str], test_size: float,
                 seed: int) -> DataFrame:
    """Add ``split`` to a stream (or a batch), row by row and without state."""
    return df.withColumn("split", hash_split(key, test_size, seed))


def write_batches(df: DataFrame, path: str, state_path: str, output_mode: str = "append",
                  change: Callable[[DataFrame], DataFrame] = lambda batch: batch,
                  trigger: dict | None = None) -> StreamingQuery:
    """Write each micro-batch, after ``change``, to ``path/batch_id=N``."""

    def save(batch: DataFrame, batch_id: int) -> None:
        change(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", state_path)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(save)
        .start()
    )


def stream_shuffle(df: DataFrame, key: str | Sequence[str], seed: int, path: str,
                   state_path: str, trigger: dict | None = None) -> StreamingQuery:
    """Shuffle a stream with the micro-batch as its buffer.

    ``shuffle_pos`` counts from 0 inside each batch. The batch size is set at the source
    (``max_files``).
    """
    return write_batches(
        df, path, state_path, change=lambda batch: shuffle_rows(batch, key, seed),
        trigger=trigger,
    )


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last written row of every key of a folder of updates."""
    updates = spark.read.parquet(path)
    values = [c for c in updates.columns if c not in (*keys, "batch_id")]
    last = F.max_by(F.struct(*values), "batch_id").alias("__last")
    return updates.groupBy(*keys).agg(last).select(*keys, "__last.*")


def stream_log_windows(df: DataFrame, metrics: Sequence[str], every: int, path: str,
                       state_path: str, step: str = "step",
                       run: str | Sequence[str] = (),
                       trigger: dict | None = None) -> StreamingQuery:
    """Log windows of a stream that has one row per step; read them with ``latest``.

    The state holds one row per run and window.
    """
    windows = log_windows(df, metrics, every, step, run)
    return write_batches(windows, path, state_path, "update", trigger=trigger)


def stream_step_stats(df: DataFrame, path: str, state_path: str,
                      step: str | Sequence[str] = "step", length: str = "n_tokens",
                      clipped: str = "clipped", trigger: dict | None = None) -> StreamingQuery:
    """Step statistics of a stream of completions; the state holds one row per step.

    A stream in update mode takes one aggregation, so the second level, the mean over a
    window's steps, is taken by ``read_completion_windows`` from the written steps.
    """
    stats = step_completion_stats(df, step, length, clipped)
    return write_batches(stats, path, state_path, "update", trigger=trigger)


def read_completion_windows(spark: SparkSession, path: str, every: int, step: str = "step",
                            run: str | Sequence[str] = ()) -> DataFrame:
    """Log windows from what ``stream_step_stats`` has written so far."""
    keys = [*columns_of(run), step]
    steps = latest(spark, path, keys)
    metrics = [c for c in steps.columns if c not in keys]
    return log_windows(steps, metrics, every, step, run)


def _at(number: str, first: int = 0) -> Column:
    """A number as event time, one second each. Time must come after the first watermark, which
    is second 0; ``first`` is added to the number for that."""
    return F.timestamp_seconds(F.col(number) + first)


def stream_completion_windows(df: DataFrame, every: int, late: int, path: str, state_path: str,
                              step: str = "step", run: str | Sequence[str] = (),
                              length: str = "n_tokens", clipped: str = "clipped",
                              trigger: dict | None = None) -> StreamingQuery:
    """Log windows of a stream of completions in one query: statistics per step, then their mean
    over ``every`` steps.

    Two aggregations follow one another in append mode. Steps count as event time: a row may come
    up to ``late`` steps behind the highest step seen in earlier batches, in any run; later ones
    are left out. A window is written once, when no row of it can come any more, and its state is
    dropped then; the last ``late`` steps of a stream stay open. State is bounded by the steps
    and windows still open.
    """
    runs = columns_of(run)
    timed = df.withColumn("__at", _at(step)).withWatermark("__at", f"{late} seconds")
    timed = timed.withColumn("__step", F.window("__at", "1 second"))
    stats = step_completion_stats(timed, [*runs, "__step"], length, clipped)
    metrics = [c for c in stats.columns if c not in (*runs, "__step")]
    # Steps count from 1: the window of steps 1 to ``every`` begins at second 1.
    wide = F.window(F.window_time("__step"), f"{every} seconds", startTime="1 seconds")
    windows = stats.groupBy(*runs, wide.alias("__window")).agg(
        F.count("*").alias("n_steps"), *[F.avg(m).alias(m) for m in metrics])
    end = F.unix_seconds(F.col("__window.end")) - 1
    return write_batches(windows.select(*runs, end.alias("step"), "n_steps", *metrics), path,
                         state_path, "append", trigger=trigger)


EARLIEST = 10**9  # numbers above minus this can be aligned
ALIGNED, NO_TARGET, NO_COMPLETION = "aligned", "without_target", "without_completion"


def stream_alignment(completions: DataFrame, targets: DataFrame, key: str, number: str, late: int,
                     path: str, state_path: str, trigger: dict | None = None) -> StreamingQuery:
    """Two streams meet by ``key``: rows (key, ``status``, completion and target columns).

    ``number`` is a sequence number that both sides have. A completion and its target may be up to
    ``late`` numbers apart, and each stream may deliver rows up to ``late`` numbers late. What has
    found nobody when its time is over comes out with the status of an error; the last rows of
    the streams wait. State holds the rows of both sides that can still meet.
    """
    span = f"{late} seconds"
    sides = []
    for df, mark in ((completions, "c"), (targets, "t")):
        named = df.withColumn("__at", _at(number, EARLIEST)).withWatermark("__at", span)
        sides.append(named.withColumnsRenamed({"__at": f"__{mark}_at", key: f"__{mark}_key"}).drop(number))
    wait = F.expr(f"INTERVAL {late} SECONDS")
    left, right = sides
    meet = (F.col("__c_key") == F.col("__t_key")) & (
        F.col("__t_at") >= F.col("__c_at") - wait) & (F.col("__t_at") <= F.col("__c_at") + wait)
    joined = left.join(right, meet, "full_outer")
    status = F.when(F.col("__t_key").isNull(), NO_TARGET).when(
        F.col("__c_key").isNull(), NO_COMPLETION).otherwise(ALIGNED)
    found = joined.select(
        F.coalesce("__c_key", "__t_key").alias(key), status.alias("status"),
        *[c for c in joined.columns if not c.startswith("__")])
    return write_batches(found, path, state_path, "append", trigger=trigger)


def read_alignment_report(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``alignment_report`` of what ``stream_alignment`` has written so far, but for repeats."""
    keys = spark.read.parquet(path).groupBy(key).agg(F.min("status").alias("status"))
    return keys.agg(*[F.count_if(F.col("status") == s).alias(name) for s, name in (
        (ALIGNED, "n_aligned"), (NO_TARGET, "n_without_target"),
        (NO_COMPLETION, "n_without_completion"))])
