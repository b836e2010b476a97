"""Streams whose batches go on where the last one ended.

A micro-batch is worked on as a whole, with all cores, and a small table is handed from batch to
batch: the unfilled chunk of every split, the running total of every run. It is written into a
folder of the batch's number after the results, so a batch that is repeated starts from what its
predecessor left and replaces its own results; a restart needs nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fettle.functions.hashing import any_null, columns_of
from fettle.functions.tokens import tokenize
from fettle.operators.ordered import join_null_safe, running_total
from fettle.operators.packing import all_chunks
from fettle.shared import cut, remove_folder

Step = Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame]]


def write_carried(df: DataFrame, path: str, state_path: str, step: Step,
                  trigger: dict | None = None) -> StreamingQuery:
    """Write ``step(batch, carried)`` of every micro-batch: its result to ``path/batch_id=N``, and
    what the next batch carries on to ``state_path/carried/N``.

    The first batch carries nothing on. The tables of the last two batches are kept; the older of
    them is what a repeated batch starts from.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = lambda number: f"{state_path}/carried/{number}"
        carried = spark.read.parquet(folder(batch_id - 1)) if batch_id else None
        result, left = step(batch, carried)
        result.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        left.write.mode("overwrite").parquet(folder(batch_id))
        if batch_id > 1:
            remove_folder(spark, folder(batch_id - 2))

    return (
        df.writeStream.option("checkpointLocation", f"{state_path}/progress")
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(save).start()
    )


def stream_pack(df: DataFrame, text: str, order_by: str | Sequence[str], path: str,
                state_path: str, seq_length: int = 1024, sep: str = "<eos>",
                group_by: str | Sequence[str] = (),
                tokenizer: Callable[[Column], Column] = tokenize,
                trigger: dict | None = None) -> StreamingQuery:
    """Pack a stream of texts into chunks (group, ``chunk_id``, ``tokens``) under ``path``.

    Texts are taken batch by batch, in each by the order, so the chunks are those that
    ``pack_sequences`` gives for the order (batch, order), however the stream is cut into batches.
    A chunk is written by the batch that fills it; what has not filled one yet, less than a chunk
    per group, is carried on. (group, order) must be unique inside a batch.
    """
    groups = columns_of(group_by)

    def step(batch: DataFrame, carried: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        chunks = cut(all_chunks(batch, text, order_by, seq_length, sep, groups, tokenizer, carried))
        full = chunks.where(F.size("tokens") == seq_length)
        ends = chunks.groupBy(*groups).agg(
            F.max(F.struct("chunk_id", "tokens")).alias("last")).select(*groups, "last.*")
        # A group that ends with a full chunk goes on with an empty one.
        is_full = F.size("tokens") == seq_length
        left = ends.select(
            *groups, (F.col("chunk_id") + is_full.cast("bigint")).alias("chunk_id"),
            F.when(is_full, F.array().cast("array<string>")).otherwise(F.col("tokens")).alias("tokens"))
        if carried is not None:  # groups that end where they did
            left = left.union(
                join_null_safe(carried, left.select(*groups), groups, "left_anti") if groups
                else carried.join(left.select(F.lit(1).alias("seen")), F.lit(True), "left_anti")
                .select(left.columns))
        return full, left

    return write_carried(df, path, state_path, step, trigger)


def stream_cumulative_tokens(df: DataFrame, path: str, state_path: str, tokens: str = "n_tokens",
                             step: str = "step", run: str | Sequence[str] = "run",
                             trigger: dict | None = None) -> StreamingQuery:
    """(run, step, ``num_tokens``, ``late``) of a stream of steps, under ``path``.

    ``num_tokens`` counts all tokens of the run that arrived before, in the order (batch, step),
    and the step's own: what ``cumulative_tokens`` gives where steps arrive in order. A step that
    comes in a later batch than a higher one of its run is ``late``; it counts from there on, and
    rows written before are not changed. State is one row per run.
    """
    runs = columns_of(run)

    def advance(batch: DataFrame, carried: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        checked = F.when(any_null([step]), F.raise_error(F.lit(f"null in {step}"))).otherwise(
            F.coalesce(F.col(tokens).cast("bigint"), F.lit(0)))
        totals = cut(running_total(batch, checked, step, runs, inclusive=True, name="num_tokens"))
        if carried is None:
            carried = batch.limit(0).select(
                *runs, F.col(step).alias("last_step"), F.lit(0).cast("bigint").alias("total"))
        found = join_null_safe(totals, carried, runs, "left").select(
            *runs, step, (F.col("num_tokens") + F.coalesce("total", F.lit(0))).alias("num_tokens"),
            (F.col(step) < F.coalesce("last_step", F.col(step))).alias("late"))
        ends = found.groupBy(*runs).agg(
            F.max(step).alias("last_step"), F.max("num_tokens").alias("total"))
        left = ends.union(carried.select(ends.columns)).groupBy(*runs).agg(
            F.max("last_step").alias("last_step"), F.max("total").alias("total"))
        return found, left

    return write_carried(df, path, state_path, advance, trigger)
