"""A shuffle buffer that outlives the micro-batch.

Every row gets a delay by its hash, below the size of the buffer, and leaves after as many later
rows of its shard have arrived. So a buffer never holds more rows than its size, no row moves
further than that, and where a row comes out depends on the order of arrival and its key alone,
not on batches, retries or restarts. Shards are keys of the state: their buffers work side by
side, and more shards hold more rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fettle.functions.hashing import any_null, columns_of, hash_number, require_new, seeded_hash
from fettle.operators.ordered import running_total
from fettle.streaming.streams import write_batches

STATE = "arrived bigint, left bigint, held binary"


def _prepared(df: DataFrame, key: Sequence[str], seed: int, buffer: int, shards: int) -> DataFrame:
    """Rows with ``shard``, ``__hash`` and ``__delay``; a null in the key is an error."""
    if min(buffer, shards) < 1:
        raise ValueError("buffer and shards must be at least 1")
    require_new(df, "shard", "shuffle_pos")
    hashed = F.when(any_null(key), F.raise_error(F.lit(f"null in {list(key)}"))).otherwise(
        seeded_hash(seed, *key))
    return df.withColumn("__hash", hashed).withColumns({
        "shard": (hash_number(F.col("__hash"), 1) % shards).cast("int"),
        "__delay": hash_number(F.col("__hash"), 9) % buffer,
    })


def buffered_order(df: DataFrame, key: str | Sequence[str], seed: int, buffer: int = 5000,
                   shards: int = 1, order_by: str | Sequence[str] | None = None) -> DataFrame:
    """Add ``shard`` and ``shuffle_pos``: where a buffer fed in the order gives each row out.

    What ``stream_buffer`` and ``drained`` write for a stream that arrives in this order, as a
    batch. The n-th arrival of a shard, from 0, leaves at n + delay; rows that leave together come
    in the order of hash and key. Keys must be unique and not null.
    """
    keys, order = columns_of(key), columns_of(order_by or key)
    rows = _prepared(df, keys, seed, buffer, shards)
    places = running_total(rows, F.lit(1).cast("bigint"), order, "shard", name="__arrival")
    leaving = rows.join(places, ["shard", *order]).withColumn(
        "__leaves", F.col("__arrival") + F.col("__delay"))
    position = running_total(leaving, F.lit(1).cast("bigint"), ["__leaves", "__hash", *keys],
                             "shard", name="shuffle_pos")
    return leaving.join(position, ["shard", "__leaves", "__hash", *keys]).select(
        *df.columns, "shard", "shuffle_pos")


def stream_buffer(df: DataFrame, key: str | Sequence[str], seed: int, path: str, state_path: str,
                  buffer: int = 5000, shards: int = 1, order_by: str | Sequence[str] | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Shuffle a stream through seeded buffers; rows with ``shard`` and ``shuffle_pos`` go to
    ``path`` as they leave.

    Rows arrive batch by batch, in each in the order. State is one row per shard with at most
    ``buffer`` rows of the stream; what is in it at the end of a stream is read by ``drained``.
    """
    keys, order = columns_of(key), columns_of(order_by or key)
    rows = _prepared(df, keys, seed, buffer, shards)
    names = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    passed = rows.groupBy("shard").applyInPandasWithState(
        _through(names, df.columns, keys, order),
        f"{schema}, shard int, shuffle_pos bigint", STATE, "append", GroupStateTimeout.NoTimeout)
    return write_batches(passed, path, state_path, trigger=trigger)


def _through(names: list[str], columns: list[str], keys: list[str], order: list[str]):
    def step(shard: tuple[int], batches: Iterator[pd.DataFrame],
             state: GroupState) -> Iterator[pd.DataFrame]:
        arrived, left, held = state.get if state.exists else (0, 0, None)
        fresh = pd.concat(list(batches), ignore_index=True).sort_values(order, ignore_index=True)
        fresh["__leaves"] = fresh["__delay"] + range(arrived, arrived + len(fresh))
        arrived += len(fresh)
        if held is not None:
            old = pa.ipc.open_stream(held).read_pandas()
            fresh = pd.concat([old, fresh], ignore_index=True) if len(old) else fresh
        # Whatever arrives later leaves at ``arrived`` or after it.
        ready = fresh["__leaves"] < arrived
        out = fresh[ready].sort_values(["__leaves", "__hash", *keys])
        out["shuffle_pos"] = range(left, left + len(out))
        table = pa.Table.from_pandas(fresh[~ready], preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        state.update((arrived, left + len(out), sink.getvalue().to_pybytes()))
        yield out[[*columns, "shard", "shuffle_pos"]]

    return step


def drained(spark: SparkSession, state_path: str, like: DataFrame,
            key: str | Sequence[str]) -> DataFrame:
    """The rows still in the buffers of a stopped ``stream_buffer``, with ``shard`` and
    ``shuffle_pos`` after those written; ``like`` has the columns of its input.

    Read from the committed state of the last batch, which stays as it is: a query started again
    goes on with the same buffers.
    """
    keys = columns_of(key)
    state = spark.read.format("statestore").load(state_path).select(
        F.col("key.*"), F.col("value.groupState.*"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
    names = [*like.columns]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, held in zip(batch.column("left").to_pylist(), batch.column("held").to_pylist()):
                rows = pa.ipc.open_stream(held).read_pandas().sort_values(
                    ["__leaves", "__hash", *keys])
                rows["shuffle_pos"] = range(left, left + len(rows))
                rows["shard"] = rows["shard"].astype("int32")
                yield from pa.Table.from_pandas(
                    rows[[*names, "shard", "shuffle_pos"]], preserve_index=False).to_batches()

    return state.mapInArrow(unpack, f"{schema}, shard int, shuffle_pos bigint")
