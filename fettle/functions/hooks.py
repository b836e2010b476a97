"""Adapters for user-supplied Python: mapping, rewards, tokenizers, completion sources.

All of them receive Arrow batches; a function sees one batch of one partition at a time, so
one that must see a whole group belongs in ``operators.groups`` instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SLICE = 1 << 20  # bytes of text tokenized at a time


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: str | StructType) -> DataFrame:
    """Apply a dict-to-dict function to every row. Prefer a column expression where one will do.

    Values are plain Python ones: a null is None and an integer stays one.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([fn(row) for row in batch.to_pylist()], arrow)

    return df.mapInArrow(run, wanted)


def reward_udf(fn: Callable[..., list], columns: Sequence[str] = ()) -> Callable[[Column], Column]:
    """Make a Column function of ``fn(completions, **columns) -> list of float``.

    The named columns are handed over as keyword lists, aligned with the completions, a null as
    None; an answer of another length is an error.
    """

    @F.arrow_udf("double")
    def score(*arrays: pa.Array) -> pa.Array:
        completions = arrays[0].to_pylist()
        extra = {name: values.to_pylist() for name, values in zip(columns, arrays[1:])}
        rewards = list(fn(completions, **extra))
        if len(rewards) != len(completions):
            raise ValueError(f"{len(rewards)} rewards for {len(completions)} completions")
        return pa.array(rewards, pa.float64())

    return lambda completion: score(completion, *[F.col(name) for name in columns])


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in runs of at most ``SLICE`` bytes, one text at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, at = sizes.cumsum(dtype="int64"), 0
    while at < len(texts):
        limit = (ends[at - 1] if at else 0) + SLICE
        stop = max(at + 1, int(ends.searchsorted(limit, side="right")))
        yield texts.slice(at, stop - at)
        at = stop


def tokenizer_udf(fn: Callable[[str], list[str]]) -> Callable[[Column], Column]:
    """Make a Column function of a Python tokenizer, usable wherever ``tokenize`` is.

    Tokens are Python objects for at most ``SLICE`` bytes of texts at a time, or one longer text.
    """

    @F.arrow_udf("array<string>")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in _slices(batch):
                yield pa.array(
                    [None if text is None else list(fn(text)) for text in part.to_pylist()],
                    pa.list_(pa.string()))

    return tokens


def generate_with(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                  schema: str | StructType) -> DataFrame:
    """Run a batch completion source (a model, a stub) over prompts."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield fn(frame)

    return df.mapInPandas(batches, schema)
