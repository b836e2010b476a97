"""Corpora in and prepared data out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FORMATS = ("parquet", "json", "csv", "orc")


def corpus_path(path: str, subset: str | None = None, split: str | None = None) -> str:
    """Folder of a subset and split: both are parts of the path, so nothing else is listed."""
    return "/".join(part.strip("/") if i else part.rstrip("/")
                    for i, part in enumerate(p for p in (path, subset, split) if p))


def read_corpus(spark: SparkSession, path: str, subset: str | None = None,
                split: str | None = None, schema: str | StructType | None = None,
                fmt: str = "parquet", **options) -> DataFrame:
    """Load a corpus, or one subset and split of it.

    Text formats should be given a schema; inferring one reads the data an extra time.
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(corpus_path(path, subset, split))


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores: a shuffle of everything, for the caller to ask for.

    It is worth its price where the input is one file that cannot be split.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def stream_corpus(spark: SparkSession, path: str, schema: str | StructType,
                  max_files: int | None = None, fmt: str = "parquet",
                  **options) -> DataFrame:
    """The same corpus as a stream, ``max_files`` files per micro-batch.

    ``path`` may be a folder or a single file; a file is only accepted by the stream reader as
    a pattern, so it is named by one.
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    plain = path.rstrip("/")
    is_pattern = any(c in plain for c in "*?[{")
    return reader.load(plain if is_pattern else f"{plain[:-1]}[{plain[-1]}]")


def write_prepared(df: DataFrame, path: str, partition_by: str | None = "split",
                   mode: str = "errorifexists") -> None:
    """Write prepared rows as Parquet, one folder per split."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
