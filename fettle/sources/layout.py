"""Prepared rows as bucketed, sorted tables.

A bucket holds whole keys in order, so tables with the same buckets meet by key without moving a
row, a split is a folder that can be left out, and a key is looked for in one bucket only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fettle.functions.hashing import columns_of
from fettle.shared import new_folder


def write_layout(df: DataFrame, name: str, key: str | Sequence[str], buckets: int,
                 sort_by: str | Sequence[str] = (), partition_by: str | Sequence[str] = (),
                 path: str | None = None) -> str:
    """Write ``df`` as the table ``name``: folders by ``partition_by``, in each ``buckets`` files
    by ``key``, sorted by key and ``sort_by``. Returns the name.

    Rows are shuffled once, by the hash that names buckets, so every task writes whole buckets.
    """
    keys, parts = columns_of(key), columns_of(partition_by)
    order = [*keys, *[c for c in columns_of(sort_by) if c not in keys]]
    placed = df.repartition(buckets, *keys).sortWithinPartitions(*parts, *order)
    writer = placed.write.format("parquet").bucketBy(buckets, *keys).sortBy(*order)
    if parts:
        writer = writer.partitionBy(*parts)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def bucket_of(key: str | Sequence[str], buckets: int) -> Column:
    """The bucket of a row."""
    return F.pmod(F.hash(*columns_of(key)), F.lit(buckets))


def layout_report(spark: SparkSession, name: str, key: str | Sequence[str], buckets: int) -> DataFrame:
    """One row: files, rows, rows in a bucket not theirs, and files beyond one per folder and
    bucket. The last two are 0 for a table that ``write_layout`` has written."""
    file = F.col("_metadata.file_path")
    said = F.regexp_extract(file, r"_(\d+)\.c\d+", 1).try_cast("int")
    rows = spark.table(name).select(
        file.alias("file"), said.alias("said"), bucket_of(key, buckets).alias("bucket"))
    files = rows.groupBy("file", "said").agg(
        F.count("*").alias("n"), F.count_if(~F.col("said").eqNullSafe(F.col("bucket"))).alias("off"))
    folder = F.regexp_replace("file", "/[^/]*$", "")
    spread = files.groupBy(folder.alias("folder"), "said").agg(
        F.count("*").alias("files"), F.sum("n").alias("n"), F.sum("off").alias("off"))
    none = F.lit(0).cast("bigint")
    return spread.agg(
        F.coalesce(F.sum("files"), none).alias("n_files"), F.coalesce(F.sum("n"), none).alias("n_rows"),
        F.coalesce(F.sum("off"), none).alias("n_misplaced"),
        F.coalesce(F.sum(F.col("files") - 1), none).alias("n_extra_files"))


def new_table(spark: SparkSession) -> tuple[str, str]:
    """A table name and a path in the shared folder that no other call returns."""
    return f"fettle_{uuid.uuid4().hex}", new_folder(spark, "layout")
