"""Listing of saved files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def artifact_inventory(spark: SparkSession, path: str) -> DataFrame:
    """(``file``, ``n_bytes``) of the files directly in a folder; their content is not read.

    Folders in it are not entered, also where their names look like partitions. As in every
    Spark source, names starting with ``_`` or ``.`` are left out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    parts = F.split(F.regexp_replace("path", "^[a-z0-9]+:/*", "/"), "/")
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri()
    depth = len([part for part in root.getPath().split("/") if part])
    depth += 1 if root.getAuthority() else 0
    return files.where(F.size(F.array_remove(parts, "")) == depth + 1).select(
        F.element_at(parts, -1).alias("file"), F.col("length").alias("n_bytes")
    )


def artifact_total(inventory: DataFrame) -> DataFrame:
    """One row: number of files, total bytes and megabytes."""
    total = F.coalesce(F.sum("n_bytes"), F.lit(0))
    return inventory.agg(
        F.count("*").alias("n_files"),
        total.alias("n_bytes"),
        (total / F.lit(1024.0) / F.lit(1024.0)).alias("megabytes"),
    )
