"""The shared folder where lineage is cut and streams keep their state."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is missing a temporary folder is made, but only in local mode: on a
    cluster a machine-local folder would be lost with its machine, so that is refused.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="fettle-checkpoint-")
        context.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other call returns."""
    path = f"{shared_dir(spark).rstrip('/')}/fettle-{purpose}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``new_folder`` named."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Own the folders made inside the block, and remove them at its end.

    Results are lazy, so write them inside the block::

        with scratch(spark):
            write_prepared(packed_answers(pairs, key, 0.1, 0, 1024), "s3a://prepared/answers")
    """
    folders: list[str] = []
    _scopes.append(folders)
    try:
        yield
    finally:
        _scopes.remove(folders)
        for path in folders:
            remove_folder(spark, path)


def write_table(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, and the folder's path."""
    path = new_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def for_now(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` as a table in the shared folder that goes with the block."""
    table, path = write_table(df)
    try:
        yield table
    finally:
        remove_folder(df.sparkSession, path)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table into the shared folder and go on from there.

    Used where evaluating twice could give two answers (sampled range boundaries) or would
    repeat expensive work (counting tokens, scoring whole texts). A table survives the loss of
    any executor, later passes read only the columns they need, and its size is known to the
    planner. ``scratch`` removes it once the results are written.
    """
    return write_table(df)[0]
