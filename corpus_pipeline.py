"""The corpus pipeline: toxicity, near-duplicates, decontamination, mixing, sharding.

Each stage takes the documents its predecessor kept and returns a DataFrame; all but the last
return the columns of ``documents``. Documents whose toxicity score reaches the threshold go; of
each near-duplicate class one row stays; documents that hold a benchmark item go; sources
are mixed to their targets, so a document may be gone or there up to three times; every row gets
its shard.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fettle.llm.decontaminate import decontaminate
from fettle.llm.mixing import mixed_documents
from fettle.llm.neardup import without_near_copies
from fettle.llm.queries import LENGTH_TILT, SHARDS, TOXIC_FROM
from fettle.llm.sharding import assign_shards
from fettle.llm.toxicity import fit_toxicity, keep_below
from fettle.shared import cut

ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model learnt from ``labels``.

    Documents in which the model finds nothing stay, so all do where it has nothing to learn from.
    """
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_below(docs, model, TOXIC_FROM)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies, whatever ids its texts have.

    Documents with a null id belong to no class and stay.
    """
    return without_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed_documents(docs, length_tilt=LENGTH_TILT)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix with their slot and shard."""
    return assign_shards(docs, "doc_id", SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as a table and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir).select(
        "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), "lang", "source",
        "n_chars", "slot", "shard")
