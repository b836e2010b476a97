"""Training logs and run settings saved as JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The settings read from an adapter's JSON.
RUN_CONFIG_SCHEMA = (
    "base_model_name_or_path string, r bigint, lora_alpha bigint, lora_dropout double, "
    "target_modules array<string>, bias string, task_type string"
)


def read_run_logs(spark: SparkSession, paths: str | Sequence[str],
                  schema: str | StructType | None = None) -> DataFrame:
    """One row per run and logged step.

    ``run`` is the path of the file. Records may have different keys; a missing one is null.
    ``/`` in a name becomes ``__``, so that names need no quoting. ``schemas.run_log_schema``
    gives a schema; without one the files are read an extra time to find their keys.
    """
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    # The path is a metadata column, which has to be picked before the list is unfolded.
    headers = reader.json(paths).select(F.col("_metadata.file_path").alias("run"), "log_history")
    records = headers.select("run", F.inline("log_history"))
    return records.select(
        *[F.col(f"`{name}`").alias(name.replace("/", "__")) for name in records.columns]
    )


def read_run_configs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row of settings per run; ``run`` is the path of the file."""
    return (
        spark.read.option("multiLine", True).schema(RUN_CONFIG_SCHEMA).json(paths)
        .select(F.col("_metadata.file_path").alias("run"), "*")
    )


def run_folder(path_column: str = "run", levels: int = 2) -> Column:
    """Folder ``levels`` above a file: what a log and its settings have in common."""
    parts = F.split(F.col(path_column), "/")
    return F.array_join(F.slice(parts, F.lit(1), F.size(parts) - levels), "/")


def with_run_configs(logs: DataFrame, configs: DataFrame) -> DataFrame:
    """Logs with the settings of their run: both lie one folder deep in the same run folder.

    A run folder may hold its settings several times, saved with a checkpoint and again at the
    end; that they differ is an error. Spark broadcasts them where they are small enough.
    """
    names = [name for name in configs.columns if name != "run"]
    here = F.struct(*names)
    differ = F.raise_error(F.concat(F.lit("different settings in "), F.col("folder")))
    settings = (
        configs.withColumn("folder", run_folder()).groupBy("folder")
        .agg(F.min(here).alias("least"), F.max(here).alias("most"))
        .select("folder", F.when(F.col("least").eqNullSafe(F.col("most")), F.col("least"))
                .otherwise(differ).alias("settings"))
    )
    joined = logs.withColumn("folder", run_folder()).join(settings, "folder", "left")
    return joined.select("*", "settings.*").drop("settings")


def read_log_records(spark: SparkSession, paths: str | Sequence[str],
                     history: str | None = "log_history") -> DataFrame:
    """(run, ``record``): one VARIANT per logged record, whatever keys it has.

    ``history`` names the list of records in a file that is one JSON object; None reads files of
    one record per line. Nothing is inferred, so the files are read once, and records of different
    runs need no keys in common.
    """
    reader = spark.read.option("singleVariantColumn", "record").option(
        "multiLine", history is not None)
    files = reader.json(paths).select(F.col("_metadata.file_path").alias("run"), "record")
    if history is None:
        return files
    listed = files.select("run", F.variant_get("record", f"$.{history}", "variant").alias("listed"))
    each = listed.lateralJoin(spark.tvf.variant_explode(F.col("listed").outer()))
    return each.select("run", F.col("value").alias("record"))


def log_values(records: DataFrame, step: str = "step", record: str = "record") -> DataFrame:
    """One row per record and key: the record's other columns, ``step``, ``key``, ``value``.

    Only numbers are values; keys that hold something else, or null, give no row. The step itself
    is no key of its own, and a record without one has a null step.
    """
    spark = records.sparkSession
    others = [c for c in records.columns if c != record]
    numbered = records.select(
        *others, F.try_variant_get(record, f"$.{step}", "bigint").alias("step"), record)
    each = numbered.lateralJoin(spark.tvf.variant_explode(F.col(record).outer()))
    kind = F.schema_of_variant("value")
    is_number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return each.where((F.col("key") != step) & is_number).select(
        *others, "step", "key", F.try_variant_get("value", "$", "double").alias("value"))
