"""Synthetic agent tasks and the vocabulary they use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fettle.functions.hashing import columns_of, hash_number, require_new, seeded_hash
from fettle.functions.text import id_token, observation_prompt

# The protocol tokens, the pool of item ids and the largest task.
PROTOCOL_TOKENS = ["<|obs|>", "<|agent|>", "<THINK>", "<END_THINK>", "<|pad|>"]
POOL_SIZE = 300
MAX_ITEMS = 299


def item_count(difficulty: int | Column) -> Column:
    """Items shown at a difficulty; a negative one is an error."""
    if not isinstance(difficulty, Column):
        if difficulty < 0:
            raise ValueError("difficulty must not be negative")
        return F.lit(min(difficulty + 1, MAX_ITEMS))
    checked = F.when(
        difficulty < 0, F.raise_error(F.lit("difficulty must not be negative"))
    ).otherwise(difficulty)
    return F.least(checked + 1, F.lit(MAX_ITEMS))


def draw_items(sample: Sequence[str], difficulty: int | Column, seed: int) -> Column:
    """Distinct ids of the pool in ascending order, drawn uniformly for each sample.

    Robert Floyd's sampling: for j up to the pool size, draw from 1..j and take j itself where
    the draw was taken before. It needs one hash per item shown, not one per id of the pool.
    """
    pool = F.sequence(F.lit(POOL_SIZE) - item_count(difficulty) + 1, F.lit(POOL_SIZE))

    def draw(j: Column) -> Column:
        number = hash_number(seeded_hash(seed, *sample, j))
        return F.struct(j.cast("bigint").alias("j"), (number % j + 1).alias("drawn"))

    def take(taken: Column, j: Column) -> Column:
        repeated = F.array_contains(taken, j["drawn"])
        return F.array_append(taken, F.when(repeated, j["j"]).otherwise(j["drawn"]))

    start = F.array().cast("array<bigint>")
    return F.array_sort(F.aggregate(F.transform(pool, draw), start, take))


def tasks_for(samples: DataFrame, key: str | Sequence[str], difficulty: int | Column = 0,
              seed: int = 0) -> DataFrame:
    """Add ``item_ids`` and ``target_id``, the first of them, to every row of ``samples``."""
    drawn = samples.withColumn("item_ids", draw_items(columns_of(key), difficulty, seed))
    return drawn.withColumn("target_id", F.element_at("item_ids", 1))


def generate_tasks(spark: SparkSession, n: int, difficulty: int = 0,
                   seed: int = 0) -> DataFrame:
    """``n`` tasks: (``sample_id``, ``item_ids``, ``target_id``)."""
    return tasks_for(spark.range(n).toDF("sample_id"), "sample_id", difficulty, seed)


def with_prompts(tasks: DataFrame) -> DataFrame:
    """Add ``prompt`` and ``item_ids_str`` to tasks."""
    ids = F.col("item_ids")
    return tasks.withColumns({
        "prompt": observation_prompt(ids),
        "item_ids_str": F.array_join(F.transform(ids, lambda i: i.cast("string")), " "),
    })


def agent_dataset(spark: SparkSession, n: int = 32, difficulty: int = 0,
                  seed: int = 0) -> DataFrame:
    """``n`` tasks with their prompts."""
    return with_prompts(generate_tasks(spark, n, difficulty, seed))


def special_tokens(spark: SparkSession, n_ids: int = POOL_SIZE) -> DataFrame:
    """(token, kind, item_id): the protocol tokens and one token per item id."""
    protocol = spark.range(1).select(
        F.explode(F.array(*[F.lit(token) for token in PROTOCOL_TOKENS])).alias("token"),
        F.lit("protocol").alias("kind"), F.lit(None).cast("bigint").alias("item_id"),
    )
    ids = spark.range(1, n_ids + 1).select(
        id_token(F.col("id")).alias("token"), F.lit("item").alias("kind"),
        F.col("id").alias("item_id"),
    )
    return protocol.unionByName(ids)


def special_token_usage(df: DataFrame, text: str, n_ids: int = POOL_SIZE) -> DataFrame:
    """``special_tokens`` with ``n_uses``, the number of times each occurs in the texts."""
    vocabulary = special_tokens(df.sparkSession, n_ids)
    protocol = "|".join(token.replace("|", r"\|") for token in PROTOCOL_TOKENS)
    pattern = rf"{protocol}|<ID_[0-9]+>"
    found = df.select(
        F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("token")
    )
    uses = found.groupBy("token").agg(F.count("*").alias("n_uses"))
    return vocabulary.join(uses, "token", "left").fillna(0, ["n_uses"])


def expand_generations(df: DataFrame, g: int) -> DataFrame:
    """Each prompt ``g`` times, with ``gen_id`` from 0."""
    if g < 1:
        raise ValueError("g must be at least 1")
    require_new(df, "gen_id")
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(g - 1))).alias("gen_id"))
