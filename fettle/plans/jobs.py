"""The preparation jobs: packed answers, agent scoring rounds and their log records, summary batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fettle.functions.hashing import columns_of, seeded_hash
from fettle.functions.rewards import action_outcome, task_reward
from fettle.functions.text import with_qa_text, with_tldr_text
from fettle.functions.tokens import completion_length, is_clipped, token_count
from fettle.operators.groups import group_advantage
from fettle.operators.packing import chars_per_token, pack_sequences
from fettle.operators.runs import (
    cumulative_tokens, log_windows, step_completion_stats, step_reward_stats,
)
from fettle.operators.scoring import check_aligned
from fettle.operators.shuffle import plan_batches, repeat_rows, shuffle_blocks
from fettle.operators.split import fraction_split, head_rows, take_skip
from fettle.operators.tasks import expand_generations, tasks_for, with_prompts
from fettle.shared import cut


def packed_answers(pairs: DataFrame, key: str | Sequence[str], test_size: float = 0.005,
                   seed: int = 0, seq_length: int = 1024, sep: str = "<eos>",
                   epochs: int = 1, max_chunks: int | None = None) -> DataFrame:
    """(split, chunk_id, tokens) from (question, response_j): text, split, shuffle, pack.

    Each split is a stream of its own, in seeded order. With several epochs the training rows
    are repeated, each time in another order; the test rows are read once. ``max_chunks`` cuts
    the training stream after as many chunks as the steps of a run will read.
    """
    keys = columns_of(key)
    texts = cut(with_qa_text(pairs).select(*keys, "text"))
    split = repeat_rows(fraction_split(texts, keys, test_size, seed), epochs)
    split = split.where((F.col("split") == "train") | (F.col("epoch") == 0))
    placed = split.withColumn("place", F.when(
        F.col("epoch") == 0, seeded_hash(seed, *keys)
    ).otherwise(seeded_hash(seed, *keys, "epoch")))
    order = ["epoch", "place", *keys]
    chunks = pack_sequences(placed, "text", order, seq_length, sep, group_by="split")
    if max_chunks is None:
        return chunks
    return chunks.where((F.col("split") != "train") | (F.col("chunk_id") < max_chunks))


def train_chars_per_token(pairs: DataFrame, key: str | Sequence[str], test_size: float = 0.005,
                          seed: int = 0, n: int = 400) -> DataFrame:
    """Characters per token of the formatted texts, over the first ``n`` rows of the training
    split in its seeded order."""
    keys = columns_of(key)
    split = fraction_split(with_qa_text(pairs).select(*keys, "text"), keys, test_size, seed)
    train = split.where(F.col("split") == "train").withColumn("place", seeded_hash(seed, *keys))
    return chars_per_token(train, "text", ["place", *keys], n)


def packed_answers_by_head(pairs: DataFrame, key: str | Sequence[str], n_valid: int = 4000,
                           buffer: int = 5000, seed: int = 0, seq_length: int = 1024,
                           sep: str = "<eos>") -> DataFrame:
    """The same where data is taken in order: the first ``n_valid`` rows are ``valid``, the
    rest is ``train``, shuffled in blocks of ``buffer`` rows."""
    keys = columns_of(key)
    texts = cut(with_qa_text(pairs).select(*keys, "text"))
    split = take_skip(texts, n_valid, keys, ("valid", "train"))
    train = shuffle_blocks(split.where(F.col("split") == "train"), keys, seed, buffer)
    # Validation rows share one place, so that their key orders them.
    valid = split.where(F.col("split") == "valid").withColumn(
        "shuffle_pos", F.lit(0).cast("bigint")
    )
    placed = train.drop("block").unionByName(valid)
    return pack_sequences(
        placed, "text", ["shuffle_pos", *keys], seq_length, sep, group_by="split"
    )


def agent_round(samples: DataFrame, key: str | Sequence[str],
                complete: Callable[[DataFrame], DataFrame], difficulty: int | Column = 0,
                generations: int = 4, seed: int = 0) -> DataFrame:
    """One scoring round: a task per sample, ``generations`` completions, rewards, advantages.

    ``complete`` adds a ``completion`` to rows with ``prompt``; it is called for one row per
    completion and its answers are kept, so a model is asked once only. It may keep any columns,
    but must answer every prompt exactly once; anything else is an error.
    """
    keys = columns_of(key)
    tasks = with_prompts(tasks_for(samples, keys, difficulty, seed))
    asked = expand_generations(tasks, generations)
    scored = cut(complete(asked).select(
        *keys, "gen_id", "target_id", "completion",
        task_reward(F.col("completion"), F.col("target_id")).alias("reward"),
        action_outcome(F.col("completion"), F.col("target_id")).alias("outcome"),
    ))
    one_each = [*keys, "gen_id"]
    check_aligned(asked.select(*one_each), scored.select(*one_each), one_each)
    return group_advantage(scored, keys)


def round_records(scored: DataFrame, key: str | Sequence[str], rewards: Sequence[str] = ("reward",),
                  batch: int = 1, accum: int = 2, generations: int = 2, every: int = 5,
                  limit: int = 128, max_steps: int | None = None, reward: str = "reward",
                  prompt: str = "prompt", completion: str = "completion") -> DataFrame:
    """The log records of a scoring round: one row per ``every`` steps.

    ``scored`` has one row per (key, ``gen_id``) with its prompt, completion and rewards, as
    ``agent_round`` scores them. Samples are planned into steps (``plan_batches``, unfilled
    micro-batches left out); a record holds the means over its steps of completion lengths, of
    the combined reward and its deviation inside the prompts' groups, and of each named reward's
    mean and deviation, and the epoch and the number of tokens seen at its last step. A
    completion's length is capped at ``limit``; tokens seen are those of prompts and completions.
    """
    keys = columns_of(key)
    whole = token_count(F.coalesce(F.col(completion), F.lit("")))
    named = [name for name in dict.fromkeys([reward, *rewards])]
    measured = cut(scored.select(
        *keys, "gen_id", *named, whole.alias("__whole"),
        token_count(F.coalesce(F.col(prompt), F.lit(""))).alias("__prompt")))
    plan = plan_batches(measured.where("gen_id = 0").select(*keys), keys, batch, accum, generations,
                        drop_last=True, max_steps=max_steps)
    samples = cut(measured.select(
        *keys, "gen_id", *named, "__prompt",
        completion_length(F.col("__whole"), limit).alias("n_tokens"),
        is_clipped(F.col("__whole"), limit).alias("clipped"),
    ).join(plan.select(*keys, "gen_id", "step", "epoch_progress"), [*keys, "gen_id"]))
    moments = step_reward_stats(samples, keys, rewards, "step", reward)
    seen = samples.groupBy("step").agg(
        F.sum(F.col("__prompt") + F.col("n_tokens")).alias("n_tokens"),
        F.max("epoch_progress").alias("epoch"))
    per_step = (
        step_completion_stats(samples, "step").join(moments, "step")
        .join(seen.select("step", "epoch"), "step")
        .join(cumulative_tokens(seen, run=()), "step")
    )
    metrics = [c for c in per_step.columns if c not in ("step", "epoch", "num_tokens")]
    return log_windows(per_step, metrics, every, last=["epoch", "num_tokens"])


def summary_batches(pairs: DataFrame, key: str | Sequence[str], n: int = 100,
                    batch: int = 1, accum: int = 4, drop_last: bool = True,
                    max_steps: int | None = 20) -> DataFrame:
    """(prompt, completion) rows: the head, its training text, and the step of each row."""
    order = columns_of(key)
    texts = with_tldr_text(head_rows(pairs, n, order))
    return plan_batches(
        texts, order, batch, accum, drop_last=drop_last, max_steps=max_steps
    )
