"""Completions meet their tasks: alignment, named rewards, outcomes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fettle.functions.hashing import columns_of
from fettle.functions.rewards import CORRECT


def _key_counts(completions: DataFrame, targets: DataFrame,
                keys: Sequence[str]) -> DataFrame:
    """Rows per key on each side; both are combined before they are shuffled."""
    left = completions.groupBy(*keys).agg(F.count("*").alias("n_completions"))
    right = targets.groupBy(*keys).agg(F.count("*").alias("n_targets"))
    return left.join(right, list(keys), "full_outer")


def alignment_report(completions: DataFrame, targets: DataFrame,
                     key: str | Sequence[str]) -> DataFrame:
    """One row: keys on both sides, on one side only, and keys repeated among the targets."""
    left, right = F.col("n_completions"), F.col("n_targets")
    return _key_counts(completions, targets, columns_of(key)).agg(
        F.count_if(left.isNotNull() & right.isNotNull()).alias("n_aligned"),
        F.count_if(right.isNull()).alias("n_without_target"),
        F.count_if(left.isNull()).alias("n_without_completion"),
        F.count_if(right > 1).alias("n_repeated_targets"),
    )


def check_aligned(completions: DataFrame, targets: DataFrame, key: str | Sequence[str]) -> None:
    """Raise unless every key is on both sides, and only once among the targets."""
    found = alignment_report(completions, targets, key).first()
    problems = {
        name: found[name]
        for name in ("n_without_target", "n_without_completion", "n_repeated_targets")
        if found[name]
    }
    if problems:
        raise ValueError(
            f"completions and targets do not align on {columns_of(key)}: {problems}")


def align(completions: DataFrame, targets: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Completions with the columns of their targets.

    A completion without a target, a target without a completion, or a key repeated among the
    targets is an error. A target may have any number of completions: they are a stretch of the
    join that adaptive execution splits.
    """
    check_aligned(completions, targets, key)
    return completions.join(targets, columns_of(key))


def apply_rewards(df: DataFrame, rewards: Mapping[str, Column | Callable[[], Column]],
                  weights: Mapping[str, float] | None = None) -> DataFrame:
    """Add one column per named reward and their combination ``reward``.

    Our definition: ``reward`` is the weighted sum, weight 1 unless given.
    """
    if not rewards:
        raise ValueError("no rewards given")
    unknown = set(weights or {}) - set(rewards)
    if unknown:
        raise ValueError(f"weights for unknown rewards: {sorted(unknown)}")
    built = {name: r() if callable(r) else r for name, r in rewards.items()}
    scored = df.withColumns({name: c.cast("double") for name, c in built.items()})
    weighted = [F.col(name) * F.lit((weights or {}).get(name, 1.0)) for name in built]
    return scored.withColumn("reward", reduce(lambda a, b: a + b, weighted))


def outcome_summary(df: DataFrame, by: str | Sequence[str],
                    outcome: str = "outcome") -> DataFrame:
    """Per group and outcome: number of completions and their share of the group."""
    keys = columns_of(by)
    # A window over the counts, of which a group has one per outcome.
    total = F.sum("n").over(Window.partitionBy(*keys))
    counts = df.groupBy(*keys, outcome).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / total)


def accuracy(df: DataFrame, by: str | Sequence[str], outcome: str = "outcome") -> DataFrame:
    """Per group: share of correct completions."""
    correct = (F.col(outcome) == CORRECT).cast("double")
    return df.groupBy(*columns_of(by)).agg(F.avg(correct).alias("accuracy"))
