"""Statistics of training steps and analysis of training logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fettle.functions.hashing import columns_of
from fettle.operators.ordered import join_null_safe, running_total, with_neighbour


def step_completion_stats(df: DataFrame, step: str | Sequence[str] = "step",
                          length: str = "n_tokens", clipped: str = "clipped") -> DataFrame:
    """Per step: completion lengths, the same over completions that ended by themselves, and
    the share that did not. Where none ended by itself its lengths count as 0."""
    ended = F.when(~F.col(clipped), F.col(length))

    def or_zero(column: Column) -> Column:
        return F.coalesce(column.cast("double"), F.lit(0.0))

    return df.groupBy(*columns_of(step)).agg(
        F.avg(F.col(clipped).cast("double")).alias("completions__clipped_ratio"),
        F.min(length).cast("double").alias("completions__min_length"),
        F.avg(length).alias("completions__mean_length"),
        F.max(length).cast("double").alias("completions__max_length"),
        or_zero(F.min(ended)).alias("completions__min_terminated_length"),
        or_zero(F.avg(ended)).alias("completions__mean_terminated_length"),
        or_zero(F.max(ended)).alias("completions__max_terminated_length"),
    )


def window_end(step: Column, every: int) -> Column:
    """The step at which the logging window of a step (from 1) ends."""
    return (F.floor((step - 1) / F.lit(every)) + 1) * every


def step_reward_stats(df: DataFrame, group: str | Sequence[str], rewards: Sequence[str] = (),
                      step: str | Sequence[str] = "step",
                      reward: str = "reward") -> DataFrame:
    """Per step: mean reward, mean deviation inside its groups, and mean and deviation of each
    named reward over all its completions.

    Both levels are combined on the map side; a group of one has no deviation and is passed
    over, as is a step without any.
    """
    steps = columns_of(step)
    moments = [
        column
        for name in rewards
        for column in (F.avg(name).alias(f"rewards__{name}__mean"),
                       F.stddev_samp(name).alias(f"rewards__{name}__std"))
    ]
    whole = df.groupBy(*steps).agg(F.avg(reward).alias("reward"), *moments)
    in_groups = (
        df.groupBy(*steps, *columns_of(group)).agg(F.stddev_samp(reward).alias("__std"))
        .groupBy(*steps).agg(F.avg("__std").alias("reward_std"))
    )
    return join_null_safe(whole, in_groups, steps)


def log_windows(df: DataFrame, metrics: Sequence[str], every: int = 5, step: str = "step",
                run: str | Sequence[str] = (), last: Sequence[str] = ()) -> DataFrame:
    """Log records: the mean of each per-step metric over every ``every`` steps, and the last
    value of counters such as the epoch or the tokens seen.

    ``df`` holds one row per step, so the record is a mean of step statistics, not of the
    completions below them.
    """
    return df.groupBy(*columns_of(run), window_end(F.col(step), every).alias("step")).agg(
        F.count("*").alias("n_steps"),
        *[F.avg(m).alias(m) for m in metrics],
        *[F.max_by(m, step).alias(m) for m in last],
    )


def cumulative_tokens(df: DataFrame, tokens: str = "n_tokens", step: str = "step",
                      run: str | Sequence[str] = "run") -> DataFrame:
    """(run, step, ``num_tokens``): tokens seen up to and including each step."""
    return running_total(df, F.col(tokens), step, run, inclusive=True, name="num_tokens")


def metric_deltas(df: DataFrame, metric: str, step: str = "step",
                  run: str = "run") -> DataFrame:
    """(run, step, metric, previous, delta): change since the run's previous logged step."""
    slim = df.select(run, step, metric)
    before = with_neighbour(slim, [metric], step, run)
    return before.select(
        run, step, metric,
        F.col(f"previous_{metric}").alias("previous"),
        (F.col(metric) - F.col(f"previous_{metric}")).alias("delta"),
    )


def run_summary(df: DataFrame, metrics: Sequence[str], step: str = "step",
                run: str = "run") -> DataFrame:
    """Per run and metric: logged values, the first, the last, and the change between them."""
    stacked = df.select(
        run, step,
        F.inline(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
            for m in metrics
        ])),
    ).where(F.col("value").isNotNull())
    ends = stacked.groupBy(run, "metric").agg(
        F.count("*").alias("n_logged"),
        F.min_by("value", step).alias("first_value"),
        F.max_by("value", step).alias("last_value"),
    )
    return ends.withColumn("change", F.col("last_value") - F.col("first_value"))


def compare_runs(logs: Sequence[DataFrame], metric: str, step: str = "step",
                 run: str = "run", runs: Sequence[str] | None = None) -> DataFrame:
    """One row per step, one column for each of the named ``runs`` with its metric.

    Without names the table is long, (step, run, metric), for any number of runs. The logs may
    have different columns.
    """
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)
    if runs is None:
        return merged.groupBy(step, run).agg(F.avg(metric).alias(metric))
    return merged.groupBy(step).pivot(run, list(runs)).agg(F.avg(metric))
