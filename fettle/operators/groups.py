"""Statistics of groups of completions, brought back to the completions.

A group is a prompt's completions and usually small, but nothing here relies on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.functions.hashing import columns_of, require_new
from fettle.operators.ordered import join_null_safe

def group_reward_stats(df: DataFrame, group: str | Sequence[str],
                       reward: str = "reward") -> DataFrame:
    """Per group: ``n``, mean and sample standard deviation of the reward.

    Both are combined on the map side, so a large group is no burden.
    """
    return df.groupBy(*columns_of(group)).agg(
        F.count("*").alias("n"),
        F.avg(reward).alias("reward_mean"),
        F.stddev_samp(reward).alias("reward_std"),
    )


def group_advantage(df: DataFrame, group: str | Sequence[str], reward: str = "reward",
                    eps: float = 1e-4) -> DataFrame:
    """Add ``advantage``: distance of a reward from its group's mean, in deviations.

    ``(reward - mean) / (std + eps)`` with the sample deviation; alone in its group a
    completion has advantage 0.

    The statistics are combined on the map side and joined back, one row per group; a group of
    any size is a stretch of the join that adaptive execution splits. The data is read twice:
    where rewards were computed from texts, cut the lineage before.
    """
    groups = columns_of(group)
    require_new(df, "advantage", "n", "reward_mean", "reward_std")
    joined = join_null_safe(df, group_reward_stats(df, groups, reward), groups)
    scaled = (F.col(reward) - F.col("reward_mean")) / (F.col("reward_std") + F.lit(eps))
    return joined.select(
        *df.columns,
        F.when(F.col(reward).isNotNull(), F.coalesce(scaled, F.lit(0.0))).alias("advantage"),
    )


def preference_pairs(df: DataFrame, group: str | Sequence[str], question: str, text: str,
                     reward: str = "reward", gen_id: str = "gen_id") -> DataFrame:
    """(group, ``question``, ``response_j``, ``response_k``): best and worst of each group.

    Equal rewards go to the smaller ``gen_id``; a group whose rewards are all equal gives no
    pair, a completion without a reward is passed over. (group, ``gen_id``) must be unique; a
    repeat of a completion that is shown is an error.

    The winners are found among rewards alone; their texts are then fetched by key, so a text
    is shuffled once, and again only if it won.
    """
    groups = columns_of(group)
    has_reward = F.col(reward).isNotNull()
    best = F.when(has_reward, F.struct(F.col(reward), -F.col(gen_id)))
    worst = F.when(has_reward, F.struct(F.col(reward), F.col(gen_id)))
    winners = (
        df.groupBy(*groups)
        .agg(
            F.min(gen_id).alias("question"),
            F.max_by(gen_id, best).alias("response_j"),
            F.min_by(gen_id, worst).alias("response_k"),
            (F.max(reward) > F.min(reward)).alias("__differ"),
        )
        .where("__differ")
    )
    places = ("question", "response_j", "response_k")
    wanted = winners.select(*groups, F.inline(F.array(*[
        F.struct(F.lit(place).alias("__place"), F.col(place).alias(gen_id)) for place in places
    ])))
    fetched = join_null_safe(
        df.select(*groups, gen_id, F.col(question).alias("__question"),
                  F.col(text).alias("__text")),
        wanted, [*groups, gen_id],
    )
    shown = F.when(F.col("__place") == "question", F.col("__question")).otherwise(
        F.col("__text")
    )
    found = fetched.groupBy(*groups).agg(
        *[F.max(F.when(F.col("__place") == place, shown)).alias(place) for place in places],
        (F.count(F.lit(1)) > len(places)).alias("__repeated"),
    )
    repeated = F.raise_error(F.lit(f"({', '.join(groups)}, {gen_id}) is not unique"))
    return found.select(*groups, F.when(F.col("__repeated"), repeated).otherwise(
        F.col("question")).alias("question"), "response_j", "response_k")
