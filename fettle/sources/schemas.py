"""Schemas of the datasets the operators work on, as DDL strings for ``schema=``.

Text formats read with a declared schema are read once; without one they are read twice.
"""

from __future__ import annotations

from collections.abc import Mapping

# Column names of the corpora and keys of the logged records.
SUMMARIES = "prompt string, completion string"
PAIRED_ANSWERS = "question string, response_j string, response_k string"
MESSAGES = "conv_id bigint, turn bigint, role string, text string"
AGENT_TASKS = (
    "sample_id bigint, item_ids array<bigint>, target_id bigint, prompt string, "
    "item_ids_str string"
)
COMPLETIONS = (
    "sample_id bigint, gen_id int, completion string, n_tokens bigint, clipped boolean"
)
SUPERVISED_LOG = {
    "epoch": "double", "grad_norm": "double", "learning_rate": "double", "loss": "double",
    "mean_token_accuracy": "double", "num_tokens": "double", "step": "bigint",
}
GROUP_REWARD_LOG = {
    "clip_ratio/high_max": "double", "clip_ratio/high_mean": "double",
    "clip_ratio/low_mean": "double", "clip_ratio/low_min": "double",
    "clip_ratio/region_mean": "double", "completions/clipped_ratio": "double",
    "completions/max_length": "double", "completions/max_terminated_length": "double",
    "completions/mean_length": "double", "completions/mean_terminated_length": "double",
    "completions/min_length": "double", "completions/min_terminated_length": "double",
    "epoch": "double", "grad_norm": "double", "kl": "double", "learning_rate": "double",
    "loss": "double", "num_tokens": "double", "reward": "double", "reward_std": "double",
    "step": "bigint",
}


def reward_log_fields(*rewards: str) -> dict[str, str]:
    """Logged keys of the named reward functions."""
    return {f"rewards/{name}/{part}": "double" for name in rewards for part in ("mean", "std")}


def run_log_schema(*records: Mapping[str, str]) -> str:
    """Schema of run log files whose records have the keys of all the given mappings."""
    fields: dict[str, str] = {}
    for record in records:
        fields.update(record)
    inner = ", ".join(f"`{name}`: {kind}" for name, kind in fields.items())
    return f"log_history array<struct<{inner}>>"
