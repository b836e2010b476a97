import json
import math

import pytest
from pyspark.sql import functions as F

from fettle.operators import runs
from fettle.sources import schemas
from fettle.sources.runs import read_run_configs, read_run_logs, with_run_configs
from tests.helpers import rows

# Two logged runs, and below the names of the files and folders they are kept in.
SFT = [
    (5, 0.2, 2.627, 0.44191823825240134, 7884.0),
    (10, 0.4, 2.4156, 0.4614388182759285, 14875.0),
    (15, 0.6, 2.4989, 0.4874414071440697, 22623.0),
    (20, 0.8, 2.4343, 0.49148457646369936, 29769.0),
]
GRPO = [
    (5, 0.1, 0.37199999690055846, 0.0395979798398912, 3710.0),
    (10, 0.2, 0.3649999976158142, 0.029698482155799864, 7478.0),
    (15, 0.3, 0.3979999959468842, 0.025455845706164836, 11120.0),
    (20, 0.4, 0.38799999952316283, 0.05656854100525379, 14826.0),
]


@pytest.fixture
def run_files(tmp_path):
    def save(run, folder, name, content):
        path = tmp_path / run / folder
        path.mkdir(parents=True, exist_ok=True)
        (path / name).write_text(json.dumps(content, indent=2))

    save("sft", "checkpoint-20", "trainer_state.json", {
        "best_metric": None, "global_step": 20, "is_hyper_param_search": False,
        "log_history": [
            {"epoch": e, "loss": x, "mean_token_accuracy": a, "num_tokens": t, "step": s}
            for s, e, x, a, t in SFT
        ],
    })
    save("grpo", "checkpoint-20", "trainer_state.json", {
        "best_metric": None, "global_step": 20, "log_history": [
            {"epoch": e, "reward": r, "reward_std": d, "num_tokens": t, "step": s,
             "rewards/reward_num_unique_chars/mean": r}
            for s, e, r, d, t in GRPO
        ],
    })
    for run, rank in (("sft", 8), ("grpo", 16)):
        for folder in ("checkpoint-20", "lora_adapter"):  # saved with the checkpoint and at the end
            save(run, folder, "adapter_config.json", {
                "r": rank, "lora_alpha": 2 * rank, "lora_dropout": 0.1, "bias": "none",
                "target_modules": ["q_proj", "v_proj"], "task_type": "CAUSAL_LM",
                "revision": None,
            })
    return tmp_path


def logs(spark, run_files):
    found = read_run_logs(spark, str(run_files / "*" / "*" / "trainer_state.json"))
    return found.withColumn("run", F.regexp_extract("run", "/([a-z]+)/checkpoint", 1))


def test_ragged_logs_are_read_as_one_table(spark, run_files):
    found = logs(spark, run_files)
    assert found.count() == 8
    assert "rewards__reward_num_unique_chars__mean" in found.columns
    grpo = found.where("run = 'grpo'").orderBy("step").collect()
    assert [r["reward"] for r in grpo] == [g[2] for g in GRPO]
    assert all(r["loss"] is None for r in grpo)


def test_declared_schema(spark, run_files):
    schema = schemas.run_log_schema(
        schemas.SUPERVISED_LOG, schemas.GROUP_REWARD_LOG,
        schemas.reward_log_fields("reward_num_unique_chars"),
    )
    found = read_run_logs(spark, str(run_files / "*" / "*" / "trainer_state.json"), schema)
    inferred = logs(spark, run_files)
    assert len(found.columns) == 1 + 24  # run, and 23 keys of one kind with one of the other
    shared = [c for c in inferred.columns if c != "run"]
    assert rows(found, *shared) == rows(inferred, *shared)


def test_summary(spark, run_files):
    found = runs.run_summary(logs(spark, run_files), ["loss", "reward", "mean_token_accuracy"])
    by_key = {(r["run"], r["metric"]): r for r in found.collect()}
    assert set(by_key) == {("sft", "loss"), ("sft", "mean_token_accuracy"), ("grpo", "reward")}
    loss = by_key["sft", "loss"]
    assert (loss["n_logged"], loss["first_value"], loss["last_value"]) == (4, 2.627, 2.4343)
    assert loss["change"] == pytest.approx(-0.1927)


def test_changes_between_steps(spark, run_files):
    deltas = runs.metric_deltas(logs(spark, run_files), "num_tokens")
    sft = deltas.where("run = 'sft'").orderBy("step").collect()
    assert [r["delta"] for r in sft] == [None, 6991.0, 7748.0, 7146.0]
    assert deltas.where("delta is null").count() == 2


def test_running_tokens(spark, run_files):
    sizes = [7884, 6991, 7748, 7146]
    steps = spark.createDataFrame(
        [("sft", 5 * i + 5, n) for i, n in enumerate(sizes)], "run string, step int, n_tokens int"
    )
    found = runs.cumulative_tokens(steps).orderBy("step").collect()
    assert [r["num_tokens"] for r in found] == [s[4] for s in SFT]


def test_runs_side_by_side(spark, run_files):
    both = logs(spark, run_files)
    sft = both.where("run = 'sft'").drop("reward", "reward_std")
    grpo = both.where("run = 'grpo'").drop("loss")
    found = runs.compare_runs([sft, grpo], "num_tokens", runs=["sft", "grpo"])
    found = found.orderBy("step").collect()
    assert [(r["sft"], r["grpo"]) for r in found] == [(s[4], g[4]) for s, g in zip(SFT, GRPO)]
    assert runs.compare_runs([sft, grpo], "loss", runs=["sft"]).columns == ["step", "sft"]
    long = runs.compare_runs([sft, grpo], "num_tokens")
    assert rows(long, "run", "step", "num_tokens") == sorted(
        [("sft", s[0], s[4]) for s in SFT] + [("grpo", g[0], g[4]) for g in GRPO], key=repr)


def test_settings_join_their_run(spark, run_files):
    configs = read_run_configs(spark, str(run_files / "*" / "*" / "adapter_config.json"))
    found = read_run_logs(spark, str(run_files / "*" / "*" / "trainer_state.json"))
    assert with_run_configs(found, configs).count() == found.count()
    other = configs.withColumn("r", F.col("r") + F.monotonically_increasing_id())
    with pytest.raises(Exception, match="different settings"):
        with_run_configs(found, other).collect()
    ranks = with_run_configs(found, configs).select(
        F.regexp_extract("run", "/([a-z]+)/checkpoint", 1), "r", "target_modules"
    ).distinct()
    assert rows(ranks) == [("grpo", 16, ["q_proj", "v_proj"]), ("sft", 8, ["q_proj", "v_proj"])]


def test_a_log_record_is_a_mean_of_steps(spark):
    """Ten completions in five steps, all cut at 128 tokens but one that ended at 110."""
    data = [(11 + i // 2, 110 if i == 3 else 128, i != 3) for i in range(10)]
    df = spark.createDataFrame(data, "step int, n_tokens int, clipped boolean")
    stats = runs.step_completion_stats(df)
    window = runs.log_windows(stats, [c for c in stats.columns if c != "step"]).first()
    expected = {
        "step": 15, "n_steps": 5, "clipped_ratio": 0.9, "mean_length": 126.2,
        "min_length": 124.4, "max_length": 128.0, "max_terminated_length": 22.0,
        "mean_terminated_length": 22.0, "min_terminated_length": 22.0,
    }
    for name, value in expected.items():
        name = name if name in ("step", "n_steps") else f"completions__{name}"
        assert window[name] == pytest.approx(value), name


def test_logged_deviations_are_sample_deviations(spark):
    """Pairs of rewards whose difference is in whole hundredths give the logged mean."""
    # Five steps of one prompt with two completions each.
    difference = GRPO[0][3] * 5 * math.sqrt(2)  # summed over five steps
    assert difference == pytest.approx(0.28, abs=1e-6)
    data = [(s, 0.372 - d / 2) for s, d in enumerate([0.28, 0, 0, 0, 0])]
    data += [(s, 0.372 + d / 2) for s, d in enumerate([0.28, 0, 0, 0, 0])]
    df = spark.createDataFrame(data, "step int, reward double")
    df = df.select((F.col("step") + 1).alias("step"), F.lit(0).alias("prompt"), "reward",
                   F.col("reward").alias("unique"), (F.col("step") * 0.02 + 0.02).alias("epoch"))
    stats = runs.step_reward_stats(df, "prompt", ["unique"])
    stats = stats.join(df.select("step", "epoch").distinct(), "step")
    metrics = ["reward", "reward_std", "rewards__unique__mean", "rewards__unique__std"]
    window = runs.log_windows(stats, metrics, last=["epoch"]).first()
    assert window["reward_std"] == pytest.approx(GRPO[0][3], abs=1e-6)
    assert window["rewards__unique__std"] == pytest.approx(GRPO[0][3], abs=1e-6)
    assert window["reward"] == window["rewards__unique__mean"] == pytest.approx(0.372)
    assert (window["step"], window["epoch"]) == (5, pytest.approx(0.1))
