import pytest
from pyspark.sql import functions as F

from fettle.operators.runs import log_windows, step_completion_stats
from fettle.shared import new_folder
from fettle.sources.corpus import stream_corpus
from fettle.streaming import streams
from tests.helpers import rows


@pytest.fixture
def steps(spark, tmp_path):
    """One folder of six files whose rows are in no order."""
    df = spark.range(600).select(
        F.pmod(F.hash("id"), F.lit(120)).cast("bigint").alias("step0"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("run"), "id",
        (F.col("id") % 29).cast("double").alias("loss"),
        (F.col("id") % 150).alias("n_tokens"),
    ).select("*", (F.col("step0") + 1).alias("step"), (F.col("n_tokens") >= 128).alias("clipped"))
    path = str(tmp_path / "steps.parquet")
    df.repartition(6).write.parquet(path)
    batch = spark.read.parquet(path)
    return batch, lambda: stream_corpus(spark, path, batch.schema, max_files=2)


def folders(spark):
    return new_folder(spark, "test"), new_folder(spark, "state")


def test_split(spark, steps):
    batch, stream = steps
    out, state = folders(spark)
    labelled = streams.stream_split(stream(), "id", 0.2, 1)
    streams.write_batches(labelled, out, state).awaitTermination()
    found = spark.read.parquet(out)
    assert found.select("batch_id").distinct().count() == 3
    assert rows(found, "id", "split") == rows(
        streams.stream_split(batch, "id", 0.2, 1), "id", "split"
    )


def test_shuffle_is_a_permutation_of_every_batch(spark, steps):
    batch, stream = steps
    out, state = folders(spark)
    streams.stream_shuffle(stream(), "id", 1, out, state).awaitTermination()
    found = spark.read.parquet(out)
    assert rows(found, "id") == rows(batch, "id")
    for b in range(3):
        positions = [r["shuffle_pos"] for r in found.where(F.col("batch_id") == b)
                     .orderBy("shuffle_pos").collect()]
        assert positions == list(range(len(positions)))


def test_windows_grow_with_the_stream(spark, steps):
    batch, stream = steps
    out, state = folders(spark)
    streams.stream_log_windows(
        stream(), ["loss"], 10, out, state, run="run"
    ).awaitTermination()
    found = streams.latest(spark, out, ["run", "step"])
    expected = log_windows(batch, ["loss"], 10, run="run")
    rounded = F.round("loss", 9)
    assert rows(found, "run", "step", "n_steps", rounded) == rows(
        expected, "run", "step", "n_steps", rounded
    )
    assert spark.read.parquet(out).count() > found.count()


def test_completion_windows_have_two_levels(spark, steps):
    batch, stream = steps
    out, state = folders(spark)
    streams.stream_step_stats(stream(), out, state, ["run", "step"]).awaitTermination()
    found = streams.read_completion_windows(spark, out, 5, run="run")
    stats = step_completion_stats(batch, ["run", "step"])
    metrics = [c for c in stats.columns if c not in ("run", "step")]
    expected = log_windows(stats, metrics, 5, run="run")
    columns = ["run", "step", "n_steps", *[F.round(m, 9) for m in metrics]]
    assert rows(found, *columns) == rows(expected, *columns)


def test_a_restart_adds_only_what_is_new(spark, steps, tmp_path):
    batch, stream = steps
    out, state = folders(spark)
    for _ in range(2):
        streams.write_batches(stream(), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 600
