"""Streams that go on where they stopped, against their batch twins."""

import pytest
from pyspark.sql import functions as F

from fettle.operators.packing import pack_sequences
from fettle.operators.runs import cumulative_tokens, log_windows, step_completion_stats
from fettle.operators.scoring import alignment_report
from fettle.plans.catalog import feed
from fettle.shared import new_folder
from fettle.sources.corpus import stream_corpus
from fettle.streaming import buffers, carried, streams
from tests.helpers import rows


def folders(spark):
    return new_folder(spark, "test"), new_folder(spark, "state")


def texts(spark, n=120):
    return spark.range(n).select(
        "id", F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "cold").alias("split"),
        F.when(F.col("id") % 11 > 0, F.expr("array_join(transform(sequence(1, cast(1 + id % 13 as int)), "
                                            "i -> concat('w', id, 'x', i)), ' ')")).alias("text"))


class Broken(Exception):
    pass


def broken_once(monkeypatch, module, name, fail_at):
    """The function raises when it is called for the ``fail_at``-th time, and only then."""
    real, calls = getattr(module, name), []

    def sometimes(*args, **kwargs):
        calls.append(1)
        if len(calls) == fail_at:
            raise Broken("a lost driver")
        return real(*args, **kwargs)

    monkeypatch.setattr(module, name, sometimes)


@pytest.mark.parametrize("parts", [1, 4])
@pytest.mark.parametrize("group", [(), "split"])
def test_packing_does_not_depend_on_batches(spark, parts, group):
    df = texts(spark)
    out, state = folders(spark)
    feed(df, "id", lambda s: carried.stream_pack(s, "text", "id", out, state, 16, group_by=group), parts)
    keys = ["split"] if group else []
    want = pack_sequences(df, "text", "id", 16, group_by=group)
    assert rows(spark.read.parquet(out), *keys, "chunk_id", "tokens") == rows(
        want, *keys, "chunk_id", "tokens")


def test_a_batch_repeated_after_a_fault_counts_once(spark, monkeypatch):
    """The driver is lost between a batch's chunks and its carried table; the batch runs again."""
    df = texts(spark)
    out, state = folders(spark)
    source = new_folder(spark, "source")
    start = lambda: carried.stream_pack(
        stream_corpus(spark, source, df.schema), "text", "id", out, state, 16)
    for part in range(3):
        df.where(F.expr("id div 40") == part).write.mode("append").parquet(source)
        if part == 1:
            with monkeypatch.context() as patch:
                broken_once(patch, carried, "cut", 1)
                with pytest.raises(Exception, match="a lost driver"):
                    start().awaitTermination()
        start().awaitTermination()
    found = spark.read.parquet(out)
    assert found.select("batch_id").distinct().count() == 3
    assert rows(found, "chunk_id", "tokens") == rows(
        pack_sequences(df, "text", "id", 16), "chunk_id", "tokens")


def test_packing_an_empty_stream(spark):
    df = texts(spark).limit(0)
    out, state = folders(spark)
    feed(df, "id", lambda s: carried.stream_pack(s, "text", "id", out, state, 16), 1)


def test_cumulative_tokens(spark):
    df = spark.range(300).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "cold").alias("run"),
        F.col("id").alias("step"), F.when(F.col("id") % 7 > 0, F.col("id") % 50).alias("n_tokens"))
    out, state = folders(spark)
    feed(df, "step", lambda s: carried.stream_cumulative_tokens(s, out, state), 4)
    found = spark.read.parquet(out)
    want = cumulative_tokens(df.fillna(0, ["n_tokens"]))
    assert rows(found, "run", "step", "num_tokens") == rows(want, "run", "step", "num_tokens")
    assert found.where("late").count() == 0


def test_late_steps_count_from_their_arrival(spark):
    schema = "run string, step bigint, n_tokens bigint"
    out, state = folders(spark)
    source = new_folder(spark, "source")
    for batch in ([("a", 1, 5), ("a", 3, 7)], [("a", 2, 10), ("a", 4, 1), ("b", 9, 2)], [("b", 1, 4)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        carried.stream_cumulative_tokens(
            stream_corpus(spark, source, schema), out, state).awaitTermination()
    assert rows(spark.read.parquet(out), "run", "step", "num_tokens", "late") == [
        ("a", 1, 5, False), ("a", 2, 22, True), ("a", 3, 12, False), ("a", 4, 23, False),
        ("b", 1, 6, True), ("b", 9, 2, False)]


@pytest.mark.parametrize("parts, shards, buffer", [(1, 1, 10), (4, 3, 25), (3, 2, 1), (3, 2, 1_000)])
def test_buffer_equals_its_batch_twin(spark, parts, shards, buffer):
    df = texts(spark, 150)
    out, state = folders(spark)
    feed(df, "id", lambda s: buffers.stream_buffer(s, "id", 3, out, state, buffer, shards), parts)
    written = spark.read.parquet(out).drop("batch_id")
    left = buffers.drained(spark, state, df, "id")
    assert left.columns == [*df.columns, "shard", "shuffle_pos"]
    assert left.count() <= shards * buffer
    want = buffers.buffered_order(df, "id", 3, buffer, shards)
    assert rows(written.unionByName(left)) == rows(want.select(*left.columns))
    for shard in range(shards):
        mine = sorted((r.id, r.shuffle_pos) for r in want.where(F.col("shard") == shard).collect())
        assert sorted(p for _, p in mine) == list(range(len(mine)))
        assert all(abs(p - arrived) < buffer for arrived, (_, p) in enumerate(mine))


def test_buffer_after_a_fault(spark, monkeypatch):
    df = texts(spark, 90)
    out, state = folders(spark)
    source = new_folder(spark, "source")
    start = lambda change=lambda b: b: streams.write_batches(
        stream_corpus(spark, source, df.schema), out, state, change=change)
    fail = lambda batch: (_ for _ in ()).throw(Broken("a lost driver"))
    monkeypatch.setattr(buffers, "write_batches", lambda df, path, state_path, trigger=None: (
        streams.write_batches(df, path, state_path, change=current["change"], trigger=trigger)))
    current = {"change": lambda b: b}
    for part in range(3):
        df.where(F.expr("id div 30") == part).write.mode("append").parquet(source)
        stream = lambda: buffers.stream_buffer(
            stream_corpus(spark, source, df.schema), "id", 3, out, state, 20, 2)
        if part == 1:
            current["change"] = fail
            with pytest.raises(Exception, match="a lost driver"):
                stream().awaitTermination()
            current["change"] = lambda b: b
        stream().awaitTermination()
    found = spark.read.parquet(out).drop("batch_id").unionByName(
        buffers.drained(spark, state, df, "id"))
    want = buffers.buffered_order(df, "id", 3, 20, 2)
    assert rows(found) == rows(want.select(*found.columns))


def test_buffers_refuse_what_has_no_place(spark):
    df = texts(spark, 5)
    with pytest.raises(ValueError, match="at least 1"):
        buffers.buffered_order(df, "id", 0, 0)
    with pytest.raises(ValueError, match="shard"):
        buffers.buffered_order(df.withColumn("shard", F.lit(1)), "id", 0)
    with pytest.raises(Exception, match="null"):
        buffers.buffered_order(df, "split", 0).collect()


@pytest.mark.parametrize("parts", [1, 4])
def test_closed_windows_are_written_once(spark, parts):
    df = spark.range(400).select(
        "id", (F.expr("id div 4") + 1).alias("step"), (F.col("id") * 7 % 150).alias("n_tokens"),
        (F.col("id") % 3 == 0).alias("clipped"), F.when(F.col("id") % 4 > 0, "a").otherwise("b").alias("run"))
    out, state = folders(spark)
    feed(df, "id", lambda s: streams.stream_completion_windows(
        s.drop("id"), 5, 10, out, state, run="run"), parts)
    found = spark.read.parquet(out)
    stats = step_completion_stats(df, ["run", "step"])
    metrics = [c for c in stats.columns if c not in ("run", "step")]
    want = log_windows(stats, metrics, 5, run="run").where(F.col("step") + 1 <= 100 - 10)
    columns = ["run", "step", "n_steps", *[F.round(m, 9) for m in metrics]]
    assert rows(found, *columns) == rows(want, *columns)  # a second write would be a second row


def test_rows_that_come_too_late_are_left_out(spark):
    schema = "step bigint, n_tokens bigint, clipped boolean"
    out, state = folders(spark)
    source = new_folder(spark, "source")
    for steps in ([*range(1, 41)], [26, 5, *range(41, 61)], [*range(61, 90)]):
        spark.createDataFrame([(s, 10 + s, False) for s in steps], schema).write.mode(
            "append").parquet(source)
        streams.stream_completion_windows(
            stream_corpus(spark, source, schema), 10, 15, out, state).awaitTermination()
    found = {r.step: r for r in spark.read.parquet(out).collect()}
    assert sorted(found) == [10, 20, 30, 40, 50, 60, 70]
    assert found[10].n_steps == 10 and found[10].completions__max_length == 14.5 + 1


@pytest.mark.parametrize("parts", [1, 3])
def test_alignment_of_two_streams(spark, parts):
    done = spark.range(-5, 140).where("id % 7 <> 0").select("id", F.lit("c").alias("completion"))
    targets = spark.range(-5, 140).where("id % 5 <> 0").select("id", F.lit("t").alias("target"))
    out, state = folders(spark)
    sources = [new_folder(spark, "source") for _ in range(2)]
    for part in range(parts):
        mine = F.floor((F.col("id") + 5) * parts / 145) == part
        for df, folder in ((done, sources[0]), (targets, sources[1])):
            df.where(mine).write.mode("append").parquet(folder)
        both = [stream_corpus(spark, folder, df.schema).withColumn("number", F.col("id"))
                for df, folder in ((done, sources[0]), (targets, sources[1]))]
        streams.stream_alignment(*both, "id", "number", 10, out, state).awaitTermination()
    closed = 139 - 20
    known = lambda df: df.where(F.col("id") < closed)
    found = spark.read.parquet(out)
    assert found.columns == ["id", "status", "completion", "target", "batch_id"]
    assert found.where(f"id >= {closed} and status <> 'aligned'").count() == 0
    path = new_folder(spark, "closed")
    known(found).write.parquet(path)
    report = streams.read_alignment_report(spark, path, "id").first()
    want = alignment_report(known(done), known(targets), "id").first()
    assert report.asDict() == {k: v for k, v in want.asDict().items() if k in report.asDict()}
    assert rows(known(found), "id").count((3,)) == 1
