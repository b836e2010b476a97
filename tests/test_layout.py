import json

import pytest
from pyspark.sql import functions as F

from fettle.shared import new_folder
from fettle.sources import layout
from fettle.sources.runs import log_values, read_log_records
from tests.helpers import plan_of, rows


@pytest.fixture
def messages(spark):
    return spark.range(400).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 60).alias("conv"),
        F.col("id").alias("turn"), F.concat(F.lit("t"), "id").alias("text"),
        F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"))


def written(spark, df, *args):
    name, path = layout.new_table(spark)
    return layout.write_layout(df, name, *args, path=path)


def test_rows_lie_where_the_layout_says(spark, messages):
    name = written(spark, messages, "conv", 8, "turn", "split")
    assert rows(spark.table(name), *messages.columns) == rows(messages)
    report = layout.layout_report(spark, name, "conv", 8).first()
    assert (report.n_rows, report.n_misplaced, report.n_extra_files) == (400, 0, 0)
    assert report.n_files <= 16
    files = spark.table(name).select(
        F.col("_metadata.file_path").alias("file"), "conv", "turn").collect()
    seen = {}
    for r in files:  # rows of a file come in its order
        seen.setdefault(r.file, []).append((r.conv is not None, r.conv or 0, r.turn))
    assert all(keys == sorted(keys) for keys in seen.values())


def test_a_table_with_other_buckets_is_reported(spark, messages):
    name = written(spark, messages, "turn", 4)
    report = layout.layout_report(spark, name, "conv", 4).first()
    assert report.n_misplaced > 0
    plain, path = layout.new_table(spark)
    messages.repartition(3).write.option("path", path).saveAsTable(plain)
    assert layout.layout_report(spark, plain, "conv", 4).first().n_misplaced == 400
    empty = written(spark, messages.limit(0), "conv", 4)
    assert tuple(layout.layout_report(spark, empty, "conv", 4).first()) == (0, 0, 0, 0)


def test_equal_layouts_meet_without_an_exchange(spark, messages):
    one = written(spark, messages, "conv", 8, "turn", "split")
    two = written(spark, messages.groupBy("conv").agg(F.count("*").alias("n")), "conv", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(one).where("split = 'train'").join(spark.table(two), "conv")
        plan = plan_of(joined)
        assert joined.count() == messages.where("split = 'train' and conv is not null").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    assert "PartitionFilters: [isnotnull(split" in plan  # the other split's folder is not listed


RECORDS = [
    [{"step": 5, "loss": 2.5, "epoch": 0.2}, {"step": 10, "loss": 2, "kl": 1e-06, "note": "x"}],
    [{"step": 1, "rewards/a/mean": -0.5, "flag": True, "none": None, "nested": {"loss": 1}},
     {"loss": 4}, {"step": 3}],
    [],
]


def test_records_of_any_keys(spark, tmp_path):
    for k, history in enumerate(RECORDS):
        (tmp_path / f"run{k}.json").write_text(json.dumps({"best": None, "log_history": history}, indent=2))
    records = read_log_records(spark, str(tmp_path))
    assert records.count() == 5
    found = log_values(records.withColumn("run", F.regexp_extract("run", r"run\d", 0)))
    assert rows(found) == sorted([
        ("run0", 5, "loss", 2.5), ("run0", 5, "epoch", 0.2), ("run0", 10, "loss", 2.0),
        ("run0", 10, "kl", 1e-06), ("run1", 1, "rewards/a/mean", -0.5), ("run1", None, "loss", 4.0),
    ], key=repr)


def test_records_by_line(spark):
    folder = new_folder(spark, "lines")
    lines = [json.dumps(r) for history in RECORDS for r in history]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(folder)
    records = read_log_records(spark, folder, history=None)
    assert records.count() == 5 and "record" in records.columns
    assert log_values(records).count() == 6
