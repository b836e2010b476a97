import os

import pytest
from pyspark.sql import functions as F

from fettle.operators.split import fraction_split, split_sizes
from fettle.shared import cut, new_folder, scratch, shared_dir
from fettle.sources.artifacts import artifact_inventory, artifact_total
from fettle.sources.corpus import (
    corpus_path,
    read_corpus,
    spread,
    stream_corpus,
    write_prepared,
)
from tests.helpers import plan_of, rows


def test_paths():
    assert corpus_path("/data/", "sub/dir", "train") == "/data/sub/dir/train"
    assert corpus_path("s3://bucket/c") == "s3://bucket/c"


def test_prepared_splits_are_read_back_by_split(spark, tmp_path):
    path = str(tmp_path / "prepared")
    df = spark.range(200).withColumn("text", F.lit("x"))
    split = fraction_split(df, "id", 0.1, 0)
    write_prepared(split, path)
    test = read_corpus(spark, path, split="split=test")
    assert test.count() == 20 and test.columns == ["id", "text"]
    both = read_corpus(spark, path)
    assert rows(split_sizes(both)) == [("test", 20), ("train", 180)]
    assert "PartitionFilters: [isnotnull(split" in plan_of(both.where("split = 'test'"))
    a, b = (both.where(F.col("split") == s).select("id") for s in ("train", "test"))
    assert a.intersect(b).count() == 0 and df.select("id").exceptAll(a.union(b)).count() == 0
    with pytest.raises(Exception, match="already exists"):
        write_prepared(split, path)


def test_json_lines(spark, tmp_path):
    folder = tmp_path / "finetune" / "train"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(
        '{"question": "q", "response_j": "good", "response_k": "bad"}\n'
        '{"question": "r", "response_j": "yes"}\n'
    )
    schema = "question string, response_j string, response_k string"
    df = read_corpus(spark, str(tmp_path), "finetune", "train", schema, "json")
    assert rows(df) == [("q", "good", "bad"), ("r", "yes", None)]
    with pytest.raises(ValueError):
        read_corpus(spark, str(tmp_path), fmt="xml")


def test_streams_read_folders_and_files(spark, tmp_path):
    path = str(tmp_path / "docs.parquet")
    spark.range(30).repartition(3).write.parquet(path)
    file = next(p for p in (tmp_path / "docs.parquet").iterdir() if p.suffix == ".parquet")
    for source, expected in ((path, 30), (str(file), None)):
        out = new_folder(spark, "test")
        df = stream_corpus(spark, source, "id bigint", max_files=1)
        df.writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", new_folder(spark, "state")
        ).trigger(availableNow=True).start().awaitTermination()
        assert spark.read.parquet(out).count() == (expected or spark.read.parquet(source).count())


def test_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(0, 100, numPartitions=1)).rdd.getNumPartitions() == cores


def test_inventory_is_of_the_folder_itself(spark, tmp_path):
    (tmp_path / "model.bin").write_bytes(b"x" * 2048)
    (tmp_path / "config.json").write_text("{}")
    (tmp_path / "inner").mkdir()
    (tmp_path / "inner" / "other.txt").write_text("not counted")
    (tmp_path / "split=train").mkdir()
    (tmp_path / "split=train" / "part.bin").write_text("not counted either")
    inventory = artifact_inventory(spark, str(tmp_path))
    assert rows(inventory) == [("config.json", 2), ("model.bin", 2048)]
    assert rows(artifact_total(inventory)) == [(2, 2050, 2050 / 1024 / 1024)]


def test_the_shared_folder_is_the_one_named(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_scratch_removes_what_was_cut(spark, tmp_path):
    with scratch(spark):
        kept = cut(spark.range(10))
        path = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(path) and kept.count() == 10
    assert not os.path.exists(path)
