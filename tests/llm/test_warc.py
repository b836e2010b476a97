import base64
import hashlib
import io
import os

import pytest
import zstandard
from pyspark.sql import functions as F

from fettle.llm import warc
from tests.helpers import rows


def brute(data, min_bytes=0):
    largest = {}
    for key, _, html in data:
        payload = (html or "").encode()
        if len(payload) >= min_bytes:
            largest[payload] = max(largest.get(payload, (False, 0)), (key is not None, key or 0))
    found = []
    for key, _, html in data:
        payload = (html or "").encode()
        named, best = largest.get(payload, (False, 0))
        to = best if named and key != best else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        found.append((key, len(payload), digest, "response" if to is None else "revisit", to))
    return sorted(found, key=repr)


DATA = [(k, f"http://h/{k}", f"<p>{k % 7} é</p>" * (1 + k % 4)) for k in range(60)]
DATA += [(100, None, None), (101, "u\r\nX: y", ""), (102, "", "WARC/1.1\r\n\r\n\r\n\r\n"),
         (None, "n", "<p>only here</p>"), (None, "n", None), (5, "again", DATA[5][2]),
         (59, "again", DATA[59][2]), (103, "long", "<b>" * 700_000)]
SCHEMA = "page_id bigint, url string, html string"


def test_records_come_back(spark, tmp_path):
    df = spark.createDataFrame(DATA, SCHEMA).selectExpr("*", "1 AS largest", "2 AS same").repartition(3)
    index = warc.write_archives(df, f"file://{tmp_path}/archives")
    assert rows(warc.read_archives(index)) == brute(DATA)
    one = index.where("page_id = 103")
    record = warc.read_records(one).first()
    fields, block = next(warc.records(bytes(record["record"])))
    assert fields["X-Page-ID"] == "103" and block == DATA[-1][2].encode()
    # Any Zstandard reader reads a bundle: frames in a row, the seek table skipped.
    for name in os.listdir(tmp_path / "archives"):
        raw = (tmp_path / "archives" / name).read_bytes()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        ids = {r.record_id for r in index.where(F.col("file").endswith(name)).collect()}
        assert {f["WARC-Record-ID"] for f, _ in warc.records(whole)} == ids


def test_short_payloads_are_not_revisits(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    assert rows(warc.read_archives(warc.write_archives(df, min_bytes=30))) == brute(DATA, 30)


def test_empty(spark):
    index = warc.write_archives(spark.createDataFrame([], SCHEMA))
    assert warc.read_archives(index).collect() == [] and index.count() == 0


def test_frames_and_bundles_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2_000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 1_000)
    df = spark.createDataFrame(DATA, SCHEMA).coalesce(1)
    index = warc.write_archives(df)
    assert index.select("file").distinct().count() > 3
    assert index.select("file", "frame").distinct().count() > 10
    assert rows(warc.read_archives(index)) == brute(DATA)


def test_every_record_has_an_id_of_its_own(spark):
    data = [*DATA, (1, "other", "another payload"), (1, "other", "another payload"), (None, "n", "x"),
            (None, "n", "y"), (7, "u", "x")]
    index = warc.write_archives(spark.createDataFrame(data, SCHEMA).repartition(3))
    assert index.select("record_id").distinct().count() == index.count() == len(data)
    assert rows(warc.read_archives(index)) == brute(data)
    found = [(r.page_id, next(warc.records(bytes(r.record)))) for r in warc.read_records(index).collect()]
    ids = {r.record_id for r in index.collect()}
    assert {fields["WARC-Record-ID"] for _, (fields, _) in found} == ids
    for _, (fields, _) in found:
        if fields["WARC-Type"] == "revisit":
            assert fields["WARC-Refers-To-Target-URI"] in {
                " ".join((url or "").split()) for page, url, _ in data
                if str(page) == fields["X-Refers-To-Page"]}


def test_folders_as_spark_takes_them(spark, tmp_path):
    df = spark.createDataFrame(DATA[:5], SCHEMA)
    for name in (f"{tmp_path}/plain", f"file:{tmp_path}/one", f"file://{tmp_path}/three"):
        index = warc.write_archives(df, name)
        assert rows(warc.read_archives(index)) == brute(DATA[:5])
        assert {r.file.startswith(f"file://{tmp_path}/") for r in index.collect()} == {True}
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        warc.write_archives(df, "nosuch://bucket/x")
