"""The pipeline against plain Python, stage by stage, and over the small tables."""

import pytest

import corpus_pipeline
from fettle.llm.decontaminate import normal
from fettle.llm.queries import QUERIES, SQL
from tests.helpers import plan_of, rows
from tests.llm.test_neardup import brute
from tests.oracle import difference, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_stages_in_order(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SMALL)
        assert docs.columns == before.columns and docs.dtypes == before.dtypes, name
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        data = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
        assert kept <= {key for key, _ in data}
        if name == "near_duplicates":
            classes = brute(data, 5)
            assert kept == {key for key, least in classes.items() if key == least}
        if name == "decontamination":
            items = [normal(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            exact = {key for key, text in data if any(i in normal(text) for i in items)}
            assert exact and not exact & kept and len(data) - len(kept) <= len(exact) + 2
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    sharded = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert sharded.columns == [*documents.columns, "slot", "shard"]
    assert sharded.count() == docs.count()


def test_whole_run_and_odd_rows(spark, tmp_path):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.count() > 0 and rows(found) == rows(corpus_pipeline.run(spark, SMALL))
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, "a b c d e f g", "en", "s", 13),
         (1, "a b c d e f g", "en", "s", 13), (2, "", "en", None, 0)],
        spark.read.parquet(f"{SMALL}/documents.parquet").schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    for name in ("labels", "benchmark"):
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        table.write.parquet(f"{tmp_path}/{name}.parquet")
        table.limit(0).write.parquet(f"{tmp_path}/empty/{name}.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= {None, 1, 2}
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").collect() == []


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), duck(SMALL), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_queries_run(spark, name):
    found = QUERIES[name](spark, SMALL)
    assert "CartesianProduct" not in plan_of(found) and found.count() > 0
