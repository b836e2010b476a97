import math
import re

import pytest
from pyspark.sql import functions as F

from fettle.llm.mixing import mix_sources, mixed_documents
from tests.helpers import plan_of, rows


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Source targets by filling up: shares by weight, the excess over a cap shared again."""
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        whole = sum(weight[s] for s in names if s not in full)
        got = {s: cap * sizes[s] if s in full else left * weight[s] / whole for s in names}
        over = {s for s in names if s not in full and got[s] > cap * sizes[s]}
        if not over:
            return got
        full |= over


def corpus(spark, n=600):
    return spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.expr("array_join(transform(sequence(1, cast(1 + pmod(hash(id), 200) as int)), "
               "i -> concat('w', i)), ' ')").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None))
        .when(F.col("id") % 40 == 2, "é").otherwise(F.concat(F.lit("s"), F.col("id") % 6))
        .alias("source"),
        F.lit(1).alias("size"),
    )


@pytest.mark.parametrize("tilt", [0.0, 1.0])
def test_sources_meet_their_targets(spark, tilt):
    docs = corpus(spark)
    found = mix_sources(docs, length_tilt=tilt).collect()
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    sizes = {}
    for text, source in texts.values():
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text))
    want, taken = targets(sizes), {}
    assert len(found) == 600
    for r in found:
        text, source = texts[r.doc_id]
        assert r["size"] == len(text.split()) and r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source], rel=1e-9)
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"]
        taken[source] = taken.get(source, 0) + r.taken
    for source in sizes:
        assert taken[source] == pytest.approx(want[source], rel=0.02), source
    assert any(want[s] == 3 * sizes[s] for s in sizes)


def test_reruns_and_partitions_agree(spark):
    docs = corpus(spark, 200)
    base = rows(mix_sources(docs))
    assert rows(mix_sources(docs.repartition(7))) == base
    assert rows(mix_sources(docs, seed=1)) != base


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None), (2, "", "a"), (None, "x y", "a"), (4, "x y z", "a"), (4, "x y z", "a"),
         (5, "one two", "b"), (6, " ", "empty")],
        "doc_id bigint, text string, source string")
    found = mix_sources(docs).collect()
    assert len(found) == 7 and sum(r["size"] for r in found if r.doc_id == 4) == 6
    assert all(r.taken <= 3 * r["size"] for r in found)
    assert mix_sources(docs.limit(0)).collect() == []
    nothing = mix_sources(docs.where("doc_id = 6")).collect()
    assert [(r["size"], r.target, r.taken) for r in nothing] == [(0, 0.0, 0)]


def test_documents_come_as_often_as_they_have_copies(spark):
    docs = corpus(spark, 300)
    docs = docs.union(docs.limit(20))
    want = {(r.source_size, r.target) for r in mix_sources(docs).collect()}
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    here = {r.doc_id: r.n for r in docs.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    seen = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert all(n <= 3 * here[k] for k, n in seen.items())
    words = F.size(F.split("text", " "))
    sizes, taken = (
        {r.source: r.n for r in df.groupBy("source").agg(F.sum(words).alias("n")).collect()}
        for df in (docs, mixed)
    )
    target = dict(want)
    for source, size in sizes.items():
        assert taken[source] == pytest.approx(target[size], rel=0.05), source


def test_nothing_runs_in_python(spark):
    plan = plan_of(mix_sources(corpus(spark, 50))) + plan_of(mixed_documents(corpus(spark, 50)))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("tilt", [0.0, 1.0, 0.5])
def test_rates_solve_the_balance(spark, tilt):
    """Copies against rates found by bisection on sums over every document."""
    docs = corpus(spark)
    found = mix_sources(docs, length_tilt=tilt).collect()
    by_source = {}
    source = {r.doc_id: r.source for r in docs.collect()}
    for r in found:
        by_source.setdefault(source[r.doc_id], []).append(r)
    steps = 0
    for mine in by_source.values():
        mean, target = mine[0].source_size / len(mine), mine[0].target
        if target >= 3 * mine[0].source_size:
            assert all(r.copies == 3 for r in mine)
            continue
        g = {r.doc_id: (r["size"] / mean)**tilt for r in mine}
        rate = lambda m, k: math.exp(min(m * g[k], math.log(3)))  # noqa: E731, B023
        low, high = -1e4, 1e4
        for _ in range(200):
            m = (low + high) / 2
            over = sum(r["size"] * rate(m, r.doc_id) for r in mine) > target
            low, high = (low, m) if over else (m, high)
        steps += abs(m) > 1e-3
        away = [r for r in mine if abs(r.copies - rate(m, r.doc_id)) >= 1 + 1e-5]
        assert len(away) <= 5  # exchanges of single copies; all others are the rate, rounded
    assert steps  # some source needs more than one copy of everything


def test_helper_columns_clash_with_none(spark):
    docs = corpus(spark, 60).withColumns({"__row": F.lit(7), "__copies": F.lit("a"), "row": F.lit(1.5),
                                          "copies": F.lit(2), "__other": F.col("doc_id") % 2})
    mixed = mixed_documents(docs)
    assert mixed.dtypes == docs.dtypes
    kept = {tuple(r) for r in docs.collect()}
    assert all(tuple(r) in kept for r in mixed.collect())
    assert mixed_documents(docs.limit(0)).collect() == []


def test_a_hot_row_is_mixed_like_any(spark):
    docs = corpus(spark, 90).union(
        spark.range(60).select(F.lit(7).cast("bigint"), F.lit("one two three"), F.lit("hot"), F.lit(1)))
    docs = docs.withColumn("other", F.monotonically_increasing_id() % 3)
    base = rows(mixed_documents(docs, length_tilt=1.0))
    assert rows(mixed_documents(docs.repartition(5), length_tilt=1.0)) == base
    assert sum(r[0] == 7 and r[1] == "one two three" for r in base) <= 180
