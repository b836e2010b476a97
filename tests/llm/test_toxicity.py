import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import corpus_pipeline
from fettle.llm.queries import op3_toxicity
from fettle.llm.toxicity import (
    fit_toxicity, held_out, keep_below, maximal_segments, score_toxicity,
)


def brute_segments(scores):
    """Maximal segments by definition: the best stretch, then the same on either side of it."""
    def within(low, high):
        best = max(((sum(scores[a:b]), -a, -(b - a), a, b)
                    for a, b in itertools.combinations(range(low, high + 1), 2)),
                   default=(0,))
        if best[0] <= 0:
            return []
        a, b = best[3], best[4]
        return within(low, a) + [(a, b, best[0])] + within(b, high)

    return within(0, len(scores))


def test_segments_equal_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.choice([-3, -2, -1, 1, 2, 4]) + rng.random() / 16
                  for _ in range(rng.randrange(0, 14))]
        found = maximal_segments(np.array(scores))
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in want]
        assert [s for _, _, s in found] == pytest.approx([s for _, _, s in want])


def corpus(spark, n=1_200):
    rng = random.Random(3)
    plain = [f"{a}{b}" for a in "bdfgklm" for b in ("ap", "el", "ior", "unt", "ost", "ax")]
    foul = ["grumph", "snarfel", "grumphing", "snarfels"]
    data, labels = [], []
    for key in range(n):
        text = [rng.choice(plain) for _ in range(rng.randrange(20, 80))]
        toxic = key % 5 == 0
        if toxic:
            at = rng.randrange(len(text))
            text[at:at] = [rng.choice(foul) for _ in range(3)]
        data.append((key, " ".join(text)))
        if key % 3:
            labels.append((key, int(toxic)))
    return (spark.createDataFrame(data, "doc_id bigint, text string"),
            spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def test_labels_held_out_are_predicted(spark):
    docs, labels = corpus(spark)
    model = fit_toxicity(docs, labels)
    found = score_toxicity(docs, model).collect()
    assert len(found) == 1_200 and all(0 <= r.score <= 1 for r in found)
    assert all((r.score >= 0.3) == (r.doc_id % 5 == 0) for r in found)
    by_key = {r.doc_id: r.text for r in docs.collect()}
    for r in found:
        for s in r.segments:
            assert any(w in by_key[r.doc_id].encode()[s.begin:s.end].decode()
                       for w in ("grumph", "snarfel"))
    kept = keep_below(docs.withColumn("score", F.lit(1)), model, 0.3)
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == 960


def test_held_out_rows_are_never_learnt_from(spark):
    docs, labels = corpus(spark, 400)
    wrong = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic"))
                              .otherwise(F.col("toxic")))
    one, two = fit_toxicity(docs, labels), fit_toxicity(docs, wrong)
    assert one.slope == two.slope and (one.weights == two.weights).all()
    flags = {r.doc_id: r.h for r in docs.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()}
    assert flags == {k: zlib.crc32(str(k).encode()) % 4 == 2 for k in flags}


def test_odd_rows(spark):
    docs, labels = corpus(spark, 300)
    model = fit_toxicity(docs, labels.union(spark.createDataFrame(
        [(None, 1), (5, None), (7, 9), (10**9, 1)], labels.schema)))
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "grumph snarfel grumph"),
                                 (4, "  .. !"), (4, "  .. !"), (6, "grumph " * 200_000)],
                                "doc_id bigint, text string")
    found = score_toxicity(odd, model).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert [r.n_segments for r in found if r.doc_id in (1, 2, 4)] == [0] * 4
    empty = fit_toxicity(docs.limit(0), labels.limit(0))
    assert {r.score for r in score_toxicity(odd, empty).collect()} == {0.0}
    assert score_toxicity(docs.limit(0), model).collect() == []


@pytest.mark.parametrize("kind, share", [
    ("no labels", 0.0), ("all clean", 0.0), ("all toxic", 1.0), ("no word shared", 0.5)])
def test_nothing_to_learn_from_rejects_nothing(spark, tmp_path, kind, share):
    docs = spark.createDataFrame(
        [(key, f"a{key} b{key} c{key} and so on" if key else None) for key in range(40)],
        "doc_id bigint, text string")
    learnt = docs.where(~held_out(F.col("doc_id"))).select("doc_id").orderBy("doc_id").limit(4)
    number = F.row_number().over(Window.orderBy("doc_id")) - 1
    toxic = {"no word shared": (number % 2).cast("int"), "all toxic": F.lit(1)}.get(kind, F.lit(0))
    labels = learnt.withColumn("toxic", toxic).limit(0 if kind == "no labels" else 4)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    model = fit_toxicity(docs, labels)
    assert {round(r.score, 9) for r in score_toxicity(docs, model).collect()} == {share}
    assert keep_below(docs, model, 0.3).count() == 40
    assert {r.predicted for r in op3_toxicity(spark, str(tmp_path)).collect()} == {
        int(share >= 0.3)}
    assert corpus_pipeline.without_toxic(spark, docs, str(tmp_path)).count() == 40


def test_predicted_is_the_score_at_its_threshold(spark, tmp_path):
    docs, labels = corpus(spark, 600)
    odd = spark.createDataFrame([(10_000 + k, t) for k, t in enumerate(
        ["", None, "a", "bap", "grumph", "..."])], docs.schema)
    docs.union(odd).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    found = op3_toxicity(spark, str(tmp_path)).collect()
    assert len(found) == 606
    assert all(r.predicted == int(r.score >= 0.3) for r in found)
    nothing = {r.score for r in found if r.doc_id in (10_000, 10_001, 10_002, 10_005)}
    assert len(nothing) == 1 and nothing.pop() < 0.3  # whatever their length
