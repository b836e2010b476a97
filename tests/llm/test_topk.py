import math
import random

import pytest
from pyspark.sql import functions as F

from fettle.llm import topk
from tests.helpers import rows


def brute(data, k, every):
    whole = [(key, [math.floor(256 * x) for x in v]) for key, v in data
             if key is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for q, a in whole:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in whole
                            if c != q and len(a) == len(b))
            found += [(q, rank, c, -s) for rank, (s, c) in enumerate(scored[:k], 1)]
    return sorted(found, key=repr)


def answer(df, k=5, every=10):
    vectors = df.select("vec_id", topk.quantized(F.col("embedding")).alias("embedding"))
    return rows(topk.top_inner_products(vectors, F.col("vec_id") % every == 0, k))


SCHEMA = "vec_id bigint, embedding array<double>"


def vectors():
    rng = random.Random(8)
    data = [(k, [rng.uniform(-1, 1) for _ in range(6)]) for k in range(300)]
    data += [(k, [0.5] * 6) for k in range(300, 420)]  # ties, in every partition
    data += [(1_000, [8e6] * 6), (1_001, [-8e6, 8e6, 3.0, 0.0, 1e-9, -1e-9])]
    data += [(2_000, None), (2_010, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 6),
             (2_020, [float("nan")] * 6), (2_030, [float("inf")] * 6)]
    return data


@pytest.mark.parametrize("block", [2_048, 7])
def test_answers_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk, "ROW_BLOCK", 37)
    df = spark.createDataFrame(vectors(), SCHEMA).repartition(5)
    assert answer(df) == brute(vectors(), 5, 10)


def test_few_candidates_and_other_lengths(spark):
    data = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (10, [1.0]), (20, [2.0]), (30, [])]
    df = spark.createDataFrame(data, SCHEMA)
    assert answer(df, 3) == brute(data, 3, 10)
    assert answer(df.limit(0)) == []
    alone = spark.createDataFrame([(0, [1.0])], SCHEMA)
    assert answer(alone) == []
    with pytest.raises(Exception, match="too large"):
        answer(spark.createDataFrame([(0, [1e300]), (1, [1.0])], SCHEMA))


def test_large_scores(spark):
    data = [(0, [2.0**45, 1.0]), (1, [3.9, -3.5]), (2, [-3.9, 2.0**44]), (20, [0.0, 2.0]),
            (3, [0.0, 0.5]), (4, [3.9, 2.0])]
    df = spark.createDataFrame(data, SCHEMA)
    assert answer(df) == brute(data, 5, 10)  # close to 2**63 on both sides
    too_large = spark.createDataFrame(
        [(0, [2.0**40] * 4), (5, [2.0**46] * 4), (1, [1.0] * 4)], SCHEMA)
    with pytest.raises(Exception, match="query 0 and row 5"):
        answer(too_large)
