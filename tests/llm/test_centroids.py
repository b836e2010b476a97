import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fettle.llm import centroids
from fettle.llm.queries import SQL, op13_centroids
from tests.helpers import rows

SCHEMA = "vec_id bigint, embedding array<double>"
DIMENSIONS = 6


def brute(data, clusters, rounds):
    kept = [(key, [math.floor(256 * x) for x in v]) for key, v in data
            if v is not None and len(v) == DIMENSIONS
            and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    starts = sorted((sha(f"2:{key}"), v) for key, v in kept if key is not None)[:clusters]
    points = [v for _, v in starts]
    if not points:
        return [(key, None, None, None, None, None) for key, _ in kept]

    def assigned():
        return [min((sum((a - b)**2 for a, b in zip(v, c)), k) for k, c in enumerate(points))
                for _, v in kept]

    for _ in range(rounds):
        found = assigned()
        for k in range(len(points)):
            mine = [v for (_, v), (_, c) in zip(kept, found) if c == k]
            if mine:
                points[k] = [sum(column) // len(mine) for column in zip(*mine)]
    found = assigned()
    inertia = [sum(d for d, c in found if c == k) for k in range(len(points))]
    return sorted(((key, c, d, inertia[c], sum(inertia), sha(",".join(map(str, points[c]))))
                   for (key, _), (d, c) in zip(kept, found)), key=repr)


def answer(spark, data, clusters=8, rounds=5):
    df = spark.createDataFrame(data, SCHEMA).repartition(3).withColumn("cluster", F.lit("x"))
    whole = df.withColumn("embedding", centroids.whole_vectors(F.col("embedding"), DIMENSIONS))
    return rows(centroids.cluster(whole, clusters, rounds))


def vectors(n=700):
    rng = random.Random(5)
    middles = [[rng.uniform(-1, 1) for _ in range(DIMENSIONS)] for _ in range(10)]
    data = [(k, [x + rng.gauss(0, 0.2) for x in rng.choice(middles)]) for k in range(n)]
    data += [(1_000 + k, [0.25] * DIMENSIONS) for k in range(300)]  # a heap of equal vectors
    data += [(5, [0.25] * DIMENSIONS), (5, [0.25] * DIMENSIONS), (None, [0.5] * DIMENSIONS)]
    data += [(3_000, None), (3_001, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (3_002, [0.5]), (3_003, []),
             (3_004, [float("nan")] * DIMENSIONS), (3_005, [float("-inf")] * DIMENSIONS)]
    return data


@pytest.mark.parametrize("clusters, rounds, block", [(8, 5, 1_024), (40, 2, 7), (1, 1, 64), (8, 0, 64)])
def test_clusters_equal_brute_force(spark, monkeypatch, clusters, rounds, block):
    monkeypatch.setattr(centroids, "ROW_BLOCK", block)
    assert answer(spark, vectors(), clusters, rounds) == brute(vectors(), clusters, rounds)


def test_ties_and_few_vectors(spark):
    grid = [(k, [float(k % 3), float(k // 3 % 3), *[0.0] * (DIMENSIONS - 2)]) for k in range(30)]
    assert answer(spark, grid, 5, 3) == brute(grid, 5, 3)
    few = [(1, [1.0] * DIMENSIONS), (2, [1.0] * DIMENSIONS), (3, [-1.0] * DIMENSIONS)]
    assert answer(spark, few, 40, 5) == brute(few, 40, 5)
    assert answer(spark, []) == []
    nameless = [(None, [1.0] * DIMENSIONS)]
    assert answer(spark, nameless) == brute(nameless, 8, 5)


def test_large_components(spark):
    far = float(2**40)  # two of them square beyond 64 bits unless they cancel
    data = [(k, [far + k, *[0.5 * k] * (DIMENSIONS - 1)]) for k in range(50)]
    assert answer(spark, data, 4, 3) == brute(data, 4, 3)
    with pytest.raises(Exception, match="no BIGINT"):
        answer(spark, [*data, (99, [-far] * DIMENSIONS)], 1, 1)
    with pytest.raises(Exception, match="too large"):
        answer(spark, [(0, [1e300] * DIMENSIONS)])


def test_walk_stops_early_and_is_exact():
    rng = np.random.default_rng(1)
    points = rng.integers(-1_000, 1_000, (200, 3))
    inside = rng.integers(-1_000, 1_000, (500, 3))
    lists = centroids.Lists(points.tolist())
    full = ((inside[:, None] - points[None])**2).sum(axis=2)
    best, distance = lists.nearest(inside)
    assert (best == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    compared = []
    better = centroids.Lists._better
    lists._better = lambda who, *rest: (compared.append(len(who)), better(who, *rest))
    lists.nearest(inside)
    assert sum(compared) < 500 * 200 / 2  # most centroids are never compared


def test_sql(spark, tmp_path):
    rng = random.Random(9)
    data = [(k, [rng.uniform(-1, 1) for _ in range(64)]) for k in range(150)]
    data += [(200 + k, [0.5] * 64) for k in range(40)] + [(300, [0.5] * 63), (301, None)]
    spark.createDataFrame(data, "vec_id bigint, embedding array<float>").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(SQL["op13_centroids"])
    names = [d[0] for d in want.description]
    found = op13_centroids(spark, str(tmp_path))
    assert sorted(names) == sorted(found.columns)
    assert rows(found, *names) == sorted(want.fetchall(), key=repr)
