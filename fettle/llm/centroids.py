"""Centroid clustering with the threshold algorithm.

The nearest centroid of a vector is found from sorted lists: per dimension, the centroids in order
of their value there. From the vector's own value every list is walked outward, in each step to
the nearer of the two next centroids. A centroid met for the first time is compared in full. What
no list has reached yet is at least as far away as the squared steps of all lists together, so a
vector is done once that sum strictly exceeds the best distance; at equality a centroid with a
smaller number could still come.

Many vectors walk side by side in a task. Centroids are few, a parameter, and go to the tasks with
their code; sums of vectors come back per centroid and dimension. All numbers are whole and exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fettle.llm.topk import quantized
from fettle.shared import cut

ROW_BLOCK = 1_024  # vectors that walk side by side
LARGEST = (1 << 63) - 1


def whole_vectors(vector: Column, dimensions: int, steps: int = 256) -> Column:
    """floor(steps * x) of every component, x as double; null unless there are ``dimensions``
    components and none is null or not finite. Components whose multiple is no BIGINT are an error."""
    return F.when(F.size(vector) == dimensions, quantized(vector, steps))


def cluster(vectors: DataFrame, clusters: int = 40, rounds: int = 5, salt: int = 2,
            id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector.

    Vectors hold whole numbers and are equally long (see ``whole_vectors``); null ones take no
    part. Centroids start as the vectors with the smallest lowercase-hex sha256 of
    ``salt:<id>``, in that order, repeated ids in order of their vectors. Each round assigns every
    vector to its nearest centroid by squared Euclidean distance, the smaller number among equals,
    and moves every centroid that has vectors to the floor of their mean; then vectors are
    assigned once more. A round that moves nothing is the last, as the others would be like it.

    With fewer vectors than ``clusters`` each starts one. Vectors with a null id start none but are
    assigned and counted; without any id there is no centroid and every other column is null.
    Repeated rows count and come back one by one. Distances and their sums beyond a BIGINT are an
    error; components alone may be of any size. Other columns are ignored.
    """
    kind = vectors.schema[id_column].dataType.simpleString()
    rows = cut(vectors.select(
        F.col(id_column).alias("id"), F.col(vector_column).cast("array<bigint>").alias("vector")
    ).where("vector is not null"))
    name = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    first = rows.where("id is not null").orderBy(name, "vector").limit(clusters)
    centroids = [row.vector for row in first.select("vector").collect()]
    if len({len(c) for c in centroids}) > 1:
        raise ValueError("vectors are not equally long")
    for _ in range(rounds if centroids else 0):
        moved = _moved(rows, centroids)
        if moved == centroids:
            break
        centroids = moved

    assigned = cut(rows.mapInArrow(_assigner(centroids), f"id {kind}, cluster int, distance bigint")
                   if centroids else rows.selectExpr("id", "cast(null as int) cluster",
                                                     "cast(null as bigint) distance"))
    per_cluster = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = assigned.agg(F.sum("distance").alias("inertia"))
    spark = rows.sparkSession
    digests = spark.createDataFrame(
        [(k, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
         for k, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    # One row per centroid, and one: both bounded by ``clusters``.
    facts = F.broadcast(per_cluster.join(digests, "cluster").crossJoin(total))
    return assigned.join(facts, "cluster", "left").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256")


def _moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Floor of the mean of each centroid's vectors; those without any stay."""
    sums = rows.mapInArrow(_summer(centroids), "cluster int, place int, n bigint, part bigint")
    found = sums.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("whole"))
    moved = [list(c) for c in centroids]
    for row in found.collect():  # clusters * dimensions rows
        moved[row.cluster][row.place] = int(row.whole) // row.n
    return moved


class Lists:
    """The centroids, and per dimension their order by value."""

    def __init__(self, centroids: list[list[int]]) -> None:
        self.points = np.array(centroids, dtype=np.int64)
        order = np.argsort(self.points, axis=0, kind="stable")
        self.order = np.ascontiguousarray(order.T)
        self.values = np.ascontiguousarray(np.take_along_axis(self.points, order, axis=0).T)
        self.reach = int(max(abs(int(self.points.min())), abs(int(self.points.max()))))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each vector and the squared distance."""
        largest = max(self.reach, *(abs(int(f())) for f in (vectors.min, vectors.max)), 1)
        fits = vectors.shape[1] * (2 * largest)**2 <= LARGEST
        kind = np.int64 if fits else object  # object: Python's whole numbers, of any size
        best, distance = self._walk(vectors.astype(kind), self.points.astype(kind),
                                    self.values.astype(kind))
        if not fits:
            if (distance > LARGEST).any():
                raise OverflowError(f"a squared distance is no BIGINT: {distance.max()}")
            distance = distance.astype(np.int64)
        return best, distance

    def _walk(self, vectors, points, values):
        many, dimensions = vectors.shape
        count = len(points)
        # Next list entries below and above each value.
        above = np.empty((many, dimensions), dtype=np.int64)
        for d in range(dimensions):
            above[:, d] = np.searchsorted(values[d], vectors[:, d])
        below = above - 1
        best = np.full(many, count, dtype=np.int64)
        nearest = np.zeros(many, dtype=vectors.dtype)
        seen = np.zeros((many, count), dtype=bool)
        axis = np.arange(dimensions)
        active = np.arange(many)
        while len(active):
            here, low, high = vectors[active], below[active], above[active]
            some_low, some_high = low >= 0, high < count
            to_low = here - values[axis, np.maximum(low, 0)]
            to_high = values[axis, np.minimum(high, count - 1)] - here
            down = some_low & (~some_high | (to_low <= to_high))
            step = np.where(down, to_low, to_high)
            met = self.order[axis, np.where(down, np.maximum(low, 0), np.minimum(high, count - 1))]
            below[active], above[active] = low - down, high + ~down
            # Centroids met for the first time are compared in full.
            new = np.zeros((len(active), count), dtype=bool)
            np.put_along_axis(new, met, True, axis=1)
            new &= ~seen[active]
            seen[active] |= new
            row, centroid = np.nonzero(new)
            if len(row):
                apart = here[row] - points[centroid]
                exact = (apart * apart).sum(axis=1)
                self._better(active[row], centroid, exact, best, nearest, count)
            frontier = (step * step).sum(axis=1)
            done = (frontier > nearest[active]) | seen[active].all(axis=1)
            active = active[~done]
        return best, nearest

    @staticmethod
    def _better(who, centroid, exact, best, nearest, count):
        """Keep the nearer centroid, and of equally near ones the smaller number."""
        order = np.lexsort((centroid, exact.astype(object) if exact.dtype == object else exact, who))
        first = np.ones(len(order), dtype=bool)
        first[1:] = who[order][1:] != who[order][:-1]
        pick = order[first]
        mine = who[pick]
        nearer = (best[mine] == count) | (exact[pick] < nearest[mine]) | (
            (exact[pick] == nearest[mine]) & (centroid[pick] < best[mine]))
        mine, pick = mine[nearer], pick[nearer]
        best[mine], nearest[mine] = centroid[pick], exact[pick]


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int):
    for batch in batches:
        for at in range(0, batch.num_rows, ROW_BLOCK):
            part = batch.slice(at, ROW_BLOCK)
            lists = part.column("vector")
            if pc.any(pc.not_equal(pc.list_value_length(lists), dimensions)).as_py():
                raise ValueError("vectors are not equally long")
            yield part, pc.list_flatten(lists).to_numpy(False).reshape(-1, dimensions)


def _assigner(centroids: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for part, vectors in _blocks(batches, len(centroids[0])):
            best, distance = lists.nearest(vectors)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(best, pa.int32()), pa.array(distance, pa.int64())],
                ["id", "cluster", "distance"])

    return run


def _summer(centroids: list[list[int]]):
    """Per centroid and dimension: number of vectors and sum, in parts that each fit."""
    dimensions = len(centroids[0])
    limit = 1 << 62

    def rows(sums: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        cluster = np.repeat(np.flatnonzero(n), dimensions)
        place = np.tile(np.arange(dimensions), len(cluster) // dimensions)
        return pa.RecordBatch.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(place, pa.int32()),
             pa.array(n[cluster], pa.int64()), pa.array(sums[cluster, place], pa.int64())],
            ["cluster", "place", "n", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        sums = np.zeros((len(centroids), dimensions), dtype=np.int64)
        n, held = np.zeros(len(centroids), dtype=np.int64), 0
        for _, vectors in _blocks(batches, dimensions):
            best, _ = lists.nearest(vectors)
            largest = max(abs(int(vectors.min())), abs(int(vectors.max())))
            step = max(1, min(len(vectors), limit // max(1, largest)))
            for at in range(0, len(vectors), step):
                part, mine = vectors[at:at + step], best[at:at + step]
                if held + largest * len(part) > limit:
                    yield rows(sums, n)
                    sums, n, held = np.zeros_like(sums), np.zeros_like(n), 0
                np.add.at(sums, mine, part)
                n += np.bincount(mine, minlength=len(n))
                held += largest * len(part)
        yield rows(sums, n)

    return run
