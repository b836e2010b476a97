"""Exact top-k inner products by distributed histogram selection.

Every query is scored against every row in each of a few passes, and no pass gathers scores. The
first pass finds each query's range of scores; the next ones count scores in histograms over the
stretch that holds the k-th largest, narrowing it by the number of bins each time, until the
k-th score itself is known. The last pass filters by it: rows above are results, and of the rows
that equal it a task passes on only its ``k`` smallest ids, which is all a tie can need.

Queries are taken in blocks of ``QUERY_BLOCK``, the only thing that is broadcast.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fettle.shared import cut

QUERY_BLOCK = 2_048
ROW_BLOCK = 1_024  # rows scored at a time in a task
BINS = 256
EXACT = float(1 << 53)
FITS = float(1 << 62)  # no sum below it, rounded as it may be, passes 64 bits


def quantized(vector: Column, steps: int = 256) -> Column:
    """floor(steps * x) of every component, x as double; null if a component is null or not finite.

    Components whose multiple is no BIGINT are an error.
    """
    value = vector.cast("array<double>")
    good = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(value, lambda x: F.floor(x * steps))
    fits = F.forall(value, lambda x: F.abs(x * steps) < float(1 << 63))
    return F.when(good, F.when(fits, whole).otherwise(
        F.raise_error(F.lit("a component is too large for a BIGINT"))))


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 5,
                       id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the largest inner product per query.

    Vectors hold integers (see ``quantized``); a null vector takes no part, nor does a null id.
    Rows for which ``is_query`` holds are queries, every row but those with the query's own id is
    a candidate. Ties go to the smaller id, ranks begin at 1; with fewer candidates than ``k`` all
    are returned. Vectors of another length than a query's are no candidates of it. Rows that
    repeat an id are separate candidates; a query id that is repeated asks once per row and is
    answered once, by the copy that sorts first. A score beyond a BIGINT is an error that names
    both rows; large components alone are not.
    """
    spark = vectors.sparkSession
    rows = cut(vectors.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where("vector is not null"))
    asked = rows.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    total = asked.count()
    blocks = -(-total // QUERY_BLOCK)
    answers = None  # each block's are written, so that no more than one block's queries are held
    for number in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).toPandas()
        for _, same in mine.groupby(mine.vector.map(len)):
            found = cut(_block(
                rows, same.id.to_numpy(np.int64),
                np.array(same.vector.to_list(), dtype=np.int64).reshape(len(same), -1), k))
            answers = found if answers is None else answers.union(found)
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    return answers if answers is not None else spark.createDataFrame([], schema)


def _block(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Answers for one block of queries of equal length."""
    candidates = rows.select("id", "vector").where(F.size("vector") == queries.shape[1])
    low, high, count = _ranges(candidates, ids, queries)
    wanted = np.minimum(k, count)  # rank of the score still looked for, from the top of [low, high]
    above = np.zeros(len(ids), dtype=np.int64)  # scores known to lie above the stretch
    while True:
        open_ = np.flatnonzero((high > low) & (wanted > 0))
        if not len(open_):
            break
        # Distances of BIGINTs may need their 64th bit.
        span = high.view(np.uint64) - low.view(np.uint64)
        width = span // np.uint64(BINS) + np.uint64(1)
        counts = _histograms(candidates, ids[open_], queries[open_], low[open_], high[open_],
                             width[open_])
        from_top = np.cumsum(counts[:, ::-1], axis=1)
        place = (from_top >= (wanted - above)[open_, None]).argmax(axis=1)
        above[open_] += np.where(place > 0, from_top[np.arange(len(open_)), place - 1], 0)
        skipped = (BINS - 1 - place).astype(np.uint64) * width[open_]
        left = np.minimum(span[open_] - skipped, width[open_] - np.uint64(1))
        low[open_] = (low[open_].view(np.uint64) + skipped).view(np.int64)
        high[open_] = (low[open_].view(np.uint64) + left).view(np.int64)
    some = wanted > 0
    return _filtered(candidates, ids[some], queries[some], low[some], k)


def _scored(ids: np.ndarray, queries: np.ndarray, batches: Iterator[pa.RecordBatch]):
    """(row ids, scores of queries by rows, whether each pair may count), a block at a time."""
    largest = np.abs(queries.astype(float)).sum(axis=1).max(initial=0)
    for batch in batches:
        for at in range(0, batch.num_rows, ROW_BLOCK):
            part = batch.slice(at, ROW_BLOCK)
            rows = part.column("id").to_numpy(False)
            vectors = pc.list_flatten(part.column("vector")).to_numpy(False)
            vectors = vectors.reshape(part.num_rows, queries.shape[1])
            counts = ids[:, None] != rows[None, :]
            bound = largest * np.abs(vectors.astype(float)).max(axis=1, initial=0)
            if bound.max(initial=0) < EXACT:  # doubles hold every partial sum exactly
                scores = (queries.astype(float) @ vectors.T.astype(float)).astype(np.int64)
            else:
                scores = queries @ vectors.T
                for row in np.flatnonzero(bound >= FITS):
                    scores[:, row] = _checked(ids, queries, int(rows[row]), vectors[row],
                                              counts[:, row])
            yield rows, scores, counts


def _checked(ids: np.ndarray, queries: np.ndarray, row: int, vector: np.ndarray,
             counts: np.ndarray) -> list[int]:
    """Scores of a row whose products may pass 64 bits, in whole numbers of any size."""
    scores = [0] * len(ids)
    whole = vector.tolist()
    for query in np.flatnonzero(counts):
        score = sum(map(operator.mul, queries[query].tolist(), whole))
        if not -1 << 63 <= score < 1 << 63:
            raise OverflowError(f"the score of query {ids[query]} and row {row} is no BIGINT: {score}")
        scores[query] = score
    return scores


def _ranges(candidates: DataFrame, ids: np.ndarray, queries: np.ndarray):
    """Least and largest score and number of candidates of each query."""
    info = np.iinfo(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(len(ids), info.max), np.full(len(ids), info.min)
        count = np.zeros(len(ids), dtype=np.int64)
        for _, scores, counts in _scored(ids, queries, batches):
            low = np.minimum(low, np.where(counts, scores, info.max).min(axis=1))
            high = np.maximum(high, np.where(counts, scores, info.min).max(axis=1))
            count += counts.sum(axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(ids))), pa.array(low), pa.array(high), pa.array(count)],
            ["query", "low", "high", "n"])

    found = candidates.mapInArrow(run, "query bigint, low bigint, high bigint, n bigint").groupBy(
        "query").agg(F.min("low").alias("low"), F.max("high").alias("high"),
                     F.sum("n").alias("n")).toPandas().sort_values("query")
    out = [np.zeros(len(ids), dtype=np.int64) for _ in range(3)]
    for column, name in zip(out, ("low", "high", "n")):
        column[found["query"]] = found[name]
    return out


def _histograms(candidates: DataFrame, ids: np.ndarray, queries: np.ndarray, low: np.ndarray,
                high: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Number of scores in each of ``BINS`` bins from ``low`` on, for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids) * BINS, dtype=np.int64)
        first = (np.arange(len(ids)) * BINS)[:, None]
        for _, scores, counts in _scored(ids, queries, batches):
            inside = counts & (scores >= low[:, None]) & (scores <= high[:, None])
            apart = scores.view(np.uint64) - low.view(np.uint64)[:, None]
            bins = (apart // width[:, None]).view(np.int64) + first
            total += np.bincount(bins[inside], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bin", "n"])

    found = candidates.mapInArrow(run, "bin bigint, n bigint").groupBy("bin").agg(
        F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(ids) * BINS, dtype=np.int64)
    out[found.bin] = found.n
    return out.reshape(len(ids), BINS)


def _filtered(candidates: DataFrame, ids: np.ndarray, queries: np.ndarray, least: np.ndarray,
              k: int) -> DataFrame:
    """Ranked candidates whose score is not below the k-th."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ties: list[list[int]] = [[] for _ in ids]
        for rows, scores, counts in _scored(ids, queries, batches):
            query, row = np.nonzero(counts & (scores > least[:, None]))
            yield _answers(ids[query], rows[row], scores[query, row])
            query, row = np.nonzero(counts & (scores == least[:, None]))
            for q in np.unique(query):
                mine = rows[row[query == q]].tolist()
                ties[q] = sorted(ties[q] + mine)[:k]
        query = np.repeat(np.arange(len(ids)), [len(t) for t in ties])
        yield _answers(ids[query], np.array([x for t in ties for x in t], dtype=np.int64),
                       least[query])

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        candidates.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _answers(queries: np.ndarray, rows: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(queries), pa.array(rows), pa.array(scores)], ["query_id", "vec_id", "score"])
