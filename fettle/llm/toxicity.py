"""Toxic passages by maximum-scoring segments over token log-odds.

A token is a run of letters, digits and non-ASCII bytes, A-Z lower-cased. Its features are the
whole token and its prefixes of 4, 5 and 6 bytes, each hashed to one of ``BUCKETS`` numbers, so
every table here has a fixed size. Features count once per text, so a text that repeats one word
says no more than any other. A feature's weight is the lower end of the interval of its log-odds
ratio between toxic and clean labelled texts under a Dirichlet prior whose shape is the feature's
frequency over all documents; where that end is not positive the weight is zero. A token scores
the largest weight of its features minus ``drift``.

A linear scan finds all maximal-scoring segments of a text. Their scores are put on one scale for
texts of any length by the extreme-value law P(S <= s) = exp(-K n exp(-lambda s)), with lambda from
the token scores and K from the best segments of clean labelled texts; the surprise of the best
segment, minus the log of its p-value, is mapped to a probability by a logistic curve.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fettle.llm import words

BUCKETS = 1 << 20
PREFIXES = (4, 5, 6)
MAX_LABELLED = 200_000
MIN_TEXTS = 3  # toxic texts that must have a feature before it can weigh anything
MAX_SURPRISE = 60.0

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[:128] = True
SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by feature, and the calibration of segment scores."""

    buckets: np.ndarray  # features with a positive weight, ascending
    weights: np.ndarray
    drift: float
    rate: float  # lambda
    scale: float  # K
    slope: float
    offset: float

    def table(self) -> np.ndarray:
        table = np.zeros(BUCKETS, dtype=np.float32)
        table[self.buckets] = self.weights
        return table

    def surprise(self, best: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Minus the log of the chance of a segment as good in ``n`` clean tokens.

        Every text reaches a best score of zero, so nothing found is no surprise at any length.
        """
        expected = self.scale * n * np.exp(-self.rate * best)
        chance = np.where(best > 0, -np.expm1(-expected), 1.0)
        return np.clip(-np.log(np.maximum(chance, 1e-300)), 0, MAX_SURPRISE)

    def probability(self, surprise: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * surprise + self.offset)))


def held_out(id_column: Column) -> Column:
    """Whether a row's label must not be learnt from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 4 == 2, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id",
                 text_column: str = "text", label_column: str = "toxic",
                 prior: float = 10.0, z: float = 2.0, drift: float = 0.5,
                 max_labelled: int = MAX_LABELLED) -> ToxicityModel:
    """Learn from the labelled rows that are not held out; the prior counts all documents.

    At most about ``max_labelled`` labelled rows are used, drawn by a hash of their id; only that
    many labels and document scores ever reach one machine. Labels other than 0 and 1, null ids
    and labels of unknown documents are ignored; of repeated labels the larger counts. Without
    labelled rows of both kinds, or a feature that weighs anything, nothing is found in any text
    and every text scores the share of label 1 among the rows learnt from, 0 if there are none.
    """
    key = F.col(id_column)
    usable = labels.where(
        key.isNotNull() & F.col(label_column).isin(0, 1) & ~held_out(key)
    ).groupBy(key.alias("id")).agg(F.max(label_column).cast("int").alias("label"))
    share = min(1.0, max_labelled / max(1, usable.count()))
    sample = usable.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))

    texts = docs.select(key.alias("id"), F.col(text_column).alias("text")).join(
        F.broadcast(sample), "id", "left")
    labelled = texts.where("label is not null").select("text", "label")
    sizes = texts.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("toxic"),
        F.count_if(F.col("label") == 0).alias("clean"),
    ).first()

    every = np.ones(BUCKETS, dtype=bool)
    every[-1] = False
    wanted = _texts_with(labelled.where("label = 1"), every)[0] >= MIN_TEXTS
    counts = _texts_with(texts, wanted)
    weights = _weights(counts, sizes.toxic, sizes.clean, sizes.n, prior, z)
    known = np.flatnonzero(weights)
    raw = ToxicityModel(known, weights[known], drift, 1.0, 1.0, 1.0, 0.0)

    scored = labelled.mapInArrow(_best_segments(raw), "label int, n bigint, best double, "
                                 "bins array<bigint>, mass array<bigint>").toPandas()
    return _calibrated(raw, scored)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id",
                   text_column: str = "text", significance: float = 0.05) -> DataFrame:
    """(id, score, found, n_segments, segments) for every row of ``docs``.

    ``score`` is a probability, ``found`` whether any token of the text speaks for toxicity; a text
    with nothing found scores what such texts do among the labelled ones, be it much or little.

    ``segments`` lists the passages whose best score would turn up by chance in a share of at most
    ``significance`` of clean texts of that length: first and last byte (exclusive) of the UTF-8
    text, and segment score. Null, empty and word-free texts have no segment and score as a text
    in which nothing was found.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    scored = texts.mapInArrow(
        _scorer(model, -np.log(significance)),
        f"id {kind}, score double, found boolean, "
        "segments array<struct<begin:bigint,end:bigint,score:double>>",
    )
    return scored.select(
        F.col("id").alias(id_column), "score", "found", F.size("segments").alias("n_segments"),
        "segments"
    )


def keep_below(docs: DataFrame, model: ToxicityModel, threshold: float,
               text_column: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay.

    A text in which nothing was found stays whatever its score.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in words.slices(batches, text_column):
            best, n, _ = _best(batch.column(text_column), model, table)
            score = model.probability(model.surprise(best, n))
            yield batch.filter(pa.array((score < threshold) | (best <= 0)))

    return docs.mapInArrow(run, docs.schema)


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature buckets of each token (-1: none), first token of each text, token spans."""
    data, offsets = words.buffers(texts)
    data = words.LOWER[data]
    starts, ends, first = words.spans(data, offsets, SEPARATOR)
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    out = np.empty((1 + len(PREFIXES), len(starts)), dtype=np.int64)
    out[0] = (words.span_hashes(data, starts, ends) >> shift).view(np.int64)
    for row, size in enumerate(PREFIXES, 1):
        long = np.flatnonzero(ends - starts > size)
        cut = words.span_hashes(data, starts[long], starts[long] + size)
        out[row] = -1
        out[row, long] = (words.mix(cut + np.uint64(size)) >> shift).view(np.int64)
    return out, first, starts, ends


def _presence(features: np.ndarray, first: np.ndarray,
              wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) for every wanted feature a text has, each once per kind of feature."""
    text = np.repeat(np.arange(len(first) - 1, dtype=np.int64), np.diff(first))
    pairs = []
    for row in features:
        keep = wanted[row]  # -1 reads the last flag, which is never wanted
        pairs.append(np.unique(text[keep] * BUCKETS + row[keep]))
    found = np.concatenate(pairs)
    return found // BUCKETS, found % BUCKETS


def _texts_with(texts: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """Texts that have each wanted feature: toxic ones, clean ones, and all."""
    flags = np.packbits(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.unpackbits(flags).astype(bool)
        total = np.zeros((3, BUCKETS), dtype=np.int64)
        for batch in words.slices(batches):
            features, first, _, _ = _features(batch.column("text"))
            text, feature = _presence(features, first, keep)
            label = batch.column("label").fill_null(-1).to_numpy(False)[text]
            for row, chosen in enumerate((label == 1, label == 0, slice(None))):
                total[row] += np.bincount(feature[chosen], minlength=BUCKETS)
        seen = np.flatnonzero(total[2])
        for at in range(0, len(seen), 100_000):
            part = seen[at:at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), *(pa.array(row[part]) for row in total)],
                ["bucket", "toxic", "clean", "n"])

    found = texts.select("text", "label").mapInArrow(
        run, "bucket int, toxic bigint, clean bigint, n bigint"
    ).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "n")]).toPandas()
    out = np.zeros((3, BUCKETS), dtype=np.int64)
    for row, name in enumerate(("toxic", "clean", "n")):
        out[row, found.bucket] = found[name]
    return out


def _weights(counts: np.ndarray, toxic: int, clean: int, everything: int, prior: float,
             z: float) -> np.ndarray:
    """Lower ends of the features' log-odds ratios, zero where not positive."""
    out = np.zeros(BUCKETS)
    seen = np.flatnonzero(counts[0])
    if toxic and clean and len(seen):
        y1, y0, n = counts[:, seen]
        alpha = np.maximum(prior * n / everything, 0.5)
        whole = prior + 1
        ratio = (np.log((y1 + alpha) / (toxic + whole - y1 - alpha))
                 - np.log((y0 + alpha) / (clean + whole - y0 - alpha)))
        out[seen] = np.maximum(0, ratio - z * np.sqrt(1 / (y1 + alpha) + 1 / (y0 + alpha)))
    return out


def _token_scores(features: np.ndarray, table: np.ndarray, drift: float) -> np.ndarray:
    best = table[features[0]]
    for row in features[1:]:
        best = np.maximum(best, np.where(row >= 0, table[row], 0))
    best[1:][features[0][1:] == features[0][:-1]] = 0  # a token said again right away adds nothing
    return best.astype(np.float64) - drift


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last exclusive, score), in one linear scan.

    Only positive scores can begin or end a segment, so the scan visits those and reads the sums
    between them from the running total.
    """
    total = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[tuple[int, int, float, float, int]] = []  # first, last, left, right, lower
    for at in np.flatnonzero(scores > 0).tolist():
        first, last, left, right = at, at + 1, total[at], total[at + 1]
        while True:
            lower = len(found) - 1
            while lower >= 0 and found[lower][2] >= left:
                lower = found[lower][4]
            if lower < 0 or found[lower][3] >= right:
                found.append((first, last, left, right, lower))
                break
            first, left = found[lower][0], found[lower][2]
            del found[lower:]
    return [(first, last, right - left) for first, last, left, right, _ in found]


def _segments(texts: pa.Array, table: np.ndarray, drift: float):
    """Segments of the texts that have a positive token; token scores, first tokens, spans."""
    features, first, starts, ends = _features(texts)
    scores = _token_scores(features, table, drift)
    hits = np.concatenate(([0], np.cumsum(scores > 0)))
    some = np.flatnonzero(hits[first[1:]] > hits[first[:-1]])
    found = {i: maximal_segments(scores[first[i]:first[i + 1]]) for i in some.tolist()}
    return found, scores, first, starts, ends


def _best(texts: pa.Array, model: ToxicityModel, table: np.ndarray):
    """Best segment score and number of tokens of each text, and what they were found from."""
    found = _segments(texts, table, model.drift)
    best = np.zeros(len(texts))
    for i, segments in found[0].items():
        best[i] = max(score for _, _, score in segments)
    return best, np.maximum(np.diff(found[2]), 1), found


def _best_segments(model: ToxicityModel):
    """Per labelled text: label, tokens, best segment; and the score histogram of clean texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in words.slices(batches):
            best, n, (_, scores, first, _, _) = _best(batch.column("text"), model, table)
            label = batch.column("label").to_numpy(False)
            clean = np.repeat(label == 0, np.diff(first))
            bins, mass = np.unique(np.rint(scores[clean] * 10).astype(np.int64),
                                   return_counts=True)
            empty = [[]] * (batch.num_rows - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(n), pa.array(best),
                 pa.array([bins.tolist(), *empty], pa.list_(pa.int64())),
                 pa.array([mass.tolist(), *empty], pa.list_(pa.int64()))],
                ["label", "n", "best", "bins", "mass"])

    return run


def _calibrated(raw: ToxicityModel, scored) -> ToxicityModel:
    clean = scored[scored.label == 0]
    if not len(raw.weights):  # so too without one of the labels
        share = float(scored.label.mean()) if len(scored) else 0.0
        with np.errstate(divide="ignore"):
            offset = float(np.log(share) - np.log1p(-share))
        return ToxicityModel(raw.buckets, raw.weights, raw.drift, 1.0, 1.0, 0.0, offset)
    bins = np.concatenate(scored.bins.to_list()).astype(float) / 10
    mass = np.concatenate(scored.mass.to_list()).astype(float)
    top = float(raw.weights.max()) - raw.drift
    bins, mass = np.append(bins, top), np.append(mass, 1.0)  # one pseudo-token: a rate exists
    low, high = 1e-6, 1.0
    growth = lambda rate: float((mass * np.exp(np.minimum(rate * bins, 700))).sum() / mass.sum())
    while growth(high) < 1 and high < 1e3:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if growth(middle) < 1 else (low, middle)
    n = clean.n.to_numpy(float)
    scale = len(clean) / max(1e-12, float((n * np.exp(-high * clean.best.to_numpy(float))).sum()))
    model = ToxicityModel(raw.buckets, raw.weights, raw.drift, high, scale, 1.0, 0.0)
    x = model.surprise(scored.best.to_numpy(float), scored.n.to_numpy(float))
    slope, offset = _logistic(x, scored.label.to_numpy(float))
    return ToxicityModel(raw.buckets, raw.weights, raw.drift, high, scale, slope, offset)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope (not negative) and offset of a ridge logistic curve, by Newton steps."""
    theta = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(design @ theta)))
        gradient = design.T @ (p - y) + ridge * np.array([theta[0], 0.01 * theta[1]])
        weight = np.maximum(p * (1 - p), 1e-6)
        hessian = (design * weight[:, None]).T @ design + ridge * np.diag([1.0, 0.01])
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
        theta -= step
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(theta[0])), float(theta[1])


def _scorer(model: ToxicityModel, threshold: float):
    kind = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in words.slices(batches):
            texts = batch.column("text")
            best, n, (found, _, first, starts, ends) = _best(texts, model, table)
            offsets = words.buffers(texts)[1]
            passages = [[] for _ in range(batch.num_rows)]
            for i, segments in found.items():
                odd = model.surprise(np.array([s for _, _, s in segments]), n[i]) >= threshold
                passages[i] = [
                    {"begin": int(starts[first[i] + a] - offsets[i]),
                     "end": int(ends[first[i] + b - 1] - offsets[i]), "score": float(s)}
                    for (a, b, s), keep in zip(segments, odd) if keep
                ]
            score = model.probability(model.surprise(best, n))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(score), pa.array(best > 0),
                 pa.array(passages, pa.list_(kind))],
                ["id", "score", "found", "segments"])

    return run
