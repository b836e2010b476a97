"""Repeated passages by MinHash banding over paragraphs.

A paragraph is a line; a line of more than ``LONG_LINE`` words, into which a passage may have been
set, is read as its sentences. Paragraphs with equal word sequences are one node. Nodes that agree
in a band of min-hashes collide; ``bands_for`` finds the number of bands that misses a pair at the
threshold with at most a given probability. Collisions are confirmed on the full shingle sets,
and all links of a component make one cluster, of which the first occurrence stays.

What repeats under other line breaks or stops, or in lines and sentences too short for a paragraph,
is found as runs: ``RUN`` neighbouring words, wherever lines end. Of every ``ANCHORS`` runs in a row
the one with the least hash counts, so equal stretches have equal runs, and one of at least
``RUN + ANCHORS - 1`` words always has some, which leave at most ``ANCHORS - 1`` words at either end.
Runs of equal words are a cluster; those that the paragraphs remove already are not counted again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.llm import words
from fettle.llm.components import components
from fettle.llm.neardup import (
    SKETCH, _marked, across, flagged, likely, shared_buckets, similar, sketches,
)
from fettle.shared import cut, for_now, remove_folder, write_table

LONG_LINE = 25
RUN = 16
ANCHORS = 8  # a power of two
SKETCHED = 48  # min-hashes of the paragraphs that collide

STOP = np.zeros(256, dtype=bool)
STOP[[ord(c) for c in ".!?"]] = True


def bands_for(similarity: float, miss: float, rows: int) -> int:
    """Bands of ``rows`` hashes that miss a pair of this similarity at most so often."""
    return math.ceil(math.log(miss) / math.log(1 - similarity**rows))


def repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                      shingle_words: int = 5, similarity: tuple[int, int] = (80, 100),
                      min_words: int = 8, rows: int = 2, miss: float = 5e-4) -> DataFrame:
    """(id, passage, begin, end, n_words, keep_id, keep_passage, removed): paragraphs and runs.

    One row for each paragraph whose cluster has at least two occurrences, in one text or several,
    and for each run that still has two after the removal of paragraphs. A run's ``passage`` is its
    first word's number plus the number of paragraphs, so they never meet; runs may overlap.
    ``passage`` is its number in the text, from 0, ``begin`` and ``end`` its bytes. The occurrence
    with the smallest (id, passage), null ids last, stays; the others have ``removed``. Words are
    runs without ASCII white space, A-Z lower-cased; paragraphs under ``min_words`` words are
    looked at in runs only, which are whole texts where those have ``min_words`` to ``RUN`` words. Null and empty texts have no paragraphs. Rows that repeat an id have equal places,
    so a repeated row that holds the first occurrence keeps it in each copy.
    """
    if min_words < shingle_words:
        raise ValueError("paragraphs need at least as many words as a shingle")
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"),
                        F.xxhash64(F.col(text_column).cast("string")).alias("t"))
    bands = bands_for(similarity[0] / similarity[1], miss, rows)

    keyed, keyed_path = write_table(texts.select("text").mapInArrow(
        _keys(shingle_words, min_words, bands, rows), "rep binary, keys array<bigint>"))
    buckets = shared_buckets(keyed.select("rep", F.explode("keys").alias("key")))
    remove_folder(docs.sparkSession, keyed_path)  # every paragraph has a key per band in it
    asked = cut(buckets.select("rep").union(buckets.select("leader")).distinct())
    every = texts.select("text").mapInArrow(_units(min_words), "rep binary, text binary")
    # Not left_semi: that would be moved below the bitmaps, and all rows with it.
    sets = cut(
        _marked(every, asked, ["rep"]).join(asked, "rep").groupBy("rep")
        .agg(F.first("text").alias("text")).mapInArrow(
            _sets(shingle_words, min_words, bands, rows),
            "rep binary, n bigint, bands array<bigint>, s0 bigint, s1 bigint, s2 bigint, "
            "shingles array<bigint>")
    )
    stars = likely(buckets.select(F.col("leader").alias("a"), F.col("rep").alias("b")), sets,
                   similarity)
    links = cut(similar(stars, sets, similarity))
    found = cut(components(links, "a", "b"))
    found = across(buckets, sets, found, similarity,
                   lambda asked: sets.select("rep", "shingles").join(asked, "rep", "left_semi"),
                   _first_band)

    places = texts.mapInArrow(
        _places(min_words), f"id {kind}, t bigint, passage bigint, at bigint, begin bigint, "
        "end bigint, n_words bigint, rep binary")
    here = F.struct(F.col("id").isNull().alias("unnamed"), "id", "passage")
    with for_now(places) as places:
        kinds = places.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), F.min(here).alias("keep"))
        kinds = cut(
            kinds.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
            .where("n > 1 or component is not null")
            .select("rep", "n", "keep", F.coalesce("component", "rep").alias("cluster"))
        )
        clusters = kinds.groupBy("cluster").agg(F.sum("n").alias("n"), F.min("keep").alias("keep"))
        chosen = kinds.select("rep", "cluster").join(clusters.where("n > 1"), "cluster")
        held = flagged(places, kinds, ["rep"], "held").where("held").drop("held")
        clustered = cut(held.join(chosen.select("rep", "keep"), "rep").withColumn(
            "removed", ~here.eqNullSafe(F.col("keep"))))

    # Both uses of the runs are of one exchange, by the words that make a group.
    runs = _left_over(texts, clustered.where("removed"), kind, min_words).repartition("u", "v")
    again = runs.groupBy("u", "v").agg(F.count(F.lit(1)).alias("n"), F.min(here).alias("keep"))
    runs = runs.join(again.where("n > 1").hint("merge"), ["u", "v"]).withColumn(
        "removed", ~here.eqNullSafe(F.col("keep")))
    columns = [
        F.col("id").alias(id_column), "passage", "begin", "end", "n_words",
        F.col("keep.id").alias("keep_id"), F.col("keep.passage").alias("keep_passage"), "removed",
    ]
    return clustered.select(*columns).union(runs.select(*columns))


def _left_over(texts: DataFrame, removed: DataFrame, kind: str, min_words: int) -> DataFrame:
    """Runs that may occur twice and have a word outside of the ``removed`` paragraphs.

    Some that occur once are among them: bits are all that is known of the others' names.
    """
    every = texts.mapInArrow(
        _runs(min_words), f"u bigint, v bigint, id {kind}, t bigint, passage bigint, at bigint, "
        "begin bigint, end bigint, n_words bigint, one bigint, two bigint")
    names = texts.select("text").mapInArrow(_run_names(min_words), "u bigint")
    twice = cut(names.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u"))
    removed = removed.select("id", "t", F.col("passage").alias("one")).distinct()
    # Only a run that begins in a removed paragraph may go; the others do not move to find out.
    runs = cut(flagged(_marked(every, twice, ["u"]), removed, ["id", "t", "one"], "maybe"))
    maybe = F.col("maybe") & (F.col("one") >= 0)
    # A run lies in at most RUN paragraphs: it goes if all of them are removed.
    over = runs.where(maybe).select("id", "t", "one", "two").distinct()
    each = over.select(F.col("id").alias("g_id"), F.col("t").alias("g_t"), F.col("one").alias("g_one"),
                       "two", F.explode(F.sequence("one", "two")).alias("each"))
    gone = each.join(removed, F.col("id").eqNullSafe(F.col("g_id")) & (F.col("t") == F.col("g_t"))
                     & (F.col("one") == F.col("each"))).groupBy(
        "g_id", "g_t", "g_one", F.col("two").alias("g_two")).agg(
        F.count(F.lit(1)).alias("n")).where("n = g_two - g_one + 1")
    left = runs.where(maybe).join(gone, F.col("id").eqNullSafe(F.col("g_id")) & (
        F.col("t") == F.col("g_t")) & (F.col("one") == F.col("g_one")) & (
        F.col("two") == F.col("g_two")), "left_anti")
    return runs.where(~maybe).union(left).drop("one", "two", "maybe")


class Paragraphs:
    """The paragraphs of some texts that have at least ``min_words`` words."""

    def __init__(self, texts: pa.Array, min_words: int) -> None:
        data, offsets = words.buffers(texts)
        lower = words.LOWER[data]
        starts, ends, first = words.spans(lower, offsets)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        self.hashes = words.span_hashes(lower, starts, ends)
        line = np.concatenate(([0], np.cumsum(data == 10)))[starts] if len(starts) else starts
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
        lines = np.flatnonzero(new)
        long = np.diff(np.append(lines, len(starts))) > LONG_LINE
        in_long = np.repeat(long, np.diff(np.append(lines, len(starts))))
        stop = np.zeros(len(starts), dtype=bool)
        stop[1:] = STOP[lower[ends[:-1] - 1]] if len(starts) else stop[1:]
        begin = np.flatnonzero(new | in_long & stop)
        count = np.diff(np.append(begin, len(starts)))
        owner = text[begin]
        number = np.arange(len(begin)) - np.searchsorted(owner, owner)
        self.total = np.bincount(owner, minlength=len(offsets) - 1)
        self.starts, self.ends, self.offsets, self.words = starts, ends, offsets, first
        self.lower = lower
        keep = np.flatnonzero(count >= min_words)
        self.first, self.count, self.text = begin[keep], count[keep], owner[keep]
        self.number = number[keep]
        self.begin = starts[self.first] - offsets[self.text]
        self.end = ends[self.first + self.count - 1] - offsets[self.text]

    def names(self) -> np.ndarray:
        """128 bits that name each word sequence, as rows of two numbers."""
        size = int(self.count.sum())
        inside = np.arange(size) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        word = self.hashes[np.repeat(self.first, self.count) + inside]
        step = words.mix((inside + 1).astype(np.uint64) * words.BASE)
        edges = np.cumsum(self.count) - self.count
        out = np.zeros((len(self.count), 2), dtype=np.uint64)
        if size:
            out[:, 0] = words.mix(np.add.reduceat(words.mix(word ^ step), edges))
            out[:, 1] = words.mix(np.add.reduceat(words.mix(word + step), edges))
        return out

    def over(self, at: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the first and the last paragraph of stretches that lie in paragraphs, or -1."""
        edges = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        edges[self.first] += 1
        edges[self.first + self.count] -= 1
        inside = np.concatenate(([0], np.cumsum(np.cumsum(edges[:-1]))))
        whole = inside[at + count] - inside[at] == count
        number = np.append(self.number, -1)
        return tuple(np.where(whole, number[np.searchsorted(self.first, word, "right") - 1], -1)
                     for word in (at, at + count - 1))

    def once(self) -> np.ndarray:
        """Names of the distinct paragraphs; first and count are theirs from now on."""
        names = self.names()
        _, at = np.unique(names.view("V16").ravel(), return_index=True)
        self.first, self.count = self.first[at], self.count[at]
        return names[at]

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Shingles of each paragraph, in order and perhaps repeated, and where each begins."""
        whole = np.zeros(max(0, len(self.hashes) - size + 1), dtype=np.uint64)
        for k in range(size):
            whole = words.mix(whole ^ self.hashes[k:k + len(whole)]) + np.uint64(k + 1)
        each = self.count - size + 1
        begin = np.concatenate(([0], np.cumsum(each)))
        inside = np.arange(int(begin[-1])) - np.repeat(begin[:-1], each)
        return whole[np.repeat(self.first, each) + inside], begin


def runs(hashes: np.ndarray, first: np.ndarray, min_words: int):
    """(text, first word, words, two hashes) of the runs that count, in order.

    ``hashes`` are those of the words, ``first`` is the first word of each text. Of runs of one
    text with equal words none overlap.
    """
    size = np.diff(first)
    text = np.repeat(np.arange(len(size)), size)
    u, v = hashes, words.mix(hashes ^ words.BASE)
    width = 1
    while width < RUN:
        u, v = (words.mix(x[:-width] * words.BASE ^ x[width:]) + np.uint64(width) for x in (u, v))
        width *= 2
    least = u
    width = 1
    while width < ANCHORS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    chosen = np.zeros(len(u), dtype=bool)
    windows = np.flatnonzero(text[:len(least)] == text[RUN + ANCHORS - 2:])
    for k in range(ANCHORS):
        chosen[windows[u[windows + k] == least[windows]] + k] = True
    whole = []
    for i in np.flatnonzero((size >= min_words) & (size < RUN + ANCHORS - 1)).tolist():
        if size[i] < RUN:
            whole.append(i)
        else:
            own = slice(first[i], first[i + 1] - RUN + 1)
            chosen[own] |= u[own] == u[own].min()
    at = np.flatnonzero(chosen)
    order = np.lexsort((at, u[at], text[at]))
    at = at[order]
    same = np.zeros(len(at), dtype=bool)
    same[1:] = (u[at[1:]] == u[at[:-1]]) & (text[at[1:]] == text[at[:-1]])
    keep = np.ones(len(at), dtype=bool)
    last = 0
    for k in np.flatnonzero(same).tolist():
        last = last if k and same[k - 1] else k - 1
        keep[k] = at[k] - at[last] >= RUN
        last = k if keep[k] else last
    at = np.sort(at[keep])
    short = np.array(whole, dtype=np.int64)
    names = np.zeros((2, len(short)), dtype=np.uint64)
    for k, i in enumerate(whole):
        for row, salt in enumerate((np.uint64(0), words.BASE)):
            value = np.array([size[i]], dtype=np.uint64)
            own = words.mix(hashes[first[i]:first[i + 1]] ^ salt)
            for step in range(size[i]):
                value = words.mix(words.mix(value * words.BASE) ^ own[step:step + 1])
            names[row, k] = value[0]
    return (np.concatenate((text[at], short)), np.concatenate((at, first[short])),
            np.concatenate((np.full(len(at), RUN), size[short])),
            np.concatenate((u[at], names[0])), np.concatenate((v[at], names[1])))


def _run_names(min_words: int):
    """The first hash of each run of ``_runs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            *_, u, _ = runs(*words.word_hashes(batch.column("text")), min_words)
            yield pa.RecordBatch.from_arrays([words.signed(u)], ["u"])

    return run


def _runs(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            found = Paragraphs(batch.column("text"), min_words)
            text, at, count, u, v = runs(found.hashes, found.words, min_words)
            which = pa.array(text)
            inside = at - found.words[text]
            yield pa.RecordBatch.from_arrays(
                [words.signed(u), words.signed(v), batch.column("id").take(which),
                 batch.column("t").take(which), pa.array(found.total[text] + inside),
                 pa.array(inside), pa.array(found.starts[at] - found.offsets[text]),
                 pa.array(found.ends[at + count - 1] - found.offsets[text]), pa.array(count),
                 *map(pa.array, found.over(at, count))],
                ["u", "v", "id", "t", "passage", "at", "begin", "end", "n_words", "one", "two"])

    return run


def _binary(names: np.ndarray) -> pa.Array:
    """Names as Spark's BINARY."""
    fixed = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(16), len(names), [None, pa.py_buffer(np.ascontiguousarray(names).tobytes())])
    return fixed.cast(pa.binary())


def _first_band(bands: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Key of the first band that agrees."""
    first = agree.argmax(axis=1)
    salt = words.mix((first + 1).astype(np.uint64) * words.BASE)
    return words.mix(bands[np.arange(len(bands)), first] ^ salt)


def _keys(size: int, min_words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = words.mix(np.arange(1, bands + 1, dtype=np.uint64) * words.BASE)
        for batch in words.slices(batches):
            found = Paragraphs(batch.column("text"), min_words)
            names = found.once()  # a paragraph that recurs in these texts is sent once
            shingles, begin = found.shingles(size)
            minima = words.min_hashes(shingles, begin, bands * rows)
            keys = words.mix(words.band_values(minima, bands, rows) ^ salts)
            ends = pa.array(np.arange(len(names) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [_binary(names), pa.ListArray.from_arrays(ends, words.signed(keys.ravel()))],
                ["rep", "keys"])

    return run


def _units(min_words: int):
    """The paragraphs as texts, which have no other paragraph."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            found = Paragraphs(batch.column("text"), min_words)
            names, lower = found.once(), found.lower.tobytes()  # lower-case names the same words
            begin, end = found.starts[found.first], found.ends[found.first + found.count - 1]
            own = pa.array([lower[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([_binary(names), own], ["rep", "text"])

    return run


def _sets(size: int, min_words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            found = Paragraphs(batch.column("text"), min_words)
            names = found.names()
            shingles, begin = found.shingles(size)
            minima = words.min_hashes(shingles, begin, max(SKETCHED, bands * rows))
            which = np.repeat(np.arange(len(names)), np.diff(begin))
            order = np.lexsort((shingles, which))
            shingles, which = shingles[order], which[order]
            distinct = np.ones(len(shingles), dtype=bool)
            distinct[1:] = (shingles[1:] != shingles[:-1]) | (which[1:] != which[:-1])
            n = np.bincount(which[distinct], minlength=len(names))
            ends = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
            values = words.band_values(minima, bands, rows)
            yield pa.RecordBatch.from_arrays(
                [_binary(names), pa.array(n),
                 pa.ListArray.from_arrays(
                     pa.array(np.arange(len(names) + 1, dtype=np.int32) * bands),
                     words.signed(values.ravel())),
                 *map(words.signed, sketches(minima[:, :SKETCHED])),
                 pa.ListArray.from_arrays(pa.array(ends), words.signed(shingles[distinct]))],
                ["rep", "n", "bands", *SKETCH, "shingles"])

    return run


def _places(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            found = Paragraphs(batch.column("text"), min_words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(found.text)),
                 batch.column("t").take(pa.array(found.text)), pa.array(found.number),
                 pa.array(found.first - found.words[found.text]), pa.array(found.begin), pa.array(found.end), pa.array(found.count),
                 _binary(found.names())],
                ["id", "t", "passage", "at", "begin", "end", "n_words", "rep"])

    return run
