"""Which terms set a source apart from its language, and how far sources are from each other.

Strings are materialized late. What is counted and shuffled are 64-bit digests of terms. One more
aggregation finds the smallest and the largest string of every digest that may be kept: if they
differ, terms have collided, and those digests are counted anew, split by their strings. Texts of
terms are joined back for the rows that are returned only.

Terms are compared by their shares p in whole billionths. A term that a source lacks has the same
share as all others it lacks, so the sum over all terms starts from that value for every pair of
sources. Corrections for terms one source has come from a histogram of its shares, and those for
terms both have from blocks of terms, in which at most ``2 * TILE`` sources meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fettle.llm import words
from fettle.operators.ordered import ordinals
from fettle.shared import cut

WHOLE = 1_000_000_000  # shares are in billionths
PLAIN = 9_000_000_000  # counts whose product with WHOLE is a BIGINT
TILE = 128  # sources of either side that are compared in one task
ROWS = 1 << 16  # rows of a block of terms
CELLS = 1 << 20  # terms times sources compared at a time

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[:128] = True
SEPARATOR[[*range(65, 91), *range(97, 123)]] = False

TERM = ["lang", "digest", "term"]
GROUP = ["lang", "source"]


def source_divergence(docs: DataFrame, text_column: str = "text", lang_column: str = "lang",
                      source_column: str = "source", least_docs: int = 3, top: int = 200,
                      digest_bits: int = 64) -> DataFrame:
    """(lang, source, part, item, value, rank): what sets each source of a language apart.

    Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased; a language keeps
    its V terms that are in at least ``least_docs`` of its documents. A group, that is a source or
    the whole language, gives a kept term the share p = 1 + floor(10^9 (count + 1) / (N + V)), N
    being its occurrences of kept terms. The divergence of p from q is floor((p - q)^2 / q).

    ``part`` is ``pair``: the item is another source of the language, q its share, the value the
    divergence summed over all kept terms, 0 if there is none. Or it is ``term``: the item is a
    kept term that the source has and has more of than its language, q that of the language; the
    first ``top`` are returned. Ranks count from 1 by falling value, then rising item in UTF-8.

    Null texts, languages and sources count as empty; empty names are names like any other. A
    source without terms is compared all the same, and one alone in its language has no pairs.
    Repeated rows are documents of their own. Other columns are ignored. ``digest_bits`` shortens
    the digests, for tests of collisions; results are the same for any.
    """
    texts = docs.select(*[
        F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name)
        for column, name in ((lang_column, "lang"), (source_column, "source"), (text_column, "text"))])
    shift = 64 - digest_bits
    counts = cut(
        texts.mapInArrow(_counter(shift), "lang string, source string, digest bigint, n bigint, "
                                          "docs bigint")
        .groupBy(*GROUP, "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    strings = cut(_strings(texts, counts, least_docs, shift))
    facts = cut(_facts(texts, counts, strings, least_docs, shift))
    sizes = cut(_sizes(texts, facts))

    shares = facts.join(sizes, GROUP).select(
        *GROUP, "digest", "term", "number", "first_tile", "last_tile", "zero",
        _share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"))
    found = _pairs(shares, sizes).unionByName(_terms(shares, strings, top))
    return found.select(*GROUP, "part", "item", "value", "rank")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(WHOLE (count + 1) / (total + terms)); in decimals only where BIGINT is too small."""
    whole = F.lit(WHOLE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    wide = F.call_function("div", whole, (total + terms).cast("decimal(20,0)"))
    plain = F.call_function("div", F.lit(WHOLE).cast("bigint") * (count + 1), total + terms)
    return F.lit(1).cast("bigint") + F.when(count < PLAIN, plain).otherwise(wide)


def _apart(p: Column, q: Column) -> Column:
    """The divergence of p from q; both are below 2**31, so their squares fit."""
    return F.call_function("div", (p - q) * (p - q), q)


def _spans(batch: pa.RecordBatch, shift: int):
    """(bytes, begin, end, text, digest) of all terms of a batch."""
    data, offsets = words.buffers(batch.column("text"))
    data = words.LOWER[data]
    starts, ends, first = words.spans(data, offsets, SEPARATOR)
    text = np.repeat(np.arange(batch.num_rows), np.diff(first))
    digest = words.span_hashes(data, starts, ends) >> np.uint64(shift)
    return data, starts, ends, text, digest


def _counter(shift: int):
    """Per group and digest: occurrences and documents, of one slice of texts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            _, _, _, text, digest = _spans(batch, shift)
            groups, names = _groups(batch)
            group = groups[text]
            order = np.lexsort((text, digest, group))
            group, digest, text = group[order], digest[order], text[order]
            new_key = np.ones(len(order), dtype=bool)
            new_key[1:] = (group[1:] != group[:-1]) | (digest[1:] != digest[:-1])
            new_doc = new_key.copy()
            new_doc[1:] |= text[1:] != text[:-1]
            begin = np.flatnonzero(new_key)
            docs = np.add.reduceat(new_doc.astype(np.int64), begin) if len(begin) else begin
            chosen = pa.array(names[group[begin]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(chosen), batch.column("source").take(chosen),
                 words.signed(digest[begin]), pa.array(np.diff(np.append(begin, len(order)))),
                 pa.array(docs)], ["lang", "source", "digest", "n", "docs"])

    return run


def _groups(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Number of the (lang, source) of each row, and a row of each number."""
    lang, source = (batch.column(c).dictionary_encode().indices.to_numpy(False).astype(np.int64)
                    for c in GROUP)
    _, rows, numbers = np.unique(lang * (batch.num_rows + 1) + source, return_index=True,
                                 return_inverse=True)
    return numbers, rows


def _namer(shift: int):
    """Digests and their strings, each once per slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            data, starts, ends, _, digest = _spans(batch, shift)
            chosen = _distinct(data, starts, ends, digest)
            yield pa.RecordBatch.from_arrays(
                [words.signed(digest[chosen]), _taken(data, starts[chosen], ends[chosen])],
                ["digest", "term"])

    return run


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
              digest: np.ndarray) -> np.ndarray:
    """One span per digest, and every span whose bytes differ from those of that one."""
    order = np.argsort(digest, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = digest[order][1:] != digest[order][:-1]
    leads = order[new]
    lead = leads[np.cumsum(new) - 1]  # in the order of ``order``
    size, lead_size = ends[order] - starts[order], ends[lead] - starts[lead]
    unlike = size != lead_size
    same = np.flatnonzero(~unlike & ~new)
    if len(same):
        many = size[same]
        stop = np.cumsum(many)
        within = np.arange(int(stop[-1])) - np.repeat(stop - many, many)
        differs = (data[within + np.repeat(starts[order][same], many)]
                   != data[within + np.repeat(starts[lead][same], many)])
        unlike[same] = np.logical_or.reduceat(differs, stop - many)
    return np.concatenate([leads, order[unlike]])


def _taken(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as strings."""
    size = ends - starts
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    chars = data[np.arange(total) + np.repeat(starts - (stop - size), size)]
    offsets = np.concatenate(([0], stop)).astype(np.int32)
    return pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(chars.tobytes()))


def _strings(texts: DataFrame, counts: DataFrame, least: int, shift: int) -> DataFrame:
    """(digest, low, high): smallest and largest string of each digest that may be kept."""
    wanted = counts.groupBy("lang", "digest").agg(F.sum("docs").alias("docs")).where(
        F.col("docs") >= least).select("digest").distinct()
    named = texts.select("text").mapInArrow(_namer(shift), "digest bigint, term string")
    return named.groupBy("digest").agg(
        F.min("term").alias("low"), F.max("term").alias("high")
    ).join(wanted, "digest", "left_semi")


def _splitter(shift: int):
    """Counts per group, digest and string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            data, starts, ends, text, digest = _spans(batch, shift)
            terms = _taken(data, starts, ends)
            table = pa.table({"text": text, "digest": words.signed(digest), "term": terms})
            table = table.group_by(["text", "digest", "term"]).aggregate([([], "count_all")])
            rows = table.column("text").combine_chunks()
            yield from pa.table({
                "lang": batch.column("lang").take(rows), "source": batch.column("source").take(rows),
                "digest": table.column("digest"), "term": table.column("term"),
                "n": table.column("count_all"), "docs": pa.array(np.ones(len(rows), np.int64)),
            }).to_batches()

    return run


def _facts(texts: DataFrame, counts: DataFrame, strings: DataFrame, least: int,
           shift: int) -> DataFrame:
    """Occurrences of kept terms by group, with those in the language.

    ``term`` is empty where the digest alone names the term.
    """
    collided = strings.where("low <> high").select("digest")
    counted = counts.withColumn("term", F.lit(""))
    if collided.limit(1).count():
        collided = cut(collided)
        split = texts.mapInArrow(_splitter(shift), "lang string, source string, digest bigint, "
                                 "term string, n bigint, docs bigint").join(
            collided, "digest", "left_semi").groupBy(*GROUP, "digest", "term").agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        counted = counted.join(collided, "digest", "left_anti").unionByName(split)
    mine = Window.partitionBy(*TERM)
    return counted.select(
        *GROUP, "digest", "term", "n", F.sum("n").over(mine).alias("lang_n"),
        F.sum("docs").over(mine).alias("lang_docs"),
        (F.col("source") == F.min("source").over(mine)).alias("once"),
    ).where(F.col("lang_docs") >= least).drop("lang_docs")


def _sizes(texts: DataFrame, facts: DataFrame) -> DataFrame:
    """Per group: its number, occurrences of kept terms, those of its language, V, the tiles of
    the language's groups and the share of a term it lacks."""
    groups = texts.select(*GROUP).distinct()
    numbered = groups.join(ordinals(groups, GROUP, "number"), GROUP)
    own = facts.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    langs = facts.groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.count_if("once").alias("v"))
    tile = F.expr(f"number div {TILE}")
    tiles = numbered.groupBy("lang").agg(
        F.min(tile).alias("first_tile"), F.max(tile).alias("last_tile"))
    none = F.lit(0).cast("bigint")
    sized = numbered.join(own, GROUP, "left").join(langs, "lang", "left").join(tiles, "lang").select(
        *GROUP, "number", "first_tile", "last_tile", F.coalesce("total", none).alias("total"),
        F.coalesce("lang_total", none).alias("lang_total"), F.coalesce("v", none).alias("v"))
    zero = F.when(F.col("v") > 0, _share(none, F.col("total"), F.greatest("v", F.lit(1))))
    return sized.withColumn("zero", F.coalesce(zero, F.lit(1).cast("bigint")))


def _pairs(shares: DataFrame, sizes: DataFrame) -> DataFrame:
    """The summed divergence of every source from every other of its language."""
    other = sizes.select("lang", F.col("number").alias("b"), F.col("zero").alias("b_zero"))
    meet = F.col("a") != F.col("b")
    exact = lambda value: value.cast("decimal(38,0)").alias("value")
    base = sizes.select("lang", F.col("number").alias("a"), F.col("zero").alias("a_zero"), "v").join(
        other, "lang").where(meet).select(
        "a", "b", exact(F.col("v").cast("decimal(19,0)")
                        * _apart(F.col("a_zero"), F.col("b_zero")).cast("decimal(19,0)")))
    histogram = shares.groupBy("lang", F.col("number").alias("a"), F.col("zero").alias("a_zero"),
                               "p").agg(F.count(F.lit(1)).alias("times"))
    one = histogram.join(other, "lang").where(meet)
    a, b, p = F.col("a_zero"), F.col("b_zero"), F.col("p")
    times = F.col("times").cast("decimal(19,0)")
    ahead = one.select("a", "b", exact(
        times * (_apart(p, b) - _apart(a, b)).cast("decimal(19,0)")))
    back = one.select(F.col("b").alias("a"), F.col("a").alias("b"), exact(
        times * (_apart(b, p) - _apart(b, a)).cast("decimal(19,0)")))
    both = shares.withColumn("mine", F.expr(f"number div {TILE}")).withColumn(
        "other", F.explode(F.sequence("first_tile", "last_tile"))).select(
        "lang", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
        "digest", "term", "number", "p", "zero")
    place = ["lang", "low", "high", "digest", "term"]
    both = both.repartition(*place).sortWithinPartitions(*place).mapInArrow(
        _shared_terms, "a bigint, b bigint, value bigint").select(
        "a", "b", exact(F.col("value")))
    summed = base.union(ahead).union(back).union(both).groupBy("a", "b").agg(
        F.sum("value").alias("value"))
    named = summed.join(sizes.select(F.col("number").alias("a"), *GROUP), "a").join(
        sizes.select(F.col("number").alias("b"), F.col("source").alias("item")), "b")
    return named.select(
        *GROUP, F.lit("pair").alias("part"), "item", F.col("value").cast("bigint").alias("value"),
    ).withColumn("rank", F.row_number().over(
        Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")))


def _shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of sources: the corrections for terms that both have, whole terms in order."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        new = np.flatnonzero(_changes(table))
        stop = int(new[-1])  # the last term may go on
        if stop:
            yield from _corrected(table.slice(0, stop))
        held, rows = [table.slice(stop)], table.num_rows - stop
    if rows:
        yield from _corrected(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _changes(table: pa.RecordBatch, *names: str) -> np.ndarray:
    """Where a row differs from the one before it."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for name in names or ("lang", "low", "high", "digest", "term"):
        column = table.column(name)
        if pa.types.is_string(column.type):
            column = column.dictionary_encode().indices
        values = column.to_numpy(False)
        new[1:] |= values[1:] != values[:-1]
    return new


def _corrected(table: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    edges = np.flatnonzero(_changes(table, "lang", "low", "high"))
    for at, stop in zip(edges.tolist(), [*edges[1:].tolist(), table.num_rows]):
        part = table.slice(at, stop - at)
        low, high = part.column("low")[0].as_py(), part.column("high")[0].as_py()
        term = np.cumsum(_changes(part)) - 1
        number = part.column("number").to_numpy(False)
        sources, first, source = np.unique(number, return_index=True, return_inverse=True)
        zero = part.column("zero").to_numpy(False)[first]
        p = part.column("p").to_numpy(False)
        total = np.zeros((len(sources), len(sources)), dtype=np.int64)
        step = max(1, CELLS // len(sources))
        for begin in range(0, int(term[-1]) + 1, step):
            a, b = np.searchsorted(term, (begin, begin + step))
            share = np.zeros((int(term[b - 1]) - begin + 1, len(sources)), dtype=np.int64)
            share[term[a:b] - begin, source[a:b]] = p[a:b]
            for one in range(len(sources)):
                has = share[share[:, one] > 0]
                if len(has):
                    total[one] += _correction(has[:, one, None], has, zero[one], zero)
        tile = sources // TILE
        fits = tile[:, None] != tile[None, :] if low != high else ~np.eye(len(sources), dtype=bool)
        one, other = np.nonzero(fits & (total != 0))
        if len(one):
            yield pa.RecordBatch.from_arrays(
                [pa.array(sources[one]), pa.array(sources[other]), pa.array(total[one, other])],
                ["a", "b", "value"])


def _correction(p: np.ndarray, q: np.ndarray, p_zero: int, q_zero: np.ndarray) -> np.ndarray:
    """Sum over terms with both shares of what they add to the terms counted from one side."""
    has = q > 0
    safe = np.where(has, q, 1)
    value = (p - q)**2 // safe - (p - q_zero)**2 // q_zero
    value -= (p_zero - q)**2 // safe - (p_zero - q_zero)**2 // q_zero
    return np.where(has, value, 0).sum(axis=0)


def _terms(shares: DataFrame, strings: DataFrame, top: int) -> DataFrame:
    """The terms a source has more of than its language, strings joined to the first ones only.

    The value of the last rank is found among distinct values first, so that only rows of that
    value or above are ever named, and no task orders all terms of a source.
    """
    found = shares.where("p > q").select(
        *GROUP, "digest", "term", _apart(F.col("p"), F.col("q")).alias("value"))
    falling = Window.partitionBy(*GROUP).orderBy(F.desc("value"))
    values = found.groupBy(*GROUP, "value").agg(F.count(F.lit(1)).alias("times")).withColumn(
        "place", F.row_number().over(falling)).where(F.col("place") <= top)
    reached = F.sum("times").over(falling.rowsBetween(Window.unboundedPreceding, -1))
    last = values.withColumn("before", F.coalesce(reached, F.lit(0))).where(
        F.col("before") < top).groupBy(*GROUP).agg(F.min("value").alias("least"))
    kept = found.join(last, GROUP).where("value >= least").join(strings, "digest")
    item = F.when(F.col("term") == "", F.col("low")).otherwise(F.col("term"))
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    return kept.select(*GROUP, F.lit("term").alias("part"), item.alias("item"), "value").withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= top)
