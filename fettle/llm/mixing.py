"""Mixing sources to target weights by entropy balancing.

A document of size s has a rate r, the expected number of its copies. Among all rates that give
every source its target number of words, entropy balancing takes those nearest to one copy each,
in the sense of sum(b * (r ln r - r + 1)) with base weights b. The dual has one multiplier per
source and gives exponentially tilted rates, r = min(cap, exp(m * g)) with g = s / b. Newton steps
for the multipliers need two sums over documents per source and step; documents of equal size in
a source are one row of that sum, so a hot source is summed before anything is moved.

``length_tilt`` t sets g = (s / mean size)**t. At 0, the default, the entropy counts words and a
rate does not depend on length; at 1 it counts documents and long ones bear more of the change.

Rates become copies by systematic rounding in the order of size, which keeps every source within
one large document of its target; a few exchanges of single copies then close most of that gap.
Everything is DataFrame operations; the totals of one source are never needed in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fettle.functions.hashing import seeded_hash
from fettle.operators.ordered import ordinals
from fettle.shared import cut

WORD = r"[^\x20\x09-\x0D]+"
UNIT = 1 << 20  # rates are whole multiples of 1 / UNIT, so sums of them are exact
STEPS = 60
EXCHANGES = 5
SOURCE = ["no_source", "name"]  # a source that may be null, as two columns that are not
PART = "part"


def word_count(text: Column | str) -> Column:
    """Number of runs without ASCII white space; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def mix_sources(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                source_column: str = "source", weights: Sequence[float] = (5, 2, 1),
                cap: int = 3, seed: int = 0, length_tilt: float = 0.0) -> DataFrame:
    """(id, size, source_size, target, taken, copies) for every row of ``docs``.

    Sizes are words. Sources in code point order, null last, have the ``weights`` in turn and
    share the sum of all sizes by weight; no source gets more than ``cap`` times its own size, and
    what it would get beyond that goes to the others by weight. ``copies`` of a document lie
    between 0 and ``cap``; ``taken`` is copies times size.

    Null and empty texts have size 0 and one copy's worth of nothing. Documents are ordered by
    size, a hash of seed and id, the id and a hash of the text, so reruns and other partitionings
    agree; repeated rows get their copies one by one, in no particular order.
    """
    copies, sources = _copies(docs.select(*_reduced(id_column, text_column, source_column)),
                              weights, cap, seed, length_tilt)
    return copies.join(sources.select(*SOURCE, "source_size", "target"), SOURCE).select(
        F.col("id").alias(id_column), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies",
    )


def _reduced(id_column: str, text_column: str, source_column: str) -> list[Column]:
    return [
        F.col(id_column).alias("id"),
        F.col(source_column).isNull().cast("int").alias("no_source"),
        F.coalesce(F.col(source_column).cast("string"), F.lit("")).alias("name"),
        word_count(F.col(text_column)).alias("size"),
        F.xxhash64(F.col(text_column).cast("string")).alias("tie"),
    ]


def _copies(reduced: DataFrame, weights: Sequence[float], cap: int, seed: int,
            length_tilt: float) -> tuple[DataFrame, DataFrame]:
    """The rows with their ``copies``, and the sources with their targets.

    Columns of ``reduced`` beside those of ``_reduced`` break ties and are passed on.
    """
    rows = cut(reduced)
    sizes = cut(rows.groupBy(*SOURCE, "size").agg(F.count(F.lit(1)).alias("n")))
    sources = cut(_targets(sizes, weights, cap))
    rates = cut(_rates(sizes, sources, cap, length_tilt))
    rounded = _rounded(rows, rates, cap, seed)
    return _exchanged(rounded, sources, cap), sources


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    source_column: str = "source", weights: Sequence[float] = (5, 2, 1),
                    cap: int = 3, seed: int = 0, length_tilt: float = 0.0) -> DataFrame:
    """``docs`` with every row as often as ``mix_sources`` gives it copies; columns unchanged.

    Rows with equal ids and texts are taken in the order of a hash of their other columns, so
    reruns agree; rows equal in all columns are one like the other. Columns of any name are kept.
    """
    row, other = _free("__row", docs), _free("__other", docs)
    whole = F.xxhash64(*[f.name for f in docs.schema if "map<" not in f.dataType.simpleString()])
    # Written, as the numbers must be the same when the rows are read again to be repeated.
    keyed = cut(docs.withColumns({row: F.monotonically_increasing_id(), other: whole}))
    copies, _ = _copies(
        keyed.select(*_reduced(id_column, text_column, source_column),
                     F.col(other).alias("other"), F.col(row).alias("row")),
        weights, cap, seed, length_tilt)
    times = copies.where("copies > 0").select(
        F.col("row").alias(row), F.col("copies").cast("int").alias(other))
    again = F.array_repeat(F.lit(0), F.col(other))
    return keyed.drop(other).join(times, row).withColumn(other, F.explode(again)).select(*docs.columns)


def _free(name: str, df: DataFrame) -> str:
    """A helper column's name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def _targets(sizes: DataFrame, weights: Sequence[float], cap: int) -> DataFrame:
    """(source, source_size, n, target): shares by weight, filled up to the caps."""
    totals = cut(sizes.groupBy(*SOURCE).agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n")))
    turn = F.col("turn") % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    sources = cut(totals.join(ordinals(totals, SOURCE, "turn"), SOURCE).withColumn("weight", weight))
    most = cap * F.col("source_size")
    level = 0.0
    while True:  # the level only rises, and each round caps one more source or is the last
        full = F.lit(level) * F.col("weight") >= most
        left = sources.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, most)).alias("capped"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        if not left["open"]:
            break
        higher = (left["all"] - (left.capped or 0)) / left["open"]
        if higher <= level:
            break
        level = higher
    target = F.least(F.lit(level) * F.col("weight"), most.cast("double"))
    return sources.select(*SOURCE, "source_size", "n", target.alias("target"))


def _rates(sizes: DataFrame, sources: DataFrame, cap: int, tilt: float) -> DataFrame:
    """(source, size, units): the rate of the documents of each size, by Newton's method.

    The multipliers start at zero, that is at one copy of everything. Steps that leave the bracket
    known so far are replaced by its middle.
    """
    tilted = F.when(F.col("size") > 0, F.pow(F.col("size") * F.col("n_docs") / F.col("source_size"),
                                             F.lit(float(tilt)))).otherwise(F.lit(1.0))
    table = cut(sizes.join(sources.withColumnRenamed("n", "n_docs"), SOURCE).select(
        *SOURCE, "size", "n", "source_size", "target", tilted.alias("g")))
    top = F.log(F.lit(float(cap)))
    full = F.col("target") >= cap * F.col("source_size")
    state = cut(sources.select(
        *SOURCE, "target", "source_size",
        F.lit(0.0).alias("m"),
        F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"),
        (full | (F.col("target") <= 0)).alias("done"),
    ))
    power = F.least(F.col("m") * F.col("g"), top)
    for _ in range(STEPS):
        mass = F.col("n") * F.col("size") * F.exp(power)
        sums = table.select(*SOURCE, "size", "n", "g").join(
            state.select(*SOURCE, "m"), SOURCE
        ).groupBy(*SOURCE).agg(
            F.sum(mass).alias("value"),
            F.sum(F.when(F.col("m") * F.col("g") < top, mass * F.col("g"))).alias("slope"),
        )
        gap = F.col("value") - F.col("target")
        low = F.when(gap < 0, F.col("m")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("m")).otherwise(F.col("high"))
        step = F.col("m") - gap / F.col("slope")
        safe = F.when((step > low) & (step < high), step).otherwise((low + high) / 2)
        near = F.col("done") | (F.abs(gap) <= 1e-9 * F.col("target"))
        state = cut(state.join(sums, SOURCE).select(
            *SOURCE, "target", "source_size", F.when(near, F.col("m")).otherwise(safe).alias("m"),
            low.alias("low"), high.alias("high"), near.alias("done"),
        ))
        if not state.where(~F.col("done")).limit(1).count():
            break
    rate = F.when(full, F.lit(float(cap))).when(F.col("target") <= 0, F.lit(1.0)).otherwise(
        F.exp(power))
    return table.join(state.select(*SOURCE, "m"), SOURCE).select(
        *SOURCE, "size", F.round(rate * UNIT).cast("bigint").alias("units"))


def _rounded(rows: DataFrame, rates: DataFrame, cap: int, seed: int) -> DataFrame:
    """Rows with whole ``copies`` and their ``place`` in their source.

    Rates are summed in order of size; a row gets as many copies as whole numbers lie in its own
    stretch of that sum. Rows go to ranges of (source, order), so a hot source fills many ranges;
    at most one source continues into a range, so what is carried over has one row per range.
    """
    extra = [c for c in rows.columns if c in ("other", "row")]
    order = ["size", "lot", "id", "tie", *extra]
    ranged = cut(
        rows.join(rates, [*SOURCE, "size"]).withColumn("lot", seeded_hash(seed, "id"))
        .repartitionByRange(*SOURCE, *order).withColumn(PART, F.spark_partition_id())
    )
    totals = ranged.groupBy(PART, *SOURCE).agg(
        F.sum("units").alias("units"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy(*SOURCE).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        PART, *SOURCE, F.sum("units").over(earlier).alias("units_before"),
        F.sum("rows").over(earlier).alias("rows_before"),
    ).where("rows_before is not null")
    inside = Window.partitionBy(PART, *SOURCE).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce("units_before", F.lit(0)) + F.col("units_here") + UNIT // 2
    whole = int(math.log2(UNIT))
    return (
        ranged.withColumn("units_here", F.sum("units").over(inside))
        .withColumn("rows_here", F.count(F.lit(1)).over(inside))
        .join(F.broadcast(carried), [PART, *SOURCE], "left")
        .select(
            "id", *extra, *SOURCE, "size",
            (F.shiftright(until, whole) - F.shiftright(until - F.col("units"), whole)).alias("copies"),
            (F.coalesce("rows_before", F.lit(0)) + F.col("rows_here")).alias("place"),
        )
    )


def _exchanged(rows: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """One copy more or less of one document per source and round, where that narrows the gap.

    Choices are made on the first place of every (source, size, copies), which is combined before
    it moves; rows meet their change by their place at the end.
    """
    rows = cut(rows)
    taken = rows.groupBy(*SOURCE).agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
    gaps = cut(taken.join(sources, SOURCE).select(
        *SOURCE, (F.col("target") - F.col("taken")).alias("gap")))
    changes = None
    for _ in range(EXCHANGES):
        left = rows if changes is None else rows.join(changes, [*SOURCE, "place"], "left_anti")
        kinds = left.where("size > 0").groupBy(*SOURCE, "size", "copies").agg(
            F.min("place").alias("place"))
        gap, size = F.col("gap"), F.col("size")
        fits = F.when(gap > 0, F.col("copies") < cap).otherwise(F.col("copies") > 0)
        after = F.abs(F.abs(gap) - size)
        best = kinds.join(gaps, SOURCE).where(fits & (after < F.abs(gap))).groupBy(
            *SOURCE).agg(F.min_by(F.struct("place", "size", F.signum(gap).cast("bigint").alias("step")),
                                  F.struct(after.alias("after"), F.col("place"))).alias("best"))
        chosen = cut(best.select(*SOURCE, "best.place", "best.step", "best.size"))
        gaps = cut(gaps.join(chosen.drop("place"), SOURCE, "left").select(
            *SOURCE, (gap - F.coalesce(F.col("step") * size, F.lit(0))).alias("gap")))
        chosen = chosen.drop("size")
        changes = chosen if changes is None else changes.union(chosen)
    changed = rows.join(changes, [*SOURCE, "place"], "left")
    return changed.withColumn(
        "copies", F.col("copies") + F.coalesce("step", F.lit(0))).drop("step", "place")
