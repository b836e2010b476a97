"""Near-duplicate documents by MinHash with tensored banding.

Each document has ``collections`` small collections of ``rows`` min-hashes. A table key combines
two of them, so ``collections * (collections - 1) / 2`` tables of ``2 * rows`` hashes each cost
only ``collections * rows`` min-hash computations. Two sets of similarity s meet in a table when
two collections agree: with p = s**rows they are missed with probability
``(1-p)**m + m*p*(1-p)**(m-1)``, 0.0002 at s = 0.8 for the 16 collections of three used here.

Copies with equal shingle sets are one node. In a table, members of a bucket are first compared
with its smallest member only, and the links found so are contracted. Buckets that still hold
different components are looked at by sketches: a pair is near if at most 24 (for s = 0.8) of its 48
min-hashes, kept to four bits each, differ, which a pair at s exceeds less than once in a million.
What leaves a bucket are the members that have a near one in another component, not the pairs: they
are joined with their full sets and compared in tasks that pass on only links between components,
fewer than they have members. That is done in two rounds, first for eight tables without a common
collection, in which most copies meet, then for the others with what is still apart. Buckets too
large for one task, as a passage that very many documents share makes them, are cut into blocks of
members, and every two blocks are compared in a task of their own; no pair is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fettle.llm import words
from fettle.llm.components import components
from fettle.shared import cut, for_now

TASK_BUCKET = 4_096  # members of a block of a bucket; a task compares two blocks
SHINGLES = 1 << 20  # shingles of either side compared in one task; a larger set is alone on its side
BITMAPS, BITMAP = 4_096, 1 << 15  # bitmaps that mark keys, and the bits of one, fixed by Spark
RARE = 1_000_000  # a sketch fails a pair at the threshold less than once in so many
SKETCH = ["s0", "s1", "s2"]  # 16 min-hashes of four bits each in every number


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    shingle_words: int = 5, similarity: tuple[int, int] = (80, 100),
                    collections: int = 16, rows: int = 3) -> DataFrame:
    """(id, n_shingles, component_id, kept): the near-duplicate class of every row.

    Words are runs without ASCII white space, A-Z lower-cased; a document's set holds its distinct
    shingles of ``shingle_words`` words, or its whole sequence if it has fewer. Two documents are
    linked if ``similarity[1] * |intersection| >= similarity[0] * |union|``. ``component_id`` is the
    smallest id reachable over links, ``kept`` whether it is the row's own.

    Texts that are null, empty or without words have the empty set and are linked with nothing.
    Rows that repeat an id are versions of one document: a link of one is a link of all, and each
    row comes back. Rows with a null id link with nothing and return null in both last columns.
    Other columns are ignored, whatever their names.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    signed, sets, found = _classed(docs, id_column, text_column, shingle_words, similarity,
                                   collections, rows)
    nodes = _named(sets, found)
    several = signed.where("n > 0 and id is not null").groupBy("id").agg(
        F.min(F.struct("f1", "f2")).alias("a"), F.max(F.struct("f1", "f2")).alias("b")).where("a <> b")
    several = cut(several.select("id"))
    if several.limit(1).count():  # ids with different texts join their classes
        versions = signed.join(several, "id", "left_semi").where("n > 0").select(
            "id", "f1", "f2").distinct().join(nodes, ["f1", "f2"])
        first = versions.groupBy("id").agg(F.min("node").alias("first"))
        same = versions.join(first, "id").select("first", "node")
        joined = cut(components(same, "first", "node").select(
            "node", F.col("component").alias("joined")))
        nodes = nodes.join(joined, "node", "left").withColumn("node", F.coalesce("joined", "node"))
    lowest = nodes.groupBy("node").agg(F.min("low").alias("component"))
    classes = nodes.select("f1", "f2", "node").join(lowest, "node").select("f1", "f2", "component")
    own = F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component", "id")).cast(kind)
    return (
        signed.select("id", "n", "f1", "f2").join(classes, ["f1", "f2"], "left")
        .select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
                own.alias("component_id"), (F.col("id") == own).alias("kept"))
    )


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                        shingle_words: int = 5, similarity: tuple[int, int] = (80, 100),
                        collections: int = 16, rows: int = 3) -> DataFrame:
    """``docs`` with one row of each class of near copies; columns unchanged.

    A class is one of texts, whatever their ids: of its rows that with the smallest id stays, of
    several such that whose text has the smallest hash, and of equal rows one. So a row whose text
    is like no other stays, also where its id names another text that goes. Rows with a null id,
    and each distinct id with an empty text, stay; of equal rows with an empty text one does.
    """
    signed, sets, found = _classed(docs, id_column, text_column, shingle_words, similarity,
                                   collections, rows)
    node = signed.where("id is not null").join(
        _named(sets, found).select("f1", "f2", "node"), ["f1", "f2"], "left")
    # Empty sets have no node: every one of those rows is its own class.
    chosen = node.where("node is not null").groupBy("node").agg(
        F.min(F.struct("id", "t", "t2")).alias("row")).select("row.*").union(
        node.where("node is null").select("id", "t", "t2"))
    text = F.col(text_column).cast("string")
    names = _free_names(docs, "t", "t2", "place")
    hashed = docs.where(F.col(id_column).isNotNull()).withColumns(
        {names["t"]: F.xxhash64(text), names["t2"]: F.xxhash64(text, F.lit(1))})
    keys = [F.col(id_column), F.col(names["t"]), F.col(names["t2"])]
    whole = F.xxhash64(*[f.name for f in docs.schema if "map<" not in f.dataType.simpleString()])
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(whole))
    once = hashed.withColumn(names["place"], place).where(F.col(names["place"]) == 1)
    wanted = chosen.distinct().select(*[
        F.col(c).alias(f"{names['place']}_{c}") for c in ("id", "t", "t2")])
    same = [k == F.col(f"{names['place']}_{c}") for k, c in zip(keys, ("id", "t", "t2"))]
    kept = once.join(wanted, same, "left_semi").select(*docs.columns)
    return kept.union(docs.where(F.col(id_column).isNull()))


def _free_names(df: DataFrame, *names: str) -> dict[str, str]:
    """Names for helper columns that ``df`` does not have."""
    taken, found = {c.lower() for c in df.columns}, {}
    for name in names:
        free = f"__{name}"
        while any(c.startswith(free) for c in taken):
            free += "_"
        found[name] = free
    return found


def _classed(docs: DataFrame, id_column: str, text_column: str, shingle_words: int,
             similarity: tuple[int, int], collections: int, rows: int):
    """Signed rows, distinct sets under numbers of their own, and the components of those."""
    kind = docs.schema[id_column].dataType.simpleString()
    text = F.col(text_column).cast("string")
    texts = docs.select(F.col(id_column).alias("id"), text.alias("text"))
    signed = cut(texts.select(
        "*", F.xxhash64("text").alias("t"), F.xxhash64("text", F.lit(1)).alias("t2"),
        F.monotonically_increasing_id().alias("row"),
    ).mapInArrow(
        _signer(shingle_words, collections, rows),
        f"id {kind}, t bigint, t2 bigint, row bigint, n bigint, f1 bigint, f2 bigint, "
        "bands array<bigint>, s0 bigint, s1 bigint, s2 bigint",
    ))
    sets = cut(
        signed.where("n > 0 and id is not null").groupBy("f1", "f2")
        .agg(F.min("row").alias("rep"), F.min(F.struct("id", "t")).alias("text"),
             *[F.first(c).alias(c) for c in ("n", "bands", *SKETCH)])
        .withColumns({"low": F.col("text.id"), "low_t": F.col("text.t")}).drop("text")
    )
    buckets = cut(_buckets(sets, collections))
    stars = cut(likely(buckets.select(F.col("leader").alias("a"), F.col("rep").alias("b")), sets,
                       similarity))
    full = lambda asked: _full_sets(texts, sets, asked, shingle_words)
    asked = stars.select(F.col("a").alias("rep")).union(stars.select("b")).distinct()
    links = cut(similar(stars, full(asked), similarity))
    found = cut(components(links, "a", "b"))
    return signed, sets, across(buckets, sets, found, similarity, full, _first_table)


def _named(sets: DataFrame, found: DataFrame) -> DataFrame:
    """(f1, f2, low, node): the component of every set, and its smallest id."""
    return sets.select("f1", "f2", "low", "rep").join(
        found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "f1", "f2", "low", F.coalesce("component", "rep").alias("node"))


def _signer(size: int, collections: int, rows: int):
    """Per text: size of the set, its 128-bit name, and one number per min-hash collection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            hashes, first = words.word_hashes(batch.column("text"))
            shingles, begin = words.shingle_sets(hashes, first, size)
            minima = words.min_hashes(shingles, begin, collections * rows)
            bands = words.band_values(minima, collections, rows)
            f1, f2 = words.set_fingerprints(shingles, begin)
            sketch = sketches(minima)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * collections)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "t", "t2", "row")), pa.array(np.diff(begin)), words.signed(f1), words.signed(f2),
                 pa.ListArray.from_arrays(offsets, words.signed(bands.ravel())),
                 *map(words.signed, sketch)],
                ["id", "t", "t2", "row", "n", "f1", "f2", "bands", *SKETCH],
            )

    return run


def sketches(minima: np.ndarray) -> list[np.ndarray]:
    """48 min-hashes of four bits; fewer are repeated in turn."""
    chosen = minima[:, np.arange(48) % minima.shape[1]] >> np.uint64(32) & np.uint64(15)
    shifts = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return [np.bitwise_or.reduce(chosen[:, k:k + 16] << shifts, axis=1) for k in (0, 16, 32)]


def _tables(collections: int) -> list[tuple[int, int]]:
    """Pairs of collections; first those of the first round, which have none in common."""
    apart = [(k, k + 1) for k in range(0, collections - 1, 2)]
    return apart + [p for p in combinations(range(collections), 2) if p not in apart]


def _salts(collections: int) -> np.ndarray:
    """A number per table; the lowest bit of a key tells whether it belongs to the first round."""
    return words.mix(np.arange(1, len(_tables(collections)) + 1, dtype=np.uint64) * words.BASE)


def _keys(bands: np.ndarray, left: np.ndarray, right: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Keys of one table per set, or of all in a row; even ones belong to the second round."""
    count = bands.shape[1]
    rows = np.arange(len(bands)).reshape(-1, *[1] * (left.ndim - 1))
    one, two = bands[rows, left], bands[rows, right]
    keys = words.mix(words.mix(one ^ _salts(count)[table]) ^ two)
    early = (table < count // 2).astype(np.uint64)
    return keys >> np.uint64(1) << np.uint64(1) | early


def _buckets(sets: DataFrame, collections: int) -> DataFrame:
    """(key, rep, leader, turn): members of shared buckets other than the smallest."""
    left, right = (np.array([side]) for side in zip(*_tables(collections)))
    every = np.arange(left.size)

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                bands = part.column("bands").flatten().to_numpy(False).view(np.uint64)
                keys = _keys(bands.reshape(part.num_rows, collections), left, right, every)
                rows = pa.array(np.repeat(np.arange(part.num_rows), len(every)))
                yield pa.RecordBatch.from_arrays(
                    [words.signed(keys.ravel()), part.column("rep").take(rows)], ["key", "rep"])

    # A set becomes 120 rows: few small files of sets must not make few large tasks.
    spread = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = sets.select("rep", "bands").repartition(spread, "rep").mapInArrow(
        tables, "key bigint, rep bigint")
    return with_leader(members).withColumn("turn", 1 - F.col("key").bitwiseAND(F.lit(1)))


def shared_buckets(members: DataFrame) -> DataFrame:
    """``with_leader`` as a table, of ``members`` (rep, key) most of which share no bucket.

    Keys are counted by themselves first, so members that are alone in a bucket do not move. Members
    may repeat; a bucket whose members are all the same one is found when they are made distinct.
    """
    several = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    with for_now(several) as several:
        held = _marked(members, several, ["key"]).join(several.hint("merge"), "key")
        with for_now(held.select("key", "rep").distinct()) as held:
            return cut(with_leader(held))


def with_leader(members: DataFrame) -> DataFrame:
    """Members of buckets other than the smallest, with the smallest.

    The smallest is found by an aggregate and joined back, so a large bucket is combined before it
    moves and is no single task's.
    """
    leaders = members.groupBy("key").agg(
        F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader <> last")
    return members.join(leaders.select("key", "leader").hint("merge"), "key").where("rep <> leader")


def across(buckets: DataFrame, sets: DataFrame, found: DataFrame, similarity: tuple[int, int],
           full_sets, first_key) -> DataFrame:
    """Components (node, component) after all pairs of members of one bucket are looked at.

    ``found`` are the components so far; in them every member is compared with its leader.
    ``full_sets`` gives the sets (rep, shingles) of a table of (rep), ``first_key`` the key of the
    first bucket that pairs of members share, from their collections and which of them agree.
    ``buckets`` are taken by their ``turn``, if they have one.
    """
    turns = (0, 1) if "turn" in buckets.columns else (None,)
    kind = sets.schema["rep"].dataType.simpleString()
    for turn in turns:
        mine = buckets if turn is None else buckets.where(F.col("turn") == turn)
        rows = cut(_near_members(mine, sets, found, similarity, first_key))
        full = full_sets(rows.select("rep").distinct())
        links = cut(
            rows.join(full, "rep").repartition("task").sortWithinPartitions("task")
            .mapInArrow(_linked(similarity), f"a {kind}, b {kind}"))
        joined = links.union(found.select(F.col("node").alias("a"), F.col("component").alias("b")))
        found = cut(components(joined, "a", "b"))
    return found


def _near_members(buckets: DataFrame, sets: DataFrame, found: DataFrame,
                  similarity: tuple[int, int], first_key) -> DataFrame:
    """(task, side, rep, component): members that have a near one in another component.

    Members meet in many tables; a pair counts in the first bucket it shares only. All members of a
    bucket are compared with all others, block by block, so its size changes nothing but the number
    of tasks.
    """
    labels = found.select(F.col("node").alias("rep"), "component")
    kind = sets.schema["rep"].dataType.simpleString()
    members = buckets.select("key", "rep").join(labels, "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = members.groupBy("key").agg(
        (F.min("component") != F.max("component")).alias("mixed"),
        F.ceil(F.count(F.lit(1)) / TASK_BUCKET).alias("blocks"),
    ).where("mixed").select("key", "blocks")
    # A set has at most one bucket in every table; it meets its traits once, with the list of them.
    listed = members.join(mixed, "key").groupBy("rep").agg(
        F.first("component").alias("component"),
        F.collect_list(F.struct("key", "blocks")).alias("shared"))
    members = listed.join(
        sets.select("rep", "n", "bands", *SKETCH).hint("merge"), "rep").select(
        "rep", "component", "n", "bands", *SKETCH, F.inline("shared"))
    # A member goes to the tasks of its block with every other; side 1 is the block of the two
    # with the larger number, and a block alone in its task is compared with itself.
    members = members.withColumn("mine", F.pmod(F.xxhash64("rep"), "blocks")).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    task = F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"))
    return (
        members.select(task.alias("task"), (F.col("mine") > F.col("other")).cast("int").alias("side"),
                       "key", "rep", "component", "n", "bands", *SKETCH)
        .repartition("task").sortWithinPartitions("task")
        .mapInArrow(_near(similarity, first_key),
                    f"task bigint, side int, rep {kind}, component {kind}")
    )


def _by_key(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """The rows of each key, from batches in order of it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(name).to_numpy(False)
        edges = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
        for at, stop in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if at == stop:
                continue
            if held and held[0].column(name)[0].as_py() != int(keys[at]):
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(batch.slice(at, stop - at))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _first_table(bands: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Key of the first table, in the order of ``_tables``, whose two collections agree."""
    tables = _tables(bands.shape[1])
    left, right = (np.array(side) for side in zip(*tables))
    table = np.empty(len(bands), dtype=np.int64)
    for at in range(0, len(bands), 1 << 14):
        part = agree[at:at + (1 << 14)]
        table[at:at + len(part)] = (part[:, left] & part[:, right]).argmax(axis=1)
    return _keys(bands, left[table], right[table], table)


def _near(similarity: tuple[int, int], first_key):
    """Per pair of blocks of a bucket: the members with near sketches, in tasks of bounded sets."""
    least, of = similarity
    allowed = _allowed(similarity)
    ones = np.uint64(0x1111111111111111)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in _by_key(batches, "task"):
            component, _ = _codes(task.column("component"))
            n = task.column("n").to_numpy(False)
            key = np.int64(task.column("key")[0].as_py()).view(np.uint64)
            bands = pc.list_flatten(task.column("bands")).to_numpy(False).view(np.uint64)
            bands = bands.reshape(len(n), -1)
            sketch = [task.column(c).to_numpy(False).view(np.uint64) for c in SKETCH]
            side = task.column("side").to_numpy(False)
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            alone = not len(right)
            right = left if alone else right
            near = np.zeros(len(n), dtype=bool)
            step = max(1, (1 << 18) // max(1, len(right)))
            for at in range(0, len(left), step):
                mine = left[at:at + step]
                unlike = np.zeros((len(mine), len(right)), dtype=np.int64)
                for number in sketch:
                    apart = number[mine, None] ^ number[None, right]
                    apart = (apart | apart >> np.uint64(1) | apart >> np.uint64(2)
                             | apart >> np.uint64(3)) & ones
                    unlike += np.bitwise_count(apart)
                small = np.minimum(n[mine, None], n[None, right])
                large = np.maximum(n[mine, None], n[None, right])
                row, column = np.nonzero((unlike <= allowed) & (of * small >= least * large)
                                         & (component[mine, None] != component[None, right]))
                row, column = mine[row], right[column]
                if len(row):
                    here = first_key(bands[column], bands[row] == bands[column]) == key
                    near[row[here]] = near[column[here]] = True
            sides = [left[near[left]]] if alone else [left[near[left]], right[near[right]]]
            if not all(map(len, sides)):
                continue
            number = np.int64(task.column("task")[0].as_py()).view(np.uint64)
            for part, here, rows in _blocks(sides, n):
                named = words.mix(number ^ words.mix(np.uint64(part + 1) * words.BASE))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), named.view(np.int64))),
                     pa.array(np.full(len(rows), here, np.int32)),
                     task.column("rep").take(pa.array(rows)),
                     task.column("component").take(pa.array(rows))],
                    ["task", "side", "rep", "component"])

    return run


def _blocks(sides: list[np.ndarray], n: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(part, side, rows): every two blocks of at most ``SHINGLES`` shingles as a part of their own.

    Side 2 marks a block that is compared with itself.
    """
    cut_ = [np.split(rows, np.flatnonzero(np.diff(np.cumsum(n[rows]) // SHINGLES)) + 1)
            for rows in sides]
    part = 0
    for i, one in enumerate(cut_[0]):
        for k, two in enumerate(cut_[-1]):
            if len(sides) > 1 or k > i:
                yield part, 0, one
                yield part, 1, two
            elif k == i:
                yield part, 2, one
            part += 1


def _codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Places of the values in their sorted distinct list, and the list."""
    names = values.unique()
    names = names.take(pc.sort_indices(names))
    return pc.index_in(values, names).to_numpy(False).astype(np.int64), names


def _linked(similarity: tuple[int, int]):
    """Per task: links that join its components, of the sets of one side with those of the other."""
    least, of = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in _by_key(batches, "task"):
            side = task.column("side").to_numpy(False)
            label, _ = _codes(task.column("component"))
            lists = task.column("shingles")
            sizes = lists.value_lengths().to_numpy(False).astype(np.int64)
            ends = np.cumsum(sizes)
            plain = pc.list_flatten(lists).to_numpy(False)
            order = np.argsort(plain, kind="stable")
            owner = np.repeat(np.arange(len(sizes)), sizes)[order]
            values = plain[order]
            links: list[tuple[int, int]] = []
            for row in np.flatnonzero(side != 1).tolist():
                open_ = (label != label[row]) & (side != side[row] if side[row] == 0 else True)
                if not open_.any():
                    continue
                mine = plain[ends[row] - sizes[row]:ends[row]]
                low = np.searchsorted(values, mine, "left")
                many = np.searchsorted(values, mine, "right") - low
                at = np.arange(int(many.sum())) + np.repeat(low - (np.cumsum(many) - many), many)
                both = np.bincount(owner[at], minlength=len(sizes))
                hits = np.flatnonzero(open_ & (of * both >= least * (len(mine) + sizes - both)))
                _, first = np.unique(label[hits], return_index=True)
                for other in hits[first].tolist():
                    links.append((row, other))
                    label[label == label[other]] = label[row]
            if links:
                reps = task.column("rep")
                a, b = (pa.array(ends_, pa.int64()) for ends_ in zip(*links))
                yield pa.RecordBatch.from_arrays([reps.take(a), reps.take(b)], ["a", "b"])

    return run


def _allowed(similarity: tuple[int, int]) -> int:
    """Min-hashes of 48 that may differ: a pair at the threshold exceeds it with chance < RARE."""
    least, of = similarity
    ways = [math.comb(48, k) * (of - least)**k * least**(48 - k) for k in range(49)]
    limit = 48
    while limit and sum(ways[limit:]) * RARE < of**48:
        limit -= 1
    return limit


def _may_reach(similarity: tuple[int, int]) -> Column:
    """Whether sizes and min-hashes leave it open that two sets are similar enough."""
    least, most = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    unlike = F.lit(0)
    for name in SKETCH:
        apart = F.col(f"a_{name}").bitwiseXOR(F.col(f"b_{name}"))
        any_bit = apart
        for shift in (1, 2, 3):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(apart, shift))
        unlike += F.bit_count(any_bit.bitwiseAND(F.lit(0x1111111111111111)))
    return (similarity[1] * least >= similarity[0] * most) & (unlike <= _allowed(similarity))


def likely(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The distinct pairs that may reach the similarity."""
    traits = ("n", *SKETCH)
    one, two = (
        sets.select(F.col("rep").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in traits])
        for side in "ab"
    )
    # Sets grow with the data: the plan is the same at every size.
    return pairs.distinct().join(one.hint("merge"), "a").join(two.hint("merge"), "b").where(_may_reach(similarity)).select(
        "a", "b").distinct()


def _full_sets(texts: DataFrame, sets: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """(rep, shingles): the whole sets asked for (rep), from one document that has each."""

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            hashes, first = words.word_hashes(batch.column("text"))
            shingles, begin = words.shingle_sets(hashes, first, size)
            lists = pa.LargeListArray.from_arrays(pa.array(begin), words.signed(shingles))
            own = map(words.signed, words.set_fingerprints(shingles, begin))
            same = pc.and_(*map(pc.equal, own, (batch.column("f1"), batch.column("f2"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), lists.cast(pa.list_(pa.int64()))],
                ["rep", "shingles"]).filter(same)

    named = cut(sets.select("rep", "low", "low_t", "f1", "f2").join(asked, "rep", "left_semi"))
    named = named.withColumnsRenamed({"low": "id", "low_t": "t"})
    found = _marked(texts.withColumn("t", F.xxhash64("text")), named, ["id", "t"]).join(
        named.hint("merge"), ["id", "t"]).select("text", "rep", "f1", "f2").mapInArrow(
        full_sets, "rep bigint, shingles array<bigint>")
    return cut(found.groupBy("rep").agg(F.first("shingles").alias("shingles")))


def _marked(rows: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` without most of those whose ``keys`` are not among those ``asked`` for.

    Keys asked for set a bit each of ``BITMAPS`` bitmaps of 4 KB, which are broadcast: 16 MB at the
    most. A row goes only if its bit is not set, so a join with ``asked`` gives the same afterwards,
    but wide rows that it would drop do not move. With far more keys than bits all rows stay.
    """
    number, bit = _place(keys)
    return rows.withColumns({"bitmap": number, "bit": bit}).join(
        F.broadcast(_bitmaps(asked, keys)), "bitmap").where(_is_set()).select(*rows.columns)


def flagged(rows: DataFrame, asked: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` with a column that is false only if a row's ``keys`` are not among those ``asked`` for.

    As ``_marked``, but no row goes, so that the few with the flag can take another way.
    """
    number, bit = _place(keys)
    bitmaps = _bitmaps(asked, keys).withColumnRenamed("bitmap", "part")
    return rows.withColumns({"part": number, "bit": bit}).join(
        F.broadcast(bitmaps), "part", "left").select(
        *rows.columns, F.coalesce(_is_set(), F.lit(False)).alias(name))


def _place(keys: list[str]) -> tuple[Column, Column]:
    """The bitmap of a row's keys, and their bit in it."""
    place = F.pmod(F.xxhash64(*keys), F.lit(BITMAPS * BITMAP)) + 1
    return F.bitmap_bucket_number(place), F.bitmap_bit_position(place)


def _bitmaps(asked: DataFrame, keys: list[str]) -> DataFrame:
    """(bitmap, bits): the bits of all keys asked for."""
    number, bit = _place(keys)
    return asked.groupBy(number.alias("bitmap")).agg(
        F.bitmap_construct_agg(bit).alias("bits")).mapInArrow(
        _bits, "bitmap bigint, bits array<bigint>")


def _is_set() -> Column:
    # An element of an array is read in place; of a binary value the whole would be copied per row.
    held = F.get("bits", F.expr("cast(bit div 64 as int)"))
    return F.expr("shiftleft(1L, cast(bit % 64 as int))").bitwiseAND(held) != 0


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps as lists of 64 bits each."""
    for batch in batches:
        bits = batch.column("bits")
        numbers = np.frombuffer(b"".join(bits.to_pylist()), dtype="<i8")
        ends = pa.array(np.arange(len(bits) + 1, dtype=np.int32) * (BITMAP // 64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("bitmap"), pa.ListArray.from_arrays(ends, pa.array(numbers))],
            ["bitmap", "bits"])


def similar(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose sets (rep, shingles) are similar enough."""
    one = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("one"))
    two = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("two"))
    both = F.size(F.array_intersect("one", "two"))
    union = F.size("one") + F.size("two") - both
    return (
        pairs.join(one, "a").join(two, "b")
        .where(similarity[1] * both >= similarity[0] * union)
        .select("a", "b").distinct()
    )
