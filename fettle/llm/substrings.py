"""Repeated byte strings of a given length, by interval expansion on Burrows-Wheeler transforms.

A byte is removed if it lies in a string of ``length`` bytes that starts at least twice in the
corpus. Strings are looked for in pieces: a stretch of a text that owns up to ``SPAN`` neighbouring
string starts. Every string has an anchor, the 16 bytes in it with the least hash, and a piece
holds starts that share an anchor; so two equal strings lie in pieces whose common core, bytes all
strings of the piece contain, is equal too. Pieces whose core occurs once anywhere are done with.
The others are collapsed, equal ones to one with their number as weight, and gathered by core.

A task takes pieces of whole cores up to some hundred thousand bytes, builds their suffix order and
Burrows-Wheeler transform, and expands intervals breadth first: an interval of rows that share a
prefix is extended backwards by every byte that precedes it, which yields the common prefixes of
neighbouring rows by increasing length. It stops at ``length``; rows not parted by then share a
string that long, and it is repeated if their weights make at least two.

A core with too many different pieces for one task has its pieces halved, which makes cores longer,
and again, until they fit or own one start only, where equal cores are equal pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fettle.llm import words
from fettle.shared import cut

GRAM = 16  # bytes of an anchor
SPAN = 96  # most starts of a piece; their repetition fits two 64-bit numbers
BLOCK = 1 << 17  # starts handled at a time
TASK_BYTES = 1 << 18  # bytes of pieces transformed together
CORE_BYTES = 1 << 20  # most bytes of pieces with one core

# A piece's place in one number: start, first start's distance from the core, number of starts,
# and how often the piece follows itself (periodic texts).
STARTS, RUNS, AHEAD = 7, 10, 7


def repeated_strings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                     length: int = 200) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept): every text without its repeated strings.

    Texts are their UTF-8 bytes; null counts as empty. A byte goes if some string of ``length``
    bytes that covers it starts anywhere else, in the same text or another, overlaps included and
    judged on the input. ``spans`` are the maximal stretches removed (first byte, last exclusive),
    ``kept`` the other bytes, which need not be valid UTF-8. Texts shorter than ``length`` stay
    whole. Repeated rows repeat their strings, and each comes back; ids may be null.
    """
    if length < GRAM + SPAN:
        raise ValueError(f"strings must have at least {GRAM + SPAN} bytes")
    kind = docs.schema[id_column].dataType.simpleString()
    text = F.coalesce(F.col(text_column), F.lit("")).cast("string")
    texts = docs.select(F.col(id_column).alias("id"), text.alias("text"),
                        F.xxhash64(text).alias("t"), F.xxhash64(text, F.lit(1)).alias("t2"))

    places = texts.select("t", "text").mapInArrow(
        _cutter(length), "core bigint, piece bigint, t bigint, place bigint")
    again = places.groupBy("core").agg(F.sum(_times(F.col("place"))).alias("n")).where("n > 1")
    found = cut(places.join(again.select("core"), "core", "left_semi")
                .groupBy("core", "piece", "t", "place").agg(F.count(F.lit(1)).alias("n")))

    # One place to read each distinct piece from; both firsts come from the same row.
    distinct = found.groupBy("core", "piece").agg(
        F.sum(F.col("n") * _times(F.col("place"))).alias("weight"),
        F.first("t").alias("t"), F.first("place").alias("place"))
    asked = distinct.groupBy("t").agg(
        F.collect_list(F.struct("core", "piece", "place", "weight")).alias("asked"))
    first = F.row_number().over(Window.partitionBy("t", "t2").orderBy("t"))
    pieces = cut(
        texts.select("t", "t2", "text").mapInArrow(_packer("t", "t2", once=("t", "t2")),
                                                   "t bigint, t2 bigint, packed binary")
        .join(asked, "t").withColumn("copy", first).where("copy = 1")
        .select("packed", "asked").mapInArrow(_reader(length), _PIECE)
    )

    flags = _repeats(pieces, length)
    marked = found.join(flags, ["core", "piece"]).groupBy("t").agg(
        F.collect_list(F.struct("piece", "place", "low", "high")).alias("marked"))
    return (
        texts.select("id", "t", "text").mapInArrow(
            _packer("id", "t"), f"id {kind}, t bigint, packed binary")
        .join(marked, "t", "left").select("id", "packed", "marked")
        .mapInArrow(_remover(length), f"id {kind}, n_bytes bigint, n_removed bigint, "
                    "spans array<struct<begin:bigint,end:bigint>>, kept binary")
        .withColumnRenamed("id", id_column)
    )


SEEN = 200_000  # texts a task remembers to have passed on
_PIECE = "core bigint, piece bigint, ahead int, weight bigint, bytes binary"


def _times(place: Column) -> Column:
    """How often the piece at a place follows itself there."""
    return F.shiftright(place, STARTS).bitwiseAND(F.lit((1 << RUNS) - 1)) + 1


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, distance of the core, starts and repetitions of places."""
    count = (place & ((1 << STARTS) - 1)) + 1
    times = (place >> STARTS & ((1 << RUNS) - 1)) + 1
    ahead = place >> (STARTS + RUNS) & ((1 << AHEAD) - 1)
    return place >> (STARTS + RUNS + AHEAD), ahead, count, times


def _places(data: np.ndarray, offsets: np.ndarray, length: int):
    """(core, piece, text, place) of the pieces that own all starts of all texts."""
    reach = length - GRAM + 1
    fits = np.ones(len(data), dtype=bool)
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        fits[max(begin, end - length + 1):end] = False
    found: list[tuple[np.ndarray, ...]] = []
    for base in range(0, len(data) - length + 1, BLOCK):
        part = data[base:base + BLOCK + length - 1]
        count = len(part) - length + 1
        prefix = words.prefix_hash(part)
        _, down = words.POWERS.of(len(prefix))
        grams = len(part) - GRAM + 1
        least = (prefix[GRAM:] - prefix[:-GRAM]) * down[:grams]
        least ^= least >> np.uint64(29)
        least *= np.uint64(0xBF58476D1CE4E5B9)
        least &= np.uint64(0xFFFFFFFF00000000)
        least |= np.arange(grams, dtype=np.uint64)
        width = 1
        while 2 * width <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:count], least[reach - width:reach - width + count])
        anchor = (least & np.uint64(0xFFFFFFFF)).view(np.int64)
        part_of = (anchor - np.arange(count)) // SPAN
        core = anchor - part_of * SPAN
        ok = fits[base:base + count]
        change = np.ones(count + 1, dtype=bool)
        change[1:-1] = (core[1:] != core[:-1]) | (ok[1:] != ok[:-1])
        edges = np.flatnonzero(change)
        first, last = edges[:-1], edges[1:]
        keep = ok[first]
        first, last = first[keep], last[keep]
        core = core[first]
        size = length - SPAN + 1
        whole = last - first + length - 1
        found.append((
            words.mix((prefix[core + size] - prefix[core]) * down[core] + np.uint64(size)),
            words.mix((prefix[first + whole] - prefix[first]) * down[first]
                      + whole.astype(np.uint64)),
            first + base, core - first, last - first,
        ))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    core, piece, start, ahead, count = map(np.concatenate, zip(*found))
    text = np.searchsorted(offsets, start, side="right") - 1
    follows = np.zeros(len(start), dtype=bool)
    follows[1:] = (piece[1:] == piece[:-1]) & (core[1:] == core[:-1]) & (
        text[1:] == text[:-1]) & (start[1:] - start[:-1] == count[1:]) & (ahead[1:] == ahead[:-1])
    run = np.flatnonzero(~follows)
    inside = np.arange(len(start)) - np.repeat(run, np.diff(np.append(run, len(start))))
    head = np.flatnonzero(inside % (1 << RUNS) == 0)
    times = np.diff(np.append(head, len(start)))
    place = start[head] - offsets[text[head]]
    for value, bits in ((ahead[head], AHEAD), (times - 1, RUNS), (count[head] - 1, STARTS)):
        place = place << bits | value
    return core[head], piece[head], text[head], place


def _cutter(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            core, piece, text, place = _places(*words.buffers(batch.column("text")), length)
            yield pa.RecordBatch.from_arrays(
                [words.signed(core), words.signed(piece), batch.column("t").take(pa.array(text)),
                 pa.array(place)], ["core", "piece", "t", "place"])

    return run


def _packer(*names: str, once: tuple[str, ...] = ()):
    """The texts as Zstandard frames: whole texts are shuffled twice, and shrink by half so.

    Of rows that agree in the columns ``once`` a task passes on the first only, as far as it
    remembers them, so that a text with very many copies does not move as often.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        seen: set[tuple] = set()
        for batch in words.slices(batches):
            if once:
                keys = list(zip(*(batch.column(c).to_pylist() for c in once)))
                first = {key: row for row, key in reversed(list(enumerate(keys))) if key not in seen}
                seen = set(first) if len(seen) > SEEN else seen | set(first)
                batch = batch.take(pa.array(sorted(first.values()), pa.int64()))
            data, offsets = words.buffers(batch.column("text"))
            view = memoryview(np.ascontiguousarray(data))
            packed = [pack(view[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), pa.array(packed, pa.binary())],
                [*names, "packed"])

    return run


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Each text with the fields of the structs listed for it; None where there is no list."""
    unpack = zstandard.ZstdDecompressor().decompress
    lists = batch.column(column)
    fields = [f.to_numpy(False) for f in lists.flatten().flatten()]
    sizes = np.nan_to_num(lists.value_lengths().fill_null(0).to_numpy(False)).astype(np.int64)
    ends = np.cumsum(sizes)
    for packed, end, size in zip(batch.column("packed").to_pylist(), ends, sizes):
        yield np.frombuffer(unpack(packed), dtype=np.uint8), [f[end - size:end] for f in fields]


def _contexts(text: np.ndarray, start: np.ndarray, count: np.ndarray, piece: np.ndarray,
              length: int) -> tuple[np.ndarray, list[bytes]]:
    """Which pieces really are in the text, and their bytes.

    Texts are told apart by a 64-bit hash up to here; should two ever share it, the pieces of the
    other one are recognised by their own hash.
    """
    size = count + length - 1
    inside = np.flatnonzero(start + size <= len(text))
    start, size = start[inside], size[inside]
    ends = np.cumsum(size)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)
    data = text[at]
    same = words.span_hashes(data, ends - size, ends).view(np.int64) == piece[inside]
    raw = data.tobytes()
    return inside[same], [raw[e - s:e] for e, s in zip(ends[same].tolist(), size[same].tolist())]


def _reader(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "packed"):
            rows: list[list] = [[], [], [], [], []]
            for text, (core, piece, place, weight) in _texts(batch, "asked"):
                start, ahead, count, _ = _unpacked(place)
                real, contents = _contexts(text, start, count, piece, length)
                for column, values in zip(rows, (core, piece, ahead, weight)):
                    column.append(values[real])
                rows[4] += contents
            core, piece, ahead, weight = map(np.concatenate, rows[:4])
            yield pa.RecordBatch.from_arrays(
                [pa.array(core), pa.array(piece), pa.array(ahead.astype(np.int32)),
                 pa.array(weight), pa.array(rows[4], pa.binary())],
                ["core", "piece", "ahead", "weight", "bytes"])

    return run


def _repeats(pieces: DataFrame, length: int) -> DataFrame:
    """(core, piece, low, high): for pieces with repeated starts, one bit per start."""
    found, names, half = None, None, SPAN
    while True:
        heavy = pieces.groupBy("core").agg(F.sum(F.octet_length("bytes") + 1).alias("size")).where(
            F.col("size") > CORE_BYTES).select("core")
        heavy = cut(heavy)
        some = half > 1 and heavy.limit(1).count() > 0
        ready = pieces.join(heavy, "core", "left_anti") if some else pieces
        flags = ready.repartition("core").sortWithinPartitions("core").mapInArrow(
            _expander(length), "core bigint, piece bigint, low bigint, high bigint")
        if names is not None:  # back to the pieces these were cut from
            flags = flags.join(names, ["core", "piece"]).select(
                F.col("old_core").alias("core"), F.col("old_piece").alias("piece"),
                *_moved("low", "high", F.col("at")))
        found = flags if found is None else found.union(flags)
        if not some:
            break
        half = (half + 1) // 2  # never under half: every string of a part holds its core
        halves = cut(pieces.join(heavy, "core", "left_semi").mapInArrow(
            _halver(length, half), "old_core bigint, old_piece bigint, at int, " + _PIECE))
        mine = halves.select("old_core", "old_piece", "at", "core", "piece")
        if names is not None:
            older = names.select(
                F.col("core").alias("mid_core"), F.col("piece").alias("mid_piece"),
                F.col("old_core"), F.col("old_piece"), F.col("at").alias("mid_at"))
            mine = mine.withColumnsRenamed({"old_core": "mid_core", "old_piece": "mid_piece"}).join(
                older, ["mid_core", "mid_piece"]).select(
                "old_core", "old_piece", (F.col("at") + F.col("mid_at")).alias("at"),
                "core", "piece")
        names = cut(mine)
        pieces = cut(halves.groupBy("core", "piece", "ahead", "bytes").agg(
            F.sum("weight").alias("weight")).select("core", "piece", "ahead", "weight", "bytes"))
    return cut(found.groupBy("core", "piece").agg(
        F.bit_or("low").alias("low"), F.bit_or("high").alias("high")))


def _moved(low: str, high: str, by: Column) -> list[Column]:
    """The bits of a piece as bits of the one it was cut from, ``by`` starts further on."""
    bits = 48
    mask = F.lit((1 << bits) - 1)
    # Both numbers hold 48 bits, so a shift never reaches the sign.
    over = F.expr(f"CASE WHEN at = 0 THEN 0L WHEN at < {bits} THEN "
                  f"shiftright({low}, {bits} - at) ELSE shiftleft({low}, at - {bits}) END")
    new_low = F.when(by < bits, F.expr(f"shiftleft({low}, at)").bitwiseAND(mask)).otherwise(0)
    new_high = F.when(by < bits, F.expr(f"shiftleft({high}, at)")).otherwise(0).bitwiseOR(over)
    return [new_low.cast("bigint").alias(low), new_high.bitwiseAND(mask).cast("bigint").alias(high)]


def _halver(length: int, half: int):
    """Pieces cut where the distance from the core passes ``half``, with cores of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "bytes"):
            rows: list[list] = [[] for _ in range(8)]
            for row in batch.to_pylist():
                content, ahead = row["bytes"], row["ahead"]
                count = len(content) - length + 1
                split = min(count, max(0, ahead - half + 1))  # starts at a distance >= half
                for begin, end, base in ((0, split, half), (split, count, 0)):
                    if begin == end:
                        continue
                    core_at = ahead - base
                    core = content[core_at:core_at + length - half + 1]
                    part = content[begin:end + length - 1]
                    for column, value in zip(rows, (
                            row["core"], row["piece"], begin, core, part, ahead - begin - base,
                            row["weight"], part)):
                        column.append(value)
            cores, parts = (_named(rows[k]) for k in (3, 4))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()),
                 pa.array(rows[2], pa.int32()), cores, parts, pa.array(rows[5], pa.int32()),
                 pa.array(rows[6], pa.int64()), pa.array(rows[7], pa.binary())],
                ["old_core", "old_piece", "at", "core", "piece", "ahead", "weight", "bytes"])

    return run


def _named(strings: list[bytes]) -> pa.Array:
    """Fingerprints of byte strings."""
    ends = np.cumsum([len(s) for s in strings], dtype=np.int64)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ends) else ends
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    return words.signed(words.span_hashes(data, starts, ends))


def _expander(length: int):
    """Repeated starts of the pieces, cores in order and whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in words.slices(batches, "bytes"):
            for at in range(0, batch.num_rows, 256):
                held.append(batch.slice(at, 256))
                size += int(np.diff(words.buffers(held[-1].column("bytes"))[1][[0, -1]])[0])
                if size < TASK_BYTES:
                    continue
                table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                core = table.column("core").to_numpy(False)
                whole = int(np.searchsorted(core, core[-1]))  # the last core may go on
                if whole:
                    yield _expanded(table.slice(0, whole), length)
                held = [table.slice(whole)]
                size = int(np.diff(words.buffers(held[0].column("bytes"))[1][[0, -1]])[0])
        if held:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()
            if table:
                yield _expanded(table[0], length)

    return run


def _expanded(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    data, offsets = words.buffers(batch.column("bytes"))
    weight = batch.column("weight").to_numpy(False)
    flags = repeated_starts(data, offsets, weight, length)
    counts = np.diff(offsets) - length + 1
    which = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    bits = np.zeros((2, len(counts)), dtype=np.int64)
    for row, mine in enumerate((start < 48, start >= 48)):
        hit = mine & flags
        bits[row] = np.bincount(which[hit], np.exp2(start[hit] % 48), len(counts))
    some = np.flatnonzero(bits.any(axis=0))
    rows = pa.array(some)
    return pa.RecordBatch.from_arrays(
        [batch.column("core").take(rows), batch.column("piece").take(rows),
         pa.array(bits[0, some]), pa.array(bits[1, some])], ["core", "piece", "low", "high"])


def repeated_starts(data: np.ndarray, offsets: np.ndarray, weight: np.ndarray,
                    length: int) -> np.ndarray:
    """Whether the string at each start of each piece has weight two or more, piece by piece."""
    pieces = len(offsets) - 1
    if not pieces or not len(data):
        return np.zeros(0, dtype=bool)
    used = np.unique(data)
    code = np.zeros(256, dtype=np.int64)
    code[used] = np.arange(1, len(used) + 1)
    symbols = np.insert(code[data], offsets[1:], 0)  # 0 ends each piece
    rows, place_of = suffix_order(symbols)
    parted = expand_intervals(symbols, rows, place_of, length)
    owner = np.repeat(np.arange(pieces), np.diff(offsets) + 1)
    first = np.flatnonzero(parted[:-1])
    total = np.add.reduceat(weight[owner[rows]], first)
    group = np.cumsum(parted[:-1]) - 1
    repeated = np.empty(len(rows), dtype=bool)
    repeated[rows] = total[group] > 1
    ends = offsets[1:] + np.arange(pieces)  # places of the end symbols
    starts = np.ones(len(symbols), dtype=bool)
    starts[ends] = False
    for back in range(1, length):
        starts[np.maximum(ends - back, 0)] = False
    return repeated[starts]


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the place of each; symbol 0 ends a piece and equals no other 0.

    Prefix doubling: sort by the first symbols, then by the places of the suffixes that follow,
    only where places are still shared. A sort key carries the position in its low bits.
    """
    n = len(symbols)
    low = max(1, n.bit_length())
    if 3 * low > 63:
        raise ValueError("too many bytes for one transform")
    per = max(1, int(symbols.max()).bit_length())
    depth = max(1, (63 - low) // per)
    padded = np.concatenate((symbols, np.zeros(depth, dtype=np.int64)))
    key, alive = np.zeros(n, dtype=np.int64), np.ones(n, dtype=np.int64)
    for k in range(depth):
        here = padded[k:k + n]
        alive &= here != 0
        key = key << per | here * alive
    order = np.sort(key << low | np.arange(n))
    rows, head = order & ((1 << low) - 1), order >> low
    new = np.ones(n, dtype=bool)
    new[1:] = (head[1:] != head[:-1]) | (head[1:] & ((1 << per) - 1) == 0)
    slots = np.arange(n)
    place = np.zeros(n + 1, dtype=np.int64)
    place[rows] = np.maximum.accumulate(np.where(new, slots, 0))
    alone = new.copy()
    alone[:-1] &= new[1:]
    shared = slots[~alone]
    while len(shared):
        at = rows[shared]
        order = np.sort((place[at] << low | place[np.minimum(at + depth, n)]) << low | at)
        at, head = order & ((1 << low) - 1), order >> low
        rows[shared] = at
        new = np.ones(len(shared), dtype=bool)
        new[1:] = head[1:] != head[:-1]
        place[at] = np.maximum.accumulate(np.where(new, shared, 0))
        alone = new.copy()
        alone[:-1] &= new[1:]
        shared = shared[~alone]
        depth *= 2
    return rows, place[:n]


def expand_intervals(symbols: np.ndarray, rows: np.ndarray, place_of: np.ndarray,
                     length: int) -> np.ndarray:
    """Whether a row and the one before it have a common prefix shorter than ``length``.

    Intervals are extended backwards by each symbol that precedes one of their rows; the end of
    an extended interval whose parting was not known parts it at the length reached, and only such
    intervals are extended further.
    """
    n = len(rows)
    first = symbols[rows]
    after = place_of[np.minimum(rows + 1, n - 1)]  # row of the suffix one symbol shorter
    same = np.zeros(n, dtype=bool)
    same[1:] = (first[1:] == first[:-1]) & (first[1:] != 0)
    lower, upper = np.full(n, -1), np.full(n, n)
    lower[1:][same[1:]] = after[:-1][same[1:]]
    upper[:-1][same[1:]] = after[1:][same[1:]]
    before = np.maximum(rows - 1, 0)
    extends = (rows > 0) & (symbols[before] != 0)  # the transform: the symbol before each row
    to = np.where(extends, place_of[before], -1)
    lower, upper = lower[to].astype(np.int32), upper[to].astype(np.int32)
    to = to.astype(np.int32)

    parted = np.zeros(n + 1, dtype=bool)
    parted[:n] = ~same
    parted[n] = True
    begin = np.flatnonzero(parted[:n])
    end = np.append(begin[1:], n) - 1
    for _ in range(1, length):
        size = end - begin + 1
        total = int(size.sum())
        if not total:
            break
        which = np.repeat(np.arange(len(begin)), size)
        inside = np.arange(total) + np.repeat(begin - (np.cumsum(size) - size), size)
        target = to[inside]
        known = target >= 0
        opens = np.sort(target[known & (lower[inside] < begin[which])])
        closes = np.sort(target[known & (upper[inside] > end[which])]).astype(np.int64)
        fresh = ~parted[closes + 1]
        begin, end = opens[fresh].astype(np.int64), closes[fresh]
        parted[end + 1] = True
    return parted


def _remover(length: int):
    kind = pa.struct([("begin", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "packed"):
            sizes, removed, spans, kept = [], [], [], []
            for text, marks in _texts(batch, "marked"):
                runs, rest = [], text
                if len(marks[0]):
                    gone = _covered(text, marks, length)
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    runs = [{"begin": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
                    rest = text[~gone]
                sizes.append(len(text))
                removed.append(len(text) - len(rest))
                spans.append(runs)
                kept.append(rest.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(kind)), pa.array(kept, pa.binary())],
                ["id", "n_bytes", "n_removed", "spans", "kept"])

    return run


def _covered(text: np.ndarray, marks: list[np.ndarray], length: int) -> np.ndarray:
    """Whether each byte lies in a repeated string."""
    piece, place, low, high = marks
    start, _, count, times = _unpacked(place)
    real, _ = _contexts(text, start, count, piece, length)
    start, count, times, low, high = (x[real] for x in (start, count, times, low, high))
    bits = np.concatenate([(x[:, None] >> np.arange(48)) & 1 for x in (low, high)], axis=1)
    which, inside = np.nonzero(bits)
    lengths = times[which]
    step = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.repeat(start[which] + inside, lengths) + step * np.repeat(count[which], lengths)
    change = np.bincount(at, minlength=len(text) + 1)
    change -= np.bincount(at + length, minlength=len(text) + 1)
    return np.cumsum(change)[:len(text)] > 0
