"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur with up to ``error_rate * m`` edits. It is split into one
piece more than that, so any such occurrence holds at least one piece unchanged. One automaton
finds the exact piece hits of a text; around them Myers' bit-parallel recurrence gives the least
edit distance between the item and any stretch of the text.

The items are taken in blocks of about ``BLOCK_CHARS`` characters. Each block is one pass over the
documents, and what it finds is written before the next one begins, so only one block at a time is
on the driver and in a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.llm import words
from fettle.shared import cut

BLOCK_CHARS = 4_000_000


def contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id",
                 text_column: str = "text", item_id: str = "item_id", item_text: str = "text",
                 error_rate: float = 0.08) -> DataFrame:
    """(id, item_id, distance, n_places, begin, end): every item found in every row of ``docs``.

    Both texts are lower-cased and runs of white space read as one space. ``distance`` is the
    least edit distance of an occurrence, ``begin`` and ``end`` the characters of the first such
    one in the original text, and ``n_places`` the number of separate stretches with an
    occurrence. Null and empty items are found nowhere, null and empty texts hold nothing. Items
    with equal texts are each reported; repeated rows and rows with a null id are each reported.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    item_kind = items.schema[item_id].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = (f"{id_column} {kind}, {item_id} {item_kind}, distance int, n_places int, "
              "begin bigint, end bigint")
    found = None
    for block, more in _blocks(items, item_id, item_text):
        part = texts.mapInArrow(_reporter(block, error_rate, docs.schema[id_column].name,
                                          item_id), schema)
        part = cut(part) if more or found is not None else part
        found = part if found is None else found.union(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, items: DataFrame, text_column: str = "text",
                  item_id: str = "item_id", item_text: str = "text",
                  error_rate: float = 0.08) -> DataFrame:
    """``docs`` without the rows in which ``contaminated`` finds an item; all columns stay."""
    for block, more in _blocks(items, item_id, item_text):
        docs = docs.mapInArrow(_filter(block, error_rate, text_column), docs.schema)
        docs = cut(docs) if more else docs
    return docs


def _blocks(items: DataFrame, item_id: str, item_text: str) -> Iterator[tuple[list[tuple], bool]]:
    """The items as (id, normal text), some millions of characters at a time, and whether more
    blocks follow."""
    items = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).where(
        "text is not null")
    total = items.agg(F.sum(F.length("text").cast("bigint")).alias("n")).first().n or 0
    blocks = -(-total // BLOCK_CHARS)
    for number in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == number)
        block = [(row.id, normal(row.text)) for row in mine.toLocalIterator()]
        block = sorted(((i, t) for i, t in block if t), key=lambda x: (x[1], str(x[0])))
        yield block, number + 1 < blocks


def normal(text: str) -> str:
    """Lower case, one space for any white space; every other character keeps its length."""
    return " ".join(text.replace("İ", "i").lower().split())


def pieces(text: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` stretches of about equal length, with their places."""
    edges = [len(text) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, text[a:b]) for a, b in zip(edges, edges[1:])]


class Matcher:
    """The items of a block, ready for search."""

    def __init__(self, block: list[tuple], error_rate: float) -> None:
        self.items = [(i, text, int(error_rate * len(text))) for i, text in block]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text, errors) in enumerate(self.items):
            for at, piece in pieces(text, errors):
                places.setdefault(piece, []).append((number, at))
        self.pieces = ahocorasick.Automaton()
        for piece, where in places.items():
            self.pieces.add_word(piece, (len(piece), where))
        self.pieces.make_automaton()
        self.masks: dict[int, dict[str, int]] = {}

    def search(self, text: str) -> Iterator[tuple[int, int, int, int, int]]:
        """(item, distance, places, begin, end) of the items in a normal text."""
        windows: dict[int, list[list[int]]] = {}
        for end, (size, where) in self.pieces.iter(text) if self.items else ():
            for number, at in where:
                _, item, errors = self.items[number]
                low = max(0, end + 1 - size - at - errors)
                high = min(len(text), end + 1 - size - at + len(item) + errors)
                mine = windows.setdefault(number, [])
                if mine and low <= mine[-1][1] and mine[-1][0] <= low:
                    mine[-1][1] = max(mine[-1][1], high)
                else:
                    mine.append([low, high])
        for number, mine in sorted(windows.items()):
            _, item, errors = self.items[number]
            best, stretches = None, []
            for low, high in _merged(mine):
                distance, end = nearest(self.mask(number), len(item), text[low:high])
                if distance <= errors:
                    stretches.append(low)
                    if best is None or distance < best[0]:
                        best = (distance, low, low + end)
            if best:
                distance, low, end = best
                back = nearest(_mask(item[::-1]), len(item), text[low:end][::-1])[1]
                yield number, distance, len(stretches), end - back, end

    def mask(self, number: int) -> dict[str, int]:
        if number not in self.masks:
            self.masks[number] = _mask(self.items[number][1])
        return self.masks[number]


def _merged(windows: list[list[int]]) -> list[list[int]]:
    """Overlapping stretches as one, in order."""
    out: list[list[int]] = []
    for low, high in sorted(windows):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def _mask(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for k, char in enumerate(pattern):
        masks[char] = masks.get(char, 0) | 1 << k
    return masks


def nearest(masks: dict[str, int], size: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any stretch of ``text``, and where the first ends.

    Myers' recurrence: one column of the distance table is held as two bit vectors of ``size``
    bits, the places where it rises and falls.
    """
    all_ones, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score, best, best_end = all_ones, 0, size, size, 0
    for end, char in enumerate(text, 1):
        equal = masks.get(char, 0)
        vertical = equal | down
        equal |= (((equal & up) + up) ^ up)
        rise = down | (all_ones & ~(equal | up))
        fall = up & equal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = rise << 1, fall << 1
        up = (fall | ~(vertical | rise)) & all_ones
        down = rise & vertical & all_ones
        if score < best:
            best, best_end = score, end
    return best, best_end


def _original(text: str, begin: int, end: int) -> tuple[int, int]:
    """Places in a normal text as places in the text it was made from."""
    at, first, last = 0, None, len(text)
    for word in re.finditer(r"\S+", text):
        size = word.end() - word.start()
        if first is None and begin < at + size + 1:
            first = word.start() + max(0, min(begin - at, size))
        if end <= at + size:
            last = word.start() + max(0, end - at)
            break
        at += size + 1
    return first if first is not None else 0, last


def _reporter(block: list[tuple], error_rate: float, id_name: str, item_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block, error_rate)
        for batch in words.slices(batches):
            rows, found = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for number, distance, places, begin, end in matcher.search(normal(text or "")):
                    rows.append(row)
                    found.append((matcher.items[number][0], distance, places,
                                  *_original(text, begin, end)))
            if not found:
                continue
            items, distance, places, begin, end = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows, pa.int64())), pa.array(items),
                 pa.array(distance, pa.int32()), pa.array(places, pa.int32()),
                 pa.array(begin, pa.int64()), pa.array(end, pa.int64())],
                [id_name, item_name, "distance", "n_places", "begin", "end"])

    return run


def _filter(block: list[tuple], error_rate: float, text_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block, error_rate)
        for batch in words.slices(batches, text_column):
            keep = [next(matcher.search(normal(text or "")), None) is None
                    for text in batch.column(text_column).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run
