"""SentencePiece encoding and decoding for merge-type vocabularies.

A text gets a space in front and its spaces written as the vocabulary writes them, then is cut where no vocabulary string reaches across, which is proved from the
vocabulary beforehand. In each stretch the adjacent pairs of symbols that form a vocabulary string
wait on an agenda, the best score first and the leftmost of equals; taking one merges it and puts
its new pairs on. An entry whose symbols have changed since is passed over when its turn comes.
What is left are pieces, and bytes for characters without one. Short stretches of one length are
worked on side by side: the agenda of each is a row of ranks then, and every round takes the best
entry of every row.

Stretches are merged once while a task remembers them. Every newly merged one is encoded by the
sentencepiece library too, all of an Arrow batch in one call; should the two ever differ, the
library's ids are taken and the row says so in ``unlike``.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.llm import words

REMEMBERED = 500_000  # distinct stretches a task keeps the ids of; beyond, it starts anew
SHORT = 48  # characters of the stretches that are worked on side by side
PLACE = 40  # bits of an agenda entry for the place, below those for the rank
SPACE = "▁"  # what the library writes for a space

# Numbers of the fields of a model file, and of its kinds of pieces.
PIECES, TRAINER, NORMALIZER, DENORMALIZER = 1, 2, 3, 5
PIECE, SCORE, KIND = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK, SPACE_AS_SUFFIX, UNKNOWN_SURFACE = 3, 35, 24, 44
CHARACTER_MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
MERGES = 2
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def encode_pieces(docs: DataFrame, model_path: str, id_column: str = "doc_id",
                  text_column: str = "text", end: bool = True) -> DataFrame:
    """(id, ids, unlike) for every row: the ids of its text, and how many of its stretches the
    library encodes otherwise (none is known; its ids are used then).

    Ids are those of the sentencepiece library without sampling or a begin id; ``end`` adds the
    end id. Null counts as empty, which has no ids but that. Repeated rows and null ids each get
    their row. A stretch that can be cut nowhere is held whole, at about 100 bytes a character.
    Vocabularies other than merge-type ones, ones that change texts in other ways than by a space
    in front, and ones with user-defined or unused pieces are an error.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    vocabulary = Vocabulary(Path(model_path).read_bytes())
    return docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    ).mapInArrow(_encoder(vocabulary, end), f"id {kind}, ids array<int>, unlike int").withColumnRenamed(
        "id", id_column)


def decode_pieces(encoded: DataFrame, model_path: str, ids_column: str = "ids",
                  name: str = "decoded") -> DataFrame:
    """``encoded`` with ``name``: the text of ``ids_column`` as the library's decode gives it.

    Begin and end ids give nothing, bytes that form no character the replacement character each,
    the unknown id the model's own mark. Null lists give null. An id the vocabulary does not have
    is an error, and so is a list with a null in it.
    """
    taken = [c for c in encoded.columns if c.lower() == name.lower()]
    if taken:
        raise ValueError(f"column {taken[0]} exists already; rename it first")
    vocabulary = Vocabulary(Path(model_path).read_bytes())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(_decoder(vocabulary, ids_column, name), f"{schema}, `{name}` string")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a serialized message; lengths, strings and floats as bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(wire)
        size = number() if size is None else size
        yield tag >> 3, data[at:at + size]
        at += size


class Vocabulary:
    """What a model file says about pieces, normalization and decoding."""

    def __init__(self, model: bytes) -> None:
        self.model = model
        self.names: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        trainer: dict[int, int | bytes] = {}
        shape: dict[int, int | bytes] = {}
        undo: dict[int, int | bytes] = {}
        for field, value in _fields(model):
            if field == PIECES:
                one = dict(_fields(value))
                self.names.append(one[PIECE].decode("utf-8"))
                scores.append(float(np.frombuffer(one.get(SCORE, bytes(4)), "<f4")[0]))
                self.kinds.append(one.get(KIND, NORMAL))
            elif field in (TRAINER, NORMALIZER, DENORMALIZER):
                {TRAINER: trainer, NORMALIZER: shape, DENORMALIZER: undo}[field].update(_fields(value))
        if trainer.get(MODEL_TYPE, 1) != MERGES or trainer.get(SPACE_AS_SUFFIX):
            raise ValueError("not a merge-type vocabulary with spaces in front")
        if set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        if (shape.get(CHARACTER_MAP) or undo.get(CHARACTER_MAP) or shape.get(REMOVE_SPACES, 1)
                or not shape.get(DUMMY_PREFIX, 1) or not shape.get(ESCAPE_SPACES, 1)):
            raise ValueError("this vocabulary changes texts otherwise than by a space in front")
        order = {score: rank for rank, score in enumerate(sorted(set(scores), reverse=True))}
        plain = [i for i, kind in enumerate(self.kinds) if kind == NORMAL]
        self.ids = {self.names[i]: i for i in plain}
        self.rank = {self.names[i]: order[scores[i]] for i in plain}
        self.bytes = {int(self.names[i][1:-1], 16): i
                      for i, kind in enumerate(self.kinds) if kind == BYTE}
        self.fallback = bool(trainer.get(BYTE_FALLBACK))
        self.unknown = self.kinds.index(UNKNOWN)
        mark = trainer.get(UNKNOWN_SURFACE, " ⁇ ".encode())
        self.surfaces = [{CONTROL: b"", UNKNOWN: mark}.get(kind) for kind in self.kinds]
        for i in plain:
            self.surfaces[i] = self.names[i].replace(SPACE, " ").encode("utf-8")
        for byte, i in self.bytes.items():
            self.surfaces[i] = bytes([byte])

    @cached_property
    def library(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    @staticmethod
    def normalized(text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def cutter(self):
        """A function that cuts normalized texts where no piece reaches across.

        That is before a space that follows something else, if no piece has one inside, and on
        either side of ASCII characters that are in no piece of several characters.
        """
        inside = {char for name in self.rank if len(name) > 1 for char in name}
        alone = "".join(rf"\x{p:02x}" for p in range(128) if chr(p) not in inside)
        if any(SPACE in name.lstrip(SPACE) for name in self.rank):
            return re.compile(rf"[^{alone}]+|[{alone}]+" if alone else r"(?s:.+)").findall
        also = rf"|[{alone}]+" if alone else ""
        return re.compile(rf"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+{also}").findall

    def merged(self, stretch: str) -> list[str]:
        """The pieces of a stretch: best-scored adjacent pairs first, the leftmost of equals."""
        rank, n = self.rank.get, len(stretch)
        symbols = list(stretch)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for at in range(n - 1):
            found = rank(stretch[at:at + 2])
            if found is not None:
                agenda.append(found << PLACE | at)
        heapify(agenda)
        while agenda:
            top = heappop(agenda)
            at = top & (1 << PLACE) - 1
            right = after[at]
            if right >= n or not symbols[at]:
                continue
            both = symbols[at] + symbols[right]
            if rank(both) != top >> PLACE:  # one of the two is no longer what it was
                continue
            symbols[at], symbols[right] = both, ""
            right = after[at] = after[right]
            if right < n:
                before[right] = at
                found = rank(both + symbols[right])
                if found is not None:
                    heappush(agenda, found << PLACE | at)
            left = before[at]
            if left >= 0:
                found = rank(symbols[left] + both)
                if found is not None:
                    heappush(agenda, found << PLACE | left)
        return [symbol for symbol in symbols if symbol]

    def encoded(self, stretch: str) -> list[int]:
        """The ids of a stretch; unknown characters as bytes or as the unknown id."""
        known, out = self.ids.get, []
        for piece in self.merged(stretch):
            found = known(piece)
            if found is not None:
                out.append(found)
            elif self.fallback:
                out += [self.bytes[byte] for byte in piece.encode("utf-8")]
            else:
                out.append(self.unknown)
        return out


class SideBySide:
    """Encodes many short stretches at once; symbols are numbers.

    A symbol is a piece, by its id, or a character that is none, by ``FIRST`` plus its code point.
    """

    FIRST = 1 << 24
    NONE = np.iinfo(np.int64).max

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        if len(vocabulary.names) > self.FIRST:
            raise ValueError("too many pieces")
        rows = []
        for name, number in vocabulary.ids.items():
            for at in range(1, len(name)):
                halves = self._symbol(name[:at]), self._symbol(name[at:])
                if None not in halves:
                    rows.append((halves[0] << 25 | halves[1], vocabulary.rank[name], number))
        table = np.array(sorted(rows) or [(-1, 0, 0)], dtype=np.int64)
        self.pairs = table[:, 0].copy()
        # Ranks decide; the number of the merged piece rides along below them.
        self.worth = table[:, 1] << 25 | table[:, 2]

    def _symbol(self, string: str) -> int | None:
        alone = self.FIRST + ord(string) if len(string) == 1 else None
        return self.vocabulary.ids.get(string, alone)

    @cached_property
    def characters(self) -> np.ndarray:
        """The symbol of every code point."""
        symbols = np.arange(0x110000, dtype=np.int64) + self.FIRST
        for name, number in self.vocabulary.ids.items():
            if len(name) == 1:
                symbols[ord(name)] = number
        return symbols

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and merged piece of each pair, ``NONE`` for pairs that form no piece."""
        pair = left << 25 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.worth[at], self.NONE)

    def __call__(self, stretches: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each stretch with its ids; all have the same number of characters."""
        points = np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32)
        symbols = self.characters[points.reshape(len(stretches), -1)]
        who = np.arange(len(stretches))
        agenda = self._ranked(symbols[:, :-1], symbols[:, 1:])
        while len(who):
            if agenda.shape[1]:
                # Equal scores have equal upper bits, and of those the leftmost goes first.
                best = (agenda >> 25).argmin(axis=1)
                top = agenda[np.arange(len(who)), best]
                open_ = top != self.NONE
            else:
                open_ = np.zeros(len(who), dtype=bool)
            if not open_.all():
                for number, ids in zip(who[~open_].tolist(), self._ids(symbols[~open_])):
                    yield stretches[number], ids
                if not open_.any():
                    return
                who, symbols, agenda = who[open_], symbols[open_], agenda[open_]
                best, top = best[open_], top[open_]
            rows = np.arange(len(who))
            symbols[rows, best] = top & (1 << 25) - 1
            keep = np.ones(symbols.shape, dtype=bool)
            keep[rows, best + 1] = False
            symbols = symbols[keep].reshape(len(who), -1)
            keep = np.ones(agenda.shape, dtype=bool)
            keep[rows, best] = False
            agenda = agenda[keep].reshape(len(who), -1)
            for side in (best - 1, best):  # the merged symbol's new pairs
                mine = np.flatnonzero((side >= 0) & (side < agenda.shape[1]))
                at = side[mine]
                agenda[mine, at] = self._ranked(symbols[mine, at], symbols[mine, at + 1])

    def _ids(self, symbols: np.ndarray) -> list[bytes]:
        """The ids of each row of symbols."""
        if symbols.max() < self.FIRST:
            size, data = 4 * symbols.shape[1], symbols.astype(np.int32).tobytes()
            return [data[at:at + size] for at in range(0, len(data), size)]
        vocabulary, out = self.vocabulary, []
        for row in symbols.tolist():
            ids = array("i")
            for symbol in row:
                if symbol < self.FIRST:
                    ids.append(symbol)
                elif vocabulary.fallback:
                    ids.extend(vocabulary.bytes[b] for b in chr(symbol - self.FIRST).encode("utf-8"))
                else:
                    ids.append(vocabulary.unknown)
            out.append(ids.tobytes())
        return out


def _merged_together(vocabulary: Vocabulary, together: SideBySide, stretches: set[str]):
    """Each stretch with its ids."""
    by_size: dict[int, list[str]] = {}
    for stretch in stretches:
        by_size.setdefault(len(stretch), []).append(stretch)
    for size, same in by_size.items():
        if size > SHORT:
            for stretch in same:
                yield stretch, array("i", vocabulary.encoded(stretch)).tobytes()
        else:
            for at in range(0, len(same), 4_096):
                yield from together(same[at:at + 4_096])


def _encoder(vocabulary: Vocabulary, end: bool):
    together = SideBySide(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = vocabulary.cutter()
        tail = np.array([vocabulary.library.eos_id()] if end else [], np.int32)
        # A character that merges with nothing: behind it a stretch needs no space in front.
        apart = next((c for c in map(chr, range(1, 128)) if cut(f"a{c}") == ["a", c]), None)
        before = len(vocabulary.library.encode(apart)) if apart else 0
        seen: dict[str, bytes] = {}
        unlike: set[str] = set()
        for batch in words.slices(batches):
            texts = batch.column("text").to_pylist()
            stretches = [cut(vocabulary.normalized(text)) for text in texts]
            found = [list(map(seen.get, row)) for row in stretches]
            new = {stretch for row, ids in zip(stretches, found) if None in ids
                   for stretch, known in zip(row, ids) if known is None}
            seen.update(_merged_together(vocabulary, together, new))
            # The library puts the first space of a text in front itself.
            fresh = [s for s in new if s != SPACE and (s[0] == SPACE or apart)]
            for stretch, ids in zip(fresh, vocabulary.library.encode(
                    [s[1:].replace(SPACE, " ") if s[0] == SPACE else apart + s for s in fresh],
                    num_threads=1)):
                right = array("i", ids if stretch[0] == SPACE else ids[before:]).tobytes()
                if seen[stretch] != right:
                    seen[stretch] = right
                    unlike.add(stretch)
            lists, wrong = [], np.zeros(len(texts), np.int32)
            for i, row in enumerate(stretches):
                if None in found[i]:
                    found[i] = map(seen.__getitem__, row)
                ids = np.frombuffer(b"".join(found[i]), np.int32)
                if not vocabulary.fallback:  # neighbouring unknown characters are one id
                    unknown = ids == vocabulary.unknown
                    ids = ids[~(unknown & np.roll(unknown, 1) & (np.arange(len(ids)) > 0))]
                if unlike:
                    wrong[i] = sum(map(unlike.__contains__, row))
                lists.append(ids)
            if len(seen) > REMEMBERED:
                seen.clear()
                unlike.clear()
            sizes = np.array([0, *(len(ids) + len(tail) for ids in lists)])
            flat = np.concatenate([part for ids in lists for part in (ids, tail)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"),
                 pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(flat)),
                 pa.array(wrong)], ["id", "ids", "unlike"])

    return run


def _decoder(vocabulary: Vocabulary, column: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surfaces = pa.array(vocabulary.surfaces, pa.large_binary())
        kinds = np.array(vocabulary.kinds)
        # The space in front is taken off again.
        opening = np.array([k == NORMAL and n.startswith(SPACE)
                            for k, n in zip(vocabulary.kinds, vocabulary.names)])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(column)
                if not pa.types.is_list(lists.type):
                    lists = lists.cast(pa.list_(pa.int32()))
                ids = lists.flatten()
                numbers = ids.to_numpy(False)
                sizes = lists.value_lengths().fill_null(0).to_numpy(False)
                ends = np.cumsum(sizes, dtype=np.int64)
                pieces = surfaces.take(ids)
                _, offsets, data = pieces.buffers()
                offsets = np.frombuffer(offsets, np.int64)[
                    pieces.offset:pieces.offset + len(pieces) + 1]
                view = memoryview(data) if data is not None else memoryview(b"")
                control = np.flatnonzero(kinds[numbers] == CONTROL)
                shown = np.append(np.flatnonzero(kinds[numbers] != CONTROL), len(numbers))
                first = shown[np.searchsorted(shown, ends - sizes)]
                out: list[str | None] = []
                for begin, end, lead, valid in zip(
                        (ends - sizes).tolist(), ends.tolist(), first.tolist(),
                        lists.is_valid().to_pylist()):
                    if not valid:
                        out.append(None)
                        continue
                    # Bytes on two sides of a begin or end id form no character together.
                    inner = control[slice(*np.searchsorted(control, (lead, end)))]
                    stops = offsets[inner].tolist()
                    cuts = [offsets[begin] + (lead < end and opening[numbers[lead]]), *stops,
                            offsets[end]]
                    out.append("".join(_characters(bytes(view[a:b]))
                                       for a, b in zip(cuts, cuts[1:])))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(out, pa.string())], [*part.schema.names, name])

    return run


def _characters(data: bytes) -> str:
    """UTF-8 as text; every byte that is part of no character as the replacement character."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            try:
                out.append(data[at:].decode("utf-8"))
                break
            except UnicodeDecodeError as wrong:
                out.append(data[at:at + wrong.start].decode("utf-8") + "�")
                at += wrong.start + 1
        return "".join(out)
