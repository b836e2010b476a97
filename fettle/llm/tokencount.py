"""Token counts by the whole-token shortcut.

A byte-level BPE cuts a text into pre-tokens and merges each on its own. Which strings of the
vocabulary come out as one token when they are a pre-token is proved beforehand, by merging each
of them; such pre-tokens then count one without any merging. Only the rest is merged, each
distinct one once while the task remembers it.

Everything that decides a count is taken from the tokenizer's file: special strings, normalizer,
pre-tokenizer and merges. A file whose normalizer or pre-tokenizer is not the plain byte-level one
is cut by the library itself, and sentencepiece models are counted by their library whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.llm import words

# Fixed value: the pre-token pattern of byte-level BPE.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED = 300_000  # distinct pre-tokens a task keeps counts of; beyond, it starts anew


def token_counts(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id",
                 text_column: str = "text", limit: int = 1024) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row: its size in UTF-8 and in tokens.

    Counts are those of the tokenizer's library without added begin or end tokens, truncation or
    padding; a special string inside a text is one token, as the library reads it by default.
    Null counts as empty: no bytes, no tokens. Repeated rows and null ids each get their row.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    if tokenizer_path.endswith(".model"):
        counter = _piece_counter(Path(tokenizer_path).read_bytes())
    else:
        definition = Path(tokenizer_path).read_text(encoding="utf-8")
        counter = _merge_counter(definition, whole_tokens(definition), disagreements(definition))
    counted = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    ).mapInArrow(counter, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )


def byte_alphabet() -> dict[int, str]:
    """The character a byte-level vocabulary writes for each byte.

    Printable Latin-1 characters stand for themselves, the other bytes in turn for U+0100 onwards.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {byte: chr(byte if byte in plain else next(others)) for byte in range(256)}


def is_byte_level(definition: dict) -> bool:
    """Whether texts are cut by the plain byte-level pattern and nothing else."""
    cutter = definition.get("pre_tokenizer") or {}
    return (
        definition.get("normalizer") is None and cutter.get("type") == "ByteLevel"
        and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
        and definition["model"]["type"] == "BPE"
    )


def whole_tokens(definition: str) -> frozenset[str]:
    """Pre-tokens, as text, that the merges are proved to turn into a single token."""
    from tokenizers import Tokenizer

    fields = json.loads(definition)
    model = Tokenizer.from_str(definition).model
    proved = [s for s in fields["model"]["vocab"] if len(model.tokenize(s)) == 1]
    if not is_byte_level(fields):
        return frozenset(proved)
    byte_of = {char: byte for byte, char in byte_alphabet().items()}
    texts = []
    for string in proved:
        try:
            texts.append(bytes(byte_of[char] for char in string).decode("utf-8"))
        except (UnicodeDecodeError, KeyError):  # no text has it as a pre-token
            continue
    return frozenset(texts)


def disagreements(definition: str) -> str:
    """A character class of the code points that the library cuts otherwise than the pattern.

    The two are built on different versions of Unicode. Texts with such characters are counted by
    the library itself.
    """
    from tokenizers import Tokenizer

    if not is_byte_level(json.loads(definition)):
        return ""
    library, cut = Tokenizer.from_str(definition).pre_tokenizer, regex.compile(PRE_TOKEN).findall

    def differs(points: list[int]) -> bool:
        text = "".join(f"a{chr(p)}1 {chr(p)}!" for p in points)
        return [len(piece.encode()) for piece in cut(text)] != [
            len(piece) for piece, _ in library.pre_tokenize_str(text)]

    ranges: list[list[int]] = []
    # Planes 4 to 16 hold no letters, numbers or spaces in any version of Unicode.
    pending = [[p for p in range(at, at + 4096) if not 0xD800 <= p < 0xE000]
               for at in range(0, 0x40000, 4096)][::-1]
    while pending:
        points = pending.pop()
        if not points or not differs(points):
            continue
        if len(points) > 1:
            half = len(points) // 2
            pending += [points[half:], points[:half]]
        elif ranges and ranges[-1][1] == points[0] - 1:
            ranges[-1][1] = points[0]
        else:
            ranges.append([points[0], points[0]])
    inside = "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in ranges)
    return f"[{inside}]" if inside else ""


class Remembered(dict):
    """Number of tokens by pre-token; unknown ones are merged on first sight."""

    def __init__(self, whole: frozenset[str], merge) -> None:
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.merge = whole, merge

    def __missing__(self, piece: str) -> int:
        count = self.merge(piece)
        if len(piece) <= 64:
            self[piece] = count
        return count

    def trim(self) -> None:
        if len(self) > len(self.whole) + REMEMBERED:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))


class TextCounter:
    """Counts the tokens of a text."""

    def __init__(self, definition: str, whole: frozenset[str], odd: str) -> None:
        from tokenizers import Tokenizer

        fields = json.loads(definition)
        self.library = Tokenizer.from_str(definition)
        model, added = self.library.model, fields.get("added_tokens") or []
        # Special strings that touch their surroundings leave the text to the library.
        self.simple = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                              for t in added)
        special = sorted((t["content"] for t in added if t["content"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.odd = regex.compile(odd).search if odd else None
        if is_byte_level(fields):
            self.cut = regex.compile(PRE_TOKEN).findall
            alphabet = byte_alphabet()
            self.merge = lambda piece: len(model.tokenize(
                piece.encode("utf-8").decode("latin-1").translate(alphabet)))
        else:
            normal, cutter = self.library.normalizer, self.library.pre_tokenizer
            clean = normal.normalize_str if normal else str
            self.cut = lambda text: (
                [piece for piece, _ in cutter.pre_tokenize_str(clean(text))] if cutter
                else [clean(text)])
            self.merge = lambda piece: len(model.tokenize(piece))
        self.counts = Remembered(whole, self.merge)

    def __call__(self, text: str) -> int:
        if not self.simple or self.odd and not text.isascii() and self.odd(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        parts, total = [text], 0
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            total = len(parts) - 1
        for part in parts:
            total += sum(map(self.counts.__getitem__, self.cut(part)))
        self.counts.trim()
        return total


def _merge_counter(definition: str, whole: frozenset[str], odd: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = TextCounter(definition, whole, odd)
        for batch in words.slices(batches):
            yield _counted(batch, [count(text) for text in batch.column("text").to_pylist()])

    return run


def _piece_counter(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in words.slices(batches):
            texts = batch.column("text").to_pylist()
            yield _counted(batch, [len(library.encode(text)) for text in texts])

    return run


def _counted(batch: pa.RecordBatch, counts: list[int]) -> pa.RecordBatch:
    sizes = words.buffers(batch.column("text"))[1]
    return pa.RecordBatch.from_arrays(
        [batch.column("id"), pa.array(sizes[1:] - sizes[:-1]), pa.array(counts, pa.int64())],
        ["id", "n_bytes", "n_tokens"],
    )
