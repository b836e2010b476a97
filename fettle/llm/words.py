"""Words and word shingles of whole texts as arrays of 64-bit fingerprints.

Tasks work on Arrow batches. A text is a stretch of one UTF-8 buffer, and everything below is
done on that buffer with numpy, in blocks of bounded size, so neither a batch of many texts nor
one very long text needs more than a fixed multiple of its own bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20  # bytes of text handled at a time; a longer text forms a slice of its own
BLOCK = 1 << 20  # bytes hashed at a time; a longer word forms a block of its own

BASE = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in runs of at most ``SLICE`` bytes of ``column``, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        ends, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            limit = (ends[at - 1] if at else 0) + SLICE
            stop = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and where each begins and ends. Null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown when a block needs more."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            grown = []
            for base in (BASE, inverse):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                grown.append(np.multiply.accumulate(steps))
            self.up, self.down = grown
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with ``(P[e] - P[s]) * down[s]`` the polynomial hash of ``data[s:e]``."""
    up, _ = POWERS.of(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=out[1:])
    return out


def spans(data: np.ndarray, offsets: np.ndarray,
          separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every run without separators, and the first run of each text."""
    n = len(data)
    inside = ~separators[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True  # words never reach across texts
    before = np.concatenate(([False], inside[:-1])) if n else inside
    after = np.concatenate((inside[1:], [False])) if n else inside
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A fingerprint of the bytes of each span; spans are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, base + BLOCK, side="right")))
        prefix = prefix_hash(data[base:ends[stop - 1]])
        _, down = POWERS.of(len(prefix))
        s, e = starts[at:stop] - base, ends[at:stop] - base
        out[at:stop] = mix((prefix[e] - prefix[s]) * down[s] + (e - s).astype(np.uint64))
        at = stop
    return out


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the words of all texts, A-Z lower-cased, and the first word of each."""
    data, offsets = buffers(texts)
    data = LOWER[data]
    starts, ends, first = spans(data, offsets)
    return span_hashes(data, starts, ends), first


def shingle_sets(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, end to end, and where each text's begin.

    Fewer words than ``size`` make one shingle of the whole sequence; no words, none.
    """
    count = np.diff(first)
    whole = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for k in range(size):
        whole = mix(whole ^ words[k:k + len(whole)]) + np.uint64(k + 1)
    sets, begin = [], np.zeros(len(count) + 1, dtype=np.int64)
    for i, n in enumerate(count):
        at = first[i]
        if n >= size:
            found = np.unique(whole[at:at + n - size + 1])
        elif n:
            value = np.zeros(1, dtype=np.uint64)
            for k in range(n):
                value = mix(value ^ words[at + k:at + k + 1]) + np.uint64(k + 1)
            found = mix(value + np.uint64(n))
        else:
            found = words[:0]
        sets.append(found)
        begin[i + 1] = begin[i] + len(found)
    return (np.concatenate(sets) if sets else words[:0]), begin


def set_fingerprints(shingles: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each set, as two 64-bit halves; zero for the empty set."""
    halves = []
    for salt in (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)):
        total = np.concatenate(([np.uint64(0)], np.cumsum(mix(shingles ^ salt))))
        halves.append(mix(total[begin[1:]] - total[begin[:-1]]))
    return halves[0], halves[1]


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed odd factors and summands of the first ``count`` min-hash functions."""
    numbers = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * BASE)
    return numbers[::2] | np.uint64(1), numbers[1::2]


def min_hashes(shingles: np.ndarray, begin: np.ndarray, count: int) -> np.ndarray:
    """``count`` min-hash values of every non-empty set, one row per set."""
    full = np.flatnonzero(np.diff(begin) > 0)
    out = np.zeros((len(begin) - 1, count), dtype=np.uint64)
    if len(full):
        factors, summands = permutations(count)
        for j in range(count):
            out[full, j] = np.minimum.reduceat(shingles * factors[j] + summands[j], begin[full])
    return out


def band_values(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One number per band of ``rows`` neighbouring min-hashes."""
    out = np.zeros((len(minima), bands), dtype=np.uint64)
    for k in range(rows):
        out = mix(out ^ minima[:, k:bands * rows:rows]) + np.uint64(k + 1)
    return out


def signed(x: np.ndarray) -> pa.Array:
    """64-bit fingerprints as Spark's BIGINT."""
    return pa.array(x.astype(np.uint64).view(np.int64))
