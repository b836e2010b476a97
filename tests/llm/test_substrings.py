import hashlib
import random

import numpy as np
import pytest

from fettle.llm import substrings as s

LENGTH = 130


def brute(texts, length):
    """Bytes covered by a string that starts at least twice, over all rows."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    found = []
    for b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        found.append((len(b), int(gone.sum()), [tuple(e) for e in edges.reshape(-1, 2).tolist()],
                      hashlib.sha256(kept).hexdigest()))
    return found


def corpus():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, shorter = prose(60), prose(60).encode()[:LENGTH - 1].decode(errors="ignore")
    texts = [prose(rng.randrange(0, 120)) for _ in range(25)]
    for k in range(0, 25, 3):
        texts[k] += passage[k % 5:] + texts[k][:7]
    for k in range(1, 25, 4):
        texts[k] += shorter + word()
    near = prose(90)
    texts += [near, near[:200] + "X" + near[200:], near, "ab" * 400, "abc" * 150 + "z",
              "Of " * 100 + prose(5), None, "", "x" * (LENGTH - 1), "x" * LENGTH, "\x00" * 300]
    return texts


def answer(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = s.repeated_strings(df.selectExpr("*", "1 AS t", "2 AS place").repartition(3),
                               length=LENGTH).collect()
    return [(r.n_bytes, r.n_removed, [tuple(x) for x in r.spans],
             hashlib.sha256(r.kept).hexdigest()) for r in sorted(found, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("block, core", [(1 << 17, 1 << 20), (64, 500)])
def test_removals_equal_brute_force(spark, monkeypatch, block, core):
    monkeypatch.setattr(s, "BLOCK", block)
    monkeypatch.setattr(s, "CORE_BYTES", core)  # small: pieces of common cores are halved
    texts = corpus()
    assert answer(spark, texts) == brute(texts, LENGTH)


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "q" * 300), (1, "r" * 50), (1, "r" * 50)],
                               "doc_id bigint, text string")
    found = sorted((r.doc_id or 0, r.n_removed) for r in s.repeated_strings(df, length=LENGTH).collect())
    assert found == [(0, 300), (1, 0), (1, 0)]
    assert s.repeated_strings(df.limit(0), length=LENGTH).collect() == []
    with pytest.raises(ValueError):
        s.repeated_strings(df, length=20)


def test_transform_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(150):
        length = int(rng.integers(1, 7))
        parts = [bytes(rng.integers(97, 97 + int(rng.integers(1, 4)),
                                    length + int(rng.integers(0, 15))).astype(np.uint8))
                 for _ in range(int(rng.integers(1, 8)))]
        weight = rng.integers(1, 3, len(parts))
        seen = {}
        for part, w in zip(parts, weight):
            for i in range(len(part) - length + 1):
                seen[part[i:i + length]] = seen.get(part[i:i + length], 0) + w
        want = [seen[p[i:i + length]] > 1 for p in parts for i in range(len(p) - length + 1)]
        data = np.frombuffer(b"".join(parts), dtype=np.uint8)
        offsets = np.cumsum([0, *map(len, parts)])
        assert s.repeated_starts(data, offsets, weight, length).tolist() == want
