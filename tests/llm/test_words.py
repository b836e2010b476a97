import re

import numpy as np
import pyarrow as pa

from fettle.llm import words
from fettle.llm.components import components
from tests.helpers import rows

TEXTS = ["", None, "  ", "One two  three\ttwo", "É é x one", "a" * 3_000_000 + " b", "one TWO three two"]


def test_words_are_runs_without_ascii_white_space():
    hashes, first = words.word_hashes(pa.array(TEXTS))
    lower = {i: i + 32 for i in range(65, 91)}
    expected = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) for t in TEXTS]
    assert np.diff(first).tolist() == [len(w) for w in expected]
    flat = [w for text in expected for w in text]
    by_word = {}
    for word, value in zip(flat, hashes.tolist()):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_sliced_arrays_and_batches():
    whole = words.word_hashes(pa.array(TEXTS))[0]
    part, first = words.word_hashes(pa.array(["x", *TEXTS]).slice(1))
    assert part.tolist() == whole.tolist()
    batch = pa.RecordBatch.from_arrays([pa.array(["ab"] * 10)], ["text"])
    assert sum(p.num_rows for p in words.slices(iter([batch]))) == 10


def test_shingle_sets_hold_each_shingle_once():
    texts = ["a b a b a b", "a b", "b", "", "a b a b"]
    hashes, first = words.word_hashes(pa.array(texts))
    shingles, begin = words.shingle_sets(hashes, first, 2)
    assert np.diff(begin).tolist() == [2, 1, 1, 0, 2]
    f1, f2 = words.set_fingerprints(shingles, begin)
    assert f1[0] == f1[4] and f2[0] == f2[4] and len(set(f1.tolist())) == 4
    minima = words.min_hashes(shingles, begin, 8)
    assert (minima[0] == minima[4]).all() and (minima[3] == 0).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, 9), (9, 7), (5, 5), (9, 11), (None, 3)]
    links = spark.createDataFrame(chain, "a bigint, b bigint")
    found = dict(rows(components(links, "a", "b")))
    assert found == {**{i: 100 for i in range(100, 161)}, 7: 7, 9: 7, 11: 7}
    assert rows(components(links.limit(0), "a", "b")) == []
