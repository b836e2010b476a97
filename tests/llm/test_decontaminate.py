import random

from fettle.llm import decontaminate as d
from tests.helpers import rows


def distance(pattern, text):
    """Least edit distance of the pattern to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row), row.index(min(row))


def test_bit_parallel_distance():
    rng = random.Random(4)
    for _ in range(400):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 40)))
        if rng.random() < 0.5:
            at = rng.randrange(len(pattern))
            text += pattern[:at] + "x" + pattern[at:] + text
        best, end = d.nearest(d._mask(pattern), len(pattern), text)
        want, want_end = distance(pattern, text)
        assert best == want and (best == len(pattern) or end == want_end)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("xyz")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("xyz"))
    return "".join(chars)


def test_matches_equal_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 7))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, prose(rng.randrange(8, 30))) for k in range(12)] + [(12, None), (13, "  ")]
    items.append((14, items[3][1]))
    docs = []
    for key in range(60):
        text = prose(rng.randrange(0, 80))
        if key % 2:
            _, item = items[rng.randrange(12)]
            put = edited(rng, item, rng.randrange(0, len(item) // 8))
            text = text + " " + put.upper().replace(" ", "\n ") + " " + prose(5)
        docs.append((key, text))
    docs += [(60, None), (61, ""), (None, items[0][1]), (59, docs[59][1])]
    a = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "1 AS item_id", "2 AS distance")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    want = []
    for key, text in docs:
        for item_id, item in items:
            normal, inside = d.normal(item or ""), d.normal(text or "")
            if normal:
                least = distance(normal, inside)[0]
                if least <= int(0.08 * len(normal)):
                    want.append((key, item_id, least))
    found = d.contaminated(a, b).collect()
    assert sorted(((r.doc_id, r.item_id, r.distance) for r in found), key=repr) == sorted(
        want, key=repr)
    by_key, by_item = dict(docs), dict(items)
    for r in found:
        stretch = d.normal(by_key[r.doc_id][r.begin:r.end])
        assert distance(d.normal(by_item[r.item_id]), stretch)[0] == r.distance
    dirty = {key for key, _, _ in want}
    kept = d.decontaminate(a, b)
    assert kept.columns == a.columns
    assert rows(kept, "doc_id") == sorted(((k,) for k, _ in docs if k not in dirty), key=repr)
    monkeypatch.setattr(d, "BLOCK_CHARS", 300)  # several passes over the documents
    assert d.contaminated(a, b).count() == len(want)
    assert rows(d.decontaminate(a, b), "doc_id") == rows(kept, "doc_id")
    assert d.contaminated(a, b.limit(0)).collect() == []
    assert d.contaminated(a.limit(0), b).collect() == []
