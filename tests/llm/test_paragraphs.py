import random
import re
from pathlib import Path

from fettle.llm import paragraphs
from fettle.llm.paragraphs import bands_for, repeated_passages
from fettle.shared import write_table
from tests.llm.test_neardup import LOWER


def units(text):
    found = []
    for line in (text or "").split("\n"):
        inside = re.findall(r"[^\x20\x09-\x0D]+", line)
        if len(inside) <= 25:
            found += [inside] if inside else []
            continue
        now = []
        for word in inside:
            now.append(word)
            if word[-1] in ".!?":
                found.append(now)
                now = []
        found += [now] if now else []
    return found


def brute(data):
    places = [(key, k, tuple(w.translate(LOWER) for w in unit))
              for key, text in data for k, unit in enumerate(units(text)) if len(unit) >= 8]
    sets = [frozenset(zip(*[u[j:] for j in range(5)])) for _, _, u in places]
    parent = list(range(len(places)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, s in enumerate(sets):
        for j in range(i):
            t = sets[j]
            if places[i][2] == places[j][2] or 100 * len(s & t) >= 80 * len(s | t):
                parent[find(i)] = find(j)
    clusters = {}
    for i, place in enumerate(places):
        clusters.setdefault(find(i), []).append(place[:2])
    return sorted((key, k, *min(c), (key, k) != min(c))
                  for c in clusters.values() if len(c) > 1 for key, k in c)


def test_clusters_equal_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(300)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)) + "."
    passage = " ".join(sentence(12) for _ in range(5))
    lines = [sentence(rng.randrange(3, 60)) for _ in range(12)]
    near = lines[0].split()
    data = []
    for key in range(30):
        parts = [sentence(rng.randrange(2, 20)) for _ in range(4)]
        parts.insert(rng.randrange(4), rng.choice(lines))
        if key % 4 == 0:
            parts[1] += " " + passage + " " + sentence(6)
        if key % 7 == 0:
            edited = sentence(40).split() if key else near
            parts.append(" ".join(edited))
        data.append((key, "\n".join(parts)))
    long = sentence(60).replace(".", "").split()
    data += [(40, " ".join(long) + "!"), (41, " ".join([*long[:-1], "changed"]) + "!")]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    found = repeated_passages(df).collect()
    want = brute(data)
    assert sorted((r.doc_id, r.passage, r.keep_id, r.keep_passage, r.removed)
                  for r in found) == want
    assert {r.doc_id for r in found} >= {k for k in range(0, 30, 4)} | {40, 41}
    by_key = dict(data)
    for r in found:
        assert len(by_key[r.doc_id].encode()[r.begin:r.end].split()) == r.n_words


def test_odd_rows(spark):
    line = "one two three four five six seven eight nine"
    df = spark.createDataFrame(
        [(None, line), (2, line + "\n" + line), (3, None), (4, ""), (5, "short line")],
        "doc_id bigint, text string").selectExpr("doc_id", "text", "1 AS rep", "2 AS passage")
    found = repeated_passages(df)
    assert sorted((r.doc_id or 0, r.passage, r.keep_id, r.keep_passage, r.removed)
                  for r in found.collect()) == [(0, 0, 2, 0, True), (2, 0, 2, 0, False),
                                                (2, 1, 2, 0, True)]
    assert repeated_passages(df.limit(0)).collect() == []


def test_bands_reach_the_recall_asked_for():
    for rows in (1, 2, 3):
        bands = bands_for(0.8, 1e-3, rows)
        assert (1 - 0.8**rows) ** bands <= 1e-3 < (1 - 0.8**rows) ** (bands - 1)


def test_every_shared_run_of_51_words_has_a_shared_passage(spark):
    """Passages set inline without stops, wrapped anew, and in short lines."""
    rng = random.Random(8)
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    passages = [fresh(51) for _ in range(4)]
    data = []
    for key in range(40):
        passage, style = passages[key % 4], key // 4 % 4
        text = fresh(rng.randrange(3, 30)) + passage + fresh(rng.randrange(3, 30))
        width = (7, 11, 6, 200)[style]
        lines = [" ".join(text[k:k + width]) for k in range(0, len(text), width)]
        data.append((key, "\n".join(lines)))
    short = "five words in one line\nand then four more"
    data += [(50, short), (51, short), (52, short + " here"), (60, "na " * 100)]
    found = repeated_passages(spark.createDataFrame(data, "doc_id bigint, text string")).collect()
    texts = {key: text.encode() for key, text in data}
    words_of = lambda r, key: texts[key][r.begin:r.end].decode().split()
    assert all(len(words_of(r, r.doc_id)) == r.n_words for r in found)
    for key in range(40):
        mine = [r for r in found if r.doc_id == key]
        assert {r.keep_id % 4 for r in mine} == {key % 4}
        gone = {w for r in mine if r.removed for w in words_of(r, key)}
        assert not gone if key < 4 else len(gone & set(passages[key % 4])) >= 51 - 14
    assert sorted((r.doc_id, r.keep_id, r.removed) for r in found if r.doc_id in (50, 51, 52)) == [
        (50, 50, False), (51, 50, True)]
    own = sorted((r.begin, r.end, r.removed) for r in found if r.doc_id == 60)
    assert own and all(a[1] <= b[0] for a, b in zip(own, own[1:])) and not own[0][2]
    assert all(r.removed or r.doc_id == r.keep_id for r in found)


def test_the_table_of_all_bands_goes_when_the_buckets_are_known(spark, monkeypatch):
    paths = []

    def written(df):
        found = write_table(df)
        paths.append(found[1])
        return found

    monkeypatch.setattr(paragraphs, "write_table", written)
    line = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(1, line), (2, line)], "doc_id bigint, text string")
    assert repeated_passages(df).count() == 2
    assert len(paths) == 1 and not Path(paths[0]).exists()


def test_only_what_is_asked_for_moves(spark, monkeypatch):
    keys = []
    marked = paragraphs._marked
    monkeypatch.setattr(paragraphs, "_marked",
                        lambda rows, asked, on: keys.append(on) or marked(rows, asked, on))
    df = spark.createDataFrame([(1, "a b c d e f g h i j")], "doc_id bigint, text string")
    assert repeated_passages(df).count() == 0
    assert keys == [["rep"], ["u"]]


def test_the_table_of_all_bands_has_a_row_for_each_paragraph(spark, monkeypatch):
    rows = []

    def written(df):
        found = write_table(df)
        rows.append(found[0].count())
        return found

    monkeypatch.setattr(paragraphs, "write_table", written)
    lines = [" ".join(f"w{k}x{j}" for j in range(10)) for k in range(6)]
    df = spark.createDataFrame([(1, "\n".join(lines[:5] + lines[:2])), (2, lines[5])],
                               "doc_id bigint, text string")
    assert repeated_passages(df).count() == 4
    assert rows == [6]


def test_bitmaps_come_before_what_is_asked_for(spark, monkeypatch):
    """A semi-join is moved below the join with the bitmaps, so that all rows are exchanged."""
    plans = []
    for name in ("cut", "for_now"):
        if hasattr(paragraphs, name):
            monkeypatch.setattr(paragraphs, name, lambda df, made=getattr(paragraphs, name): (
                plans.append(df._jdf.queryExecution().optimizedPlan().toString()), made(df))[1])
    line = "a b c d e f g h i j"
    df = spark.createDataFrame([(1, line), (2, line + " k")], "doc_id bigint, text string")
    assert repeated_passages(df).count()
    joins = [[x for x in plan.splitlines() if "Join " in x] for plan in plans]
    marked = [x for x in joins if any("bitmap" in y for y in x)]
    assert len(marked) == 2 and not any("bitmap" in x[0] for x in marked)


def test_a_paragraph_by_itself_is_the_same_paragraph(spark):
    import pyarrow as pa

    rng = random.Random(5)
    texts = []
    for _ in range(40):
        made = [f"{rng.choice('aBcD')}{rng.randrange(9)}{rng.choice(['', '', '', '.', '!'])}"
                for _ in range(rng.randrange(90))]
        texts.append("".join(w + rng.choice([" ", " ", "\t", "\r", "  ", "\n"][:rng.randrange(1, 7)])
                             for w in made))
    whole = paragraphs.Paragraphs(pa.array(texts), 3)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    (units_,) = paragraphs._units(3)(iter([batch]))
    alone = paragraphs.Paragraphs(units_.column("text"), 3)
    assert units_.column("rep").to_pylist() == paragraphs._binary(alone.names()).to_pylist()
    assert set(units_.column("rep").to_pylist()) == set(
        paragraphs._binary(whole.names()).to_pylist())
    assert list(alone.total) == [1] * len(alone.names())


def test_buckets_with_one_member_are_left_out(spark):
    from fettle.llm.neardup import shared_buckets

    members = spark.createDataFrame(
        [(1, b"a"), (1, b"a"), (2, b"a"), (3, b"c"), (3, b"b"), (3, b"b"), (3, b"d")],
        "key bigint, rep binary")
    found = sorted((r.key, bytes(r.rep), bytes(r.leader)) for r in shared_buckets(members).collect())
    assert found == [(3, b"c", b"b"), (3, b"d", b"b")]
    assert shared_buckets(members.where("key = 1")).collect() == []


def test_runs_have_one_exchange_by_their_words(spark):
    line = "a b c d e f g h i j k l m n o p q r s t"
    df = spark.createDataFrame([(1, line), (2, line + " u v w")], "doc_id bigint, text string")
    plan = repeated_passages(df)._jdf.queryExecution().optimizedPlan().toString()
    by_words = [x.split("RepartitionByExpression")[1] for x in plan.splitlines()
                if "RepartitionByExpression [u#" in x]
    assert len(by_words) == 2 and all(", v#" in x for x in by_words)


def test_paragraphs_that_hold_a_stretch_of_words():
    import numpy as np
    import pyarrow as pa

    word = lambda n: " ".join(f"w{k}" for k in range(n))
    found = paragraphs.Paragraphs(pa.array([
        f"{word(9)}\n{word(8)}\n{word(3)}\n{word(20)}", None, word(10), word(2)]), 8)
    at = np.array([0, 0, 8, 16, 16, 17, 20, 19, 40, 49, 50])
    count = np.array([9, 17, 2, 1, 2, 3, 20, 21, 10, 1, 2])
    one, two = found.over(at, count)
    assert one.tolist() == [0, 0, 0, 1, -1, -1, 3, -1, 0, 0, -1]
    assert two.tolist() == [0, 1, 1, 1, -1, -1, 3, -1, 0, 0, -1]
    none = paragraphs.Paragraphs(pa.array([word(5), ""]), 8)
    assert [x.tolist() for x in none.over(np.array([0]), np.array([5]))] == [[-1], [-1]]


def test_runs_go_only_if_all_their_paragraphs_are_removed(spark):
    rng = random.Random(11)
    fresh = lambda n: " ".join(f"u{rng.randrange(10**9)}" for _ in range(n))
    one, two = fresh(20), fresh(20)
    both = one + "\n" + two
    data = [(1, both), (2, both), (3, one + " " + fresh(1)), (4, one.replace(" ", "\n") + "\n" + two),
            (None, both), (None, both)]
    found = repeated_passages(spark.createDataFrame(data, "doc_id bigint, text string")).collect()
    units_ = {1: 2, 2: 2, 3: 1, 4: 21, None: 2}
    runs = [r for r in found if r.passage >= units_[r.doc_id]]
    paragraphs_ = [r for r in found if r.passage < units_[r.doc_id]]
    assert {(r.doc_id, r.removed) for r in paragraphs_} == {
        (1, False), (2, True), (3, True), (4, True), (None, True)}
    # Of 2 and the rows without an id all paragraphs go, and their runs with them.
    assert {r.doc_id for r in runs} == {1, 4}
    assert all(r.removed == (r.doc_id == 4) and r.keep_id == 1 for r in runs)
