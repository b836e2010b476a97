import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from fettle.llm import divergence
from fettle.llm.queries import SQL, op12_source_divergence
from tests.helpers import rows

SCHEMA = "doc_id bigint, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def brute(data, least=3, top=200):
    upper = {c: c + 32 for c in range(65, 91)}
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in data:
        terms = [t.translate(upper) for t in TERM.findall(text or "")]
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in {lang for lang, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        mine = sorted(source for name, source in groups if name == lang)
        shares = {}
        for key, count in [*((s, counts[lang, s]) for s in mine),
                           (None, sum((counts[lang, s] for s in mine), Counter()))]:
            total = sum(count[t] for t in kept)
            shares[key] = {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}
        apart = lambda p, q: (p - q)**2 // q
        for s in mine:
            pairs = [(sum(apart(shares[s][t], shares[o][t]) for t in kept), o)
                     for o in mine if o != s]
            terms = [(apart(shares[s][t], shares[None][t]), t) for t in kept
                     if counts[lang, s][t] and shares[s][t] > shares[None][t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, rank)
                        for rank, (value, item) in enumerate(found, 1)
                        if part == "pair" or rank <= top]
    return sorted(out, key=repr)


def corpus(n=400):
    rng = random.Random(4)
    terms = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 5))) for _ in range(250)]
    data = []
    for key in range(n):
        lang = rng.choice(["en", "en", "de", None])
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "é", "", None, "z", f"s{key % 9}"])
        bias = len(source or "") * 20
        text = "".join(rng.choice(terms[bias:] + terms[:9]) + rng.choice([" ", ",", "\n", "1", "_"])
                       for _ in range(rng.randrange(80)))
        data.append((key, text.upper() if key % 7 == 0 else text, lang, source))
    data += [(0, "again and again", "en", "a")] * 4
    data += [(1, None, "en", "silent"), (2, "", "xx", "one"), (3, "1 2", "xx", "two"),
             (4, "lonely " * 3, "yy", "alone"), (None, "lonely", "yy", "alone"), (5, "Ÿ a" * 9_000, "en", "b"),
             (5, "lonely", "yy", "alone")]
    return data


@pytest.mark.parametrize("bits, tile, rows_, top", [
    (64, 128, 1 << 16, 200), (6, 128, 1 << 16, 7), (64, 3, 50, 200), (9, 2, 10, 200)])
def test_values_equal_brute_force(spark, monkeypatch, bits, tile, rows_, top):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "ROWS", rows_)
    monkeypatch.setattr(divergence, "CELLS", 64)
    docs = spark.createDataFrame(corpus(), SCHEMA).repartition(4).withColumn("digest", F.lit(1))
    found = divergence.source_divergence(docs, digest_bits=bits, top=top)
    assert rows(found, *COLUMNS) == brute(corpus(), top=top)


def test_ties_are_ranked_by_their_text(spark):
    data = [(k, " ".join(f"w{chr(97 + j)}{chr(97 + k % 5)}" for j in range(26)), "en",
             f"s{k % 5}") for k in range(40)]
    docs = spark.createDataFrame(data, SCHEMA)
    assert rows(divergence.source_divergence(docs, top=10), *COLUMNS) == brute(data, top=10)
    assert divergence.source_divergence(docs.limit(0)).collect() == []


def test_query_equals_sql(spark, tmp_path):
    data = corpus(250)
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(SQL["op12_source_divergence"])
    assert [d[0] for d in want.description] == COLUMNS
    found = rows(op12_source_divergence(spark, str(tmp_path)), *COLUMNS)
    assert found == sorted(want.fetchall(), key=repr) == brute(data)


def test_shares_in_bigint_and_decimal_agree(spark):
    edge = divergence.PLAIN
    counts = [0, 1, 7, edge - 2, edge - 1, edge, edge + 1, 2**50]
    df = spark.createDataFrame([(n, n + 12345, 678) for n in counts], "n bigint, t bigint, v bigint")
    share = divergence._share(F.col("n"), F.col("t"), F.col("v"))
    assert [r.p for r in df.select(share.alias("p")).collect()] == [
        1 + 10**9 * (n + 1) // (n + 12345 + 678) for n in counts]
