import hashlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from fettle.llm.sharding import assign_shards, fill_table, table_sql
from tests.helpers import plan_of, rows

NAMES = [f"n{k}" for k in range(7)]


def brute(names, slots):
    """Turn by turn, with the whole order of preference written out."""
    orders = []
    for name in names:
        digest = hashlib.md5(name.encode()).hexdigest()
        start, step = int(digest[:15], 16) % slots, int(digest[16:31], 16) % (slots - 1) + 1
        orders.append([(start + j * step) % slots for j in range(slots)])
    owner = {}
    for turn in range(slots):
        order = orders[turn % len(names)]
        owner[next(s for s in order if s not in owner)] = turn % len(names)
    return [owner[s] for s in range(slots)]


def test_table():
    owner = fill_table(NAMES, 211)
    assert owner == brute(NAMES, 211)
    sizes = Counter(owner)
    assert len(sizes) == 7 and max(sizes.values()) - min(sizes.values()) <= 1
    moved = sum(NAMES[a] != (NAMES[:3] + NAMES[4:])[b] and NAMES[a] != "n3"
                for a, b in zip(owner, fill_table(NAMES[:3] + NAMES[4:], 211)))
    assert moved < 211 * 0.25  # of the slots whose shard is still there
    found = duckdb.sql(table_sql(NAMES, 211)).fetchall()
    assert sorted(found) == [(s, NAMES[k]) for s, k in enumerate(owner)]
    for wrong in (([], 211), (["a", "a"], 211), (NAMES, 210), (NAMES, 5)):
        with pytest.raises(ValueError):
            fill_table(*wrong)


def test_rows_stay_where_they_are(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    found = assign_shards(docs, "doc_id", NAMES)
    plan = plan_of(found)
    assert "Exchange hash" not in plan and "Python" not in plan and "SinglePartition" not in plan
    sizes = [n for _, n in rows(found.groupBy("shard").count())]
    assert len(sizes) == 7 and max(sizes) < 1.15 * min(sizes)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "b"), (1, None), (1, None)],
                                 "doc_id bigint, text string")
    found = rows(assign_shards(docs, "doc_id", NAMES), "doc_id", "slot", "shard")
    assert len(found) == 4 and len(set(found)) == 2
    assert assign_shards(docs.limit(0), "doc_id", NAMES).collect() == []
    with pytest.raises(ValueError, match="exist already"):
        assign_shards(docs.withColumn("Slot", F.lit(1)), "doc_id", NAMES)
