"""What the plans read and move."""

import re

import pytest

from fettle.operators import chat, ordered, packing, split
from fettle.plans.catalog import QUERIES, table
from tests.helpers import plan_of

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SMALL, "documents")


@pytest.mark.parametrize("name", [
    "head_rows", "take_skip", "fraction_split", "repeat_epochs", "agent_dataset",
    "expand_generations", "parse_action", "task_reward", "token_counts",
])
def test_nothing_moves(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, SMALL))


def test_heads_skip_files(spark, documents):
    plan = plan_of(split.head_rows(documents, 10, "doc_id"))
    assert re.search(r"PushedFilters: \[[^]]*LessThanOrEqual\(doc_id", plan)


@pytest.mark.parametrize("name, columns", [
    ("chars_per_token", {"doc_id", "text"}), ("shuffle_positions", {"doc_id", "text"}),
    ("fraction_split", {"doc_id", "text"}), ("token_counts", {"doc_id", "text"}),
    ("agent_dataset", {"doc_id"}), ("stream_split", {"doc_id", "text", "split"}),
])
def test_only_needed_columns_are_read(spark, name, columns):
    plan = plan_of(QUERIES[name](spark, SMALL))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert read
    for schema in read:
        assert {c.split(":")[0] for c in schema.split(",")} <= columns


def test_a_single_task_sees_totals_only(spark, documents):
    """The one unpartitioned window works on totals per range, never on rows."""
    plan = plan_of(ordered.ordinals(documents, "doc_id"))
    lines = plan.splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(single) == 1
    assert "HashAggregate" in lines[single[0] + 1]


def test_a_head_is_found_without_a_funnel(spark, documents):
    """Keys are numbered in ranges; only totals per range ever meet in one task."""
    numbered = ordered.ordinals(documents.select("doc_id"), "doc_id")
    plan = plan_of(numbered.agg({"ordinal": "max"}))
    assert "TakeOrdered" not in plan and "rangepartitioning" not in plan  # the ranges are a table
    assert "TakeOrdered" not in plan_of(split.head_rows(documents, 10, "doc_id"))


def test_texts_move_twice_to_be_packed(spark, documents):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(packing.pack_sequences(documents, "text", "doc_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(doc_id") == 2  # texts and their starts
    assert plan.count("Exchange hashpartitioning(chunk_id") == 1


def test_dialogues_join_on_unique_keys(spark):
    plan = plan_of(chat.dialogue_pairs(table(spark, SMALL, "conversations")))
    assert "Window" not in plan
    for keys in re.findall(r"hashpartitioning\(([^)]*)\)", plan):
        assert "conv_id" in keys and "answer_at" in keys
