"""Every operator as a query over the given tables.

``documents`` stand in for completions and ``events`` for a metric log where the tables have
neither. Each query runs over whole tables and whole texts; limits appear only where they are
what is computed (a head, a token limit).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fettle.functions import hooks, rewards, text, tokens
from fettle.functions.hashing import hash_number, seeded_hash
from fettle.operators import (
    chat,
    groups,
    packing,
    runs,
    scoring,
    shuffle,
    split,
    tasks,
)
from fettle.plans import jobs
from fettle.operators.selection import nth_key
from fettle.shared import cut, new_folder
from fettle.sources import layout
from fettle.sources.corpus import read_corpus, stream_corpus
from fettle.sources.runs import log_values, read_log_records
from fettle.streaming import buffers, carried, streams

Query = Callable[[SparkSession, str], DataFrame]

TASK_SEED = 7
DIFFICULTY = 4
GENERATIONS = 4
COMPLETION_LIMIT = 128
PROMPT_LIMIT = 256
CHAT_TOKENS = [text.CHAT_START, text.CHAT_END]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_corpus(spark, f"{sf_dir}/{name}.parquet")


def rounded(value: Column) -> Column:
    # Adding zero turns a rounded -0.0 into 0.0.
    return F.round(value, 6) + F.lit(0.0)


def with_md5(df: DataFrame, *columns: str, of: str = "text") -> DataFrame:
    """The columns and a digest of the text the rows carried along."""
    return df.select(*columns, F.md5(of).alias("text_md5"))


def digest(token_list: Column) -> Column:
    return F.md5(F.array_join(token_list, " "))


# Corpora and texts


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = split.describe_corpus(table(spark, sf_dir, "documents"), "doc_id")
    return facts.select(
        "n_rows",
        F.array_join("columns", ",").alias("column_names"),
        F.col("first_row.doc_id").alias("first_doc_id"),
        F.col("first_row.text").alias("first_text"),
    )


def dialogue_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.dialogue_pairs(table(spark, sf_dir, "conversations"))


def qa_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.with_qa_text(dialogue_pairs(spark, sf_dir)).select("conv_id", "turn", "text")


def summary_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue_pairs(spark, sf_dir).withColumnsRenamed(
        {"question": "prompt", "response_j": "completion"}
    )


def tldr_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.with_tldr_text(summary_pairs(spark, sf_dir)).select("conv_id", "turn", "text")


def chat_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_chat(table(spark, sf_dir, "conversations"))


def chat_prompt_gen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_chat(
        table(spark, sf_dir, "conversations"), add_generation_prompt=True
    )


def strip_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_prompt(spark, sf_dir).select(
        "conv_id", "part", text.strip_special(F.col("prompt"), CHAT_TOKENS).alias("plain")
    )


def generated_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = text.with_qa_text(dialogue_pairs(spark, sf_dir))
    prompt = text.qa_text(F.col("question"), F.lit(""))
    return pairs.select(
        "conv_id", "turn", text.generated_part(prompt, F.col("text")).alias("answer")
    )


def generated_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = text.with_qa_text(dialogue_pairs(spark, sf_dir))
    listed = pairs.select(
        "conv_id", "turn",
        tokens.tokenize(text.qa_text(F.col("question"), F.lit(""))).alias("prompt"),
        tokens.tokenize(F.col("text")).alias("full"),
    )
    rest = tokens.generated_tokens(F.col("prompt"), F.col("full"))
    return listed.select("conv_id", "turn", digest(rest).alias("tokens_md5"))


# Heads, splits, shuffles, batches


def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.head_rows(table(spark, sf_dir, "documents"), 100, "doc_id")


def take_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = split.take_skip(
        table(spark, sf_dir, "conversations"), 400, ["conv_id", "turn"]
    )
    return with_md5(labelled, "conv_id", "turn", "split")


def take_skip_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_sizes(split.take_skip(table(spark, sf_dir, "events"), 4000, "event_id"))


def fraction_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return with_md5(split.fraction_split(documents, "doc_id", 0.005, 0), "doc_id", "split")


def fraction_split_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "conversations")
    labelled = split.fraction_split(messages, ["conv_id", "turn"], 0.37, 3)
    return with_md5(labelled, "conv_id", "turn", "split")


def shuffle_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return with_md5(shuffle.shuffle_rows(documents, "doc_id", 0), "doc_id", "shuffle_pos")


def shuffle_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = shuffle.shuffle_blocks(
        table(spark, sf_dir, "conversations"), ["conv_id", "turn"], 0, 500)
    return with_md5(blocks, "conv_id", "turn", "block", "shuffle_pos")


def repeat_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_md5(shuffle.repeat_rows(table(spark, sf_dir, "documents"), 3), "doc_id", "epoch")


def repeat_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    repeated = shuffle.repeat_until(table(spark, sf_dir, "documents"), "doc_id", 10_000 * 4)
    return with_md5(repeated, "doc_id", "epoch", "position")


def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = text.with_qa_text(dialogue_pairs(spark, sf_dir))
    plan = shuffle.plan_batches(pairs, ["conv_id", "turn"], 4, drop_last=True)
    return with_md5(
        plan.withColumn("epoch_progress", rounded(F.col("epoch_progress"))),
        "conv_id", "turn", "step", "micro_step", "epoch_progress")


def batch_plan_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = table(spark, sf_dir, "documents")
    plan = shuffle.plan_batches(prompts, "doc_id", 2, 2, GENERATIONS)
    return with_md5(
        plan.withColumn("epoch_progress", rounded(F.col("epoch_progress"))),
        "doc_id", "gen_id", "step", "micro_step", "epoch_progress")


# Tokens


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", tokens.token_count(F.col("text")).alias("n_tokens")
    )


def chars_per_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    ratio = packing.chars_per_token(documents, "text", "doc_id", 400)
    return ratio.withColumn("chars_per_token", rounded(F.col("chars_per_token")))


def chunk_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.chunk_estimate(table(spark, sf_dir, "documents"), "text", "doc_id", 1024)
    return found.withColumn("expected_chunks", rounded(F.col("expected_chunks")))


def packed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = packing.pack_sequences(table(spark, sf_dir, "documents"), "text", "doc_id", 1024)
    return chunks.select("chunk_id", digest(F.col("tokens")).alias("tokens_md5"))


def packed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = jobs.packed_answers(
        dialogue_pairs(spark, sf_dir), ["conv_id", "turn"], test_size=0.2, seq_length=256
    )
    return chunks.select("split", "chunk_id", digest(F.col("tokens")).alias("tokens_md5"))


def packed_answers_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = jobs.packed_answers(
        dialogue_pairs(spark, sf_dir), ["conv_id", "turn"], test_size=0.2, seq_length=256,
        epochs=2, max_chunks=30,
    )
    return chunks.select("split", "chunk_id", digest(F.col("tokens")).alias("tokens_md5"))


def train_chars_per_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = jobs.train_chars_per_token(
        dialogue_pairs(spark, sf_dir), ["conv_id", "turn"], test_size=0.2)
    return ratio.withColumn("chars_per_token", rounded(F.col("chars_per_token")))


def packed_answers_by_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = jobs.packed_answers_by_head(
        dialogue_pairs(spark, sf_dir), ["conv_id", "turn"], n_valid=100, buffer=50,
        seq_length=256,
    )
    return chunks.select("split", "chunk_id", digest(F.col("tokens")).alias("tokens_md5"))


def truncate_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "documents").select(
        "doc_id", tokens.tokenize(F.col("text")).alias("tokens")
    )
    size = F.size("tokens")
    return listed.select(
        "doc_id",
        digest(tokens.truncate_tokens(F.col("tokens"), PROMPT_LIMIT, "prompt"))
        .alias("prompt_md5"),
        digest(tokens.truncate_tokens(F.col("tokens"), COMPLETION_LIMIT, "completion"))
        .alias("completion_md5"),
        tokens.completion_length(size, COMPLETION_LIMIT).alias("completion_length"),
        tokens.is_clipped(size, COMPLETION_LIMIT).alias("clipped"),
    )


# Agent tasks and their scoring


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tasks.with_prompts(tasks.tasks_for(samples, "doc_id", DIFFICULTY, TASK_SEED))


def stub_completion(key: str = "doc_id") -> Column:
    """A stand-in for a model: it writes the document, then by hash names the target, another
    item, or no action at all."""
    pick = hash_number(seeded_hash(TASK_SEED, key, "gen_id")) % 3
    target = F.col("target_id")
    return F.concat(
        F.col("text"),
        F.when(pick == 0, F.concat(
            F.lit("It is the first one.<END_THINK> "), text.id_token(target)))
        .when(pick == 1, F.concat(
            F.lit("<END_THINK>"), text.id_token(target % tasks.POOL_SIZE + 1)))
        .otherwise(text.id_token(target)),
    )


def _completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = tasks.expand_generations(_tasks(spark, sf_dir), GENERATIONS)
    return asked.withColumn("completion", stub_completion())


def agent_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tasks(spark, sf_dir).select(
        "doc_id", F.size("item_ids").cast("bigint").alias("n_items"), "target_id"
    )


def agent_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tasks(spark, sf_dir).select("doc_id", "prompt", "target_id", "item_ids_str")


def agent_dataset_graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    harder = F.least(F.floor(F.col("n_chars") / 100), F.lit(320)).cast("int")
    graded = tasks.with_prompts(tasks.tasks_for(samples, "doc_id", harder, TASK_SEED))
    return graded.select("doc_id", "target_id", "item_ids_str")


def special_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.special_token_usage(_tasks(spark, sf_dir), "prompt")


def expand_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.expand_generations(_tasks(spark, sf_dir), GENERATIONS).select(
        "doc_id", "gen_id", "prompt"
    )


def parse_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = rewards.parse_action(F.col("completion"))
    return _completions(spark, sf_dir).select(
        "doc_id", "gen_id", parsed["matched"].alias("matched"),
        parsed["action"].alias("action"),
    )


def task_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _completions(spark, sf_dir).select(
        "doc_id", "gen_id",
        rewards.task_reward(F.col("completion"), F.col("target_id")).alias("reward"),
    )


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = rewards.action_outcome(F.col("completion"), F.col("target_id"))
    return _completions(spark, sf_dir).withColumn("outcome", outcome)


def outcome_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = scoring.outcome_summary(_outcomes(spark, sf_dir), "gen_id")
    return counts.withColumn("share", rounded(F.col("share")))


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = scoring.accuracy(_outcomes(spark, sf_dir), "gen_id")
    return shares.withColumn("accuracy", rounded(F.col("accuracy")))


def reward_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    completions = _completions(spark, sf_dir).select("doc_id", "gen_id", "completion")
    targets = _tasks(spark, sf_dir).select("doc_id", "target_id")
    aligned = scoring.align(completions, targets, "doc_id")
    return aligned.select(
        "doc_id", "gen_id", "target_id",
        rewards.task_reward(F.col("completion"), F.col("target_id")).alias("reward"),
    )


def alignment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.alignment_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id"
    )


def agent_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = jobs.agent_round(
        table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id",
        lambda asked: asked.withColumn("completion", stub_completion()),
        DIFFICULTY, GENERATIONS, TASK_SEED,
    )
    return scored.select(
        "doc_id", "gen_id", "reward", "outcome",
        rounded(F.col("advantage")).alias("advantage"),
    )


def round_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    reward = rewards.task_reward(F.col("completion"), F.col("target_id"))
    scored = _completions(spark, sf_dir).withColumns({"reward": reward, "task_reward": reward})
    records = jobs.round_records(scored, "doc_id", ["task_reward"], 2, 2, GENERATIONS)
    return _all_rounded(records, ["step", "n_steps", "num_tokens"])


# Text rewards and groups


def unique_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", rewards.unique_chars(F.col("text")).alias("unique_chars")
    )


def unique_chars_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", rounded(rewards.unique_chars_reward(F.col("text"))).alias("reward")
    )


def combined_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.apply_rewards(
        table(spark, sf_dir, "documents"),
        {
            "unique_chars": rewards.unique_chars(F.col("text")),
            "unique_chars_reward": rewards.unique_chars_reward(F.col("text")),
        },
        weights={"unique_chars": 0.5},
    )
    return scored.select(
        "doc_id", *[rounded(F.col(c)).alias(c)
                    for c in ("unique_chars", "unique_chars_reward", "reward")]
    )


def _scored_groups(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", *columns,
        F.expr("doc_id div 4").alias("prompt_id"),
        (F.col("doc_id") % 4).alias("gen_id"),
        rewards.unique_chars_reward(F.col("text")).alias("reward"),
    )


def group_reward_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = groups.group_reward_stats(_scored_groups(spark, sf_dir), "prompt_id")
    return stats.select(
        "prompt_id", "n", rounded(F.col("reward_mean")).alias("reward_mean"),
        rounded(F.col("reward_std")).alias("reward_std"),
    )


def group_advantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = cut(_scored_groups(spark, sf_dir))
    found = groups.group_advantage(scored, "prompt_id")
    return found.select("doc_id", rounded(F.col("advantage")).alias("advantage"))


def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored_groups(spark, sf_dir, "text", "source")
    return groups.preference_pairs(scored, "prompt_id", "source", "text")


# Training steps and logs


def _step_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.step_completion_stats(_as_completions(table(spark, sf_dir, "documents")))


def _as_completions(documents: DataFrame) -> DataFrame:
    size = tokens.token_count(F.col("text"))
    return documents.select(
        (F.expr("doc_id div 2") + 1).alias("step"),
        tokens.completion_length(size, COMPLETION_LIMIT).alias("n_tokens"),
        tokens.is_clipped(size, COMPLETION_LIMIT).alias("clipped"),
    )


def step_completion_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rounded(_step_stats(spark, sf_dir), ["step"])


def _all_rounded(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, *[rounded(F.col(c)).alias(c) for c in df.columns if c not in keys])


def step_reward_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = cut(_scored_groups(spark, sf_dir)).select(
        "prompt_id", (F.expr("prompt_id div 2") + 1).alias("step"),
        F.col("reward").alias("unique_chars"), "reward",
    )
    stats = runs.step_reward_stats(scored, "prompt_id", ["unique_chars"])
    return _all_rounded(stats, ["step"])


def log_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = _step_stats(spark, sf_dir)
    windows = runs.log_windows(stats, [c for c in stats.columns if c != "step"], 5)
    return _all_rounded(windows, ["step", "n_steps"])


def cumulative_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = table(spark, sf_dir, "documents").select(
        F.col("source").alias("run"), F.col("doc_id").alias("step"),
        tokens.token_count(F.col("text")).alias("n_tokens"),
    )
    return runs.cumulative_tokens(cut(steps))


def _metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"), F.col("event_id").alias("step"),
        F.col("value").alias("loss"),
    )


def metric_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rounded(
        runs.metric_deltas(_metric_log(spark, sf_dir), "loss"), ["run", "step"]
    )


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rounded(
        runs.run_summary(_metric_log(spark, sf_dir), ["loss"]), ["run", "metric", "n_logged"]
    )


def compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _metric_log(spark, sf_dir).withColumn("step", F.expr("step div 50"))
    first = log.where(F.col("run") == "click")
    others = log.where(F.col("run") != "click").withColumn("kl", F.lit(0.0))
    named = ["click", "error", "purchase", "signup", "view"]
    return _all_rounded(runs.compare_runs([first, others], "loss", runs=named), ["step"])


def compare_all_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _metric_log(spark, sf_dir).withColumn("step", F.expr("step div 50"))
    return _all_rounded(runs.compare_runs([log], "loss"), ["step", "run"])


# Jobs


def summary_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = jobs.summary_batches(summary_pairs(spark, sf_dir), ["conv_id", "turn"])
    return planned.select(
        "conv_id", "turn", "text", "step", "micro_step",
        rounded(F.col("epoch_progress")).alias("epoch_progress"),
    )


# Streams


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return stream_corpus(spark, f"{sf_dir}/{name}.parquet", schema, max_files=1_000)


def stream_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = streams.stream_split(
        _stream(spark, sf_dir, "documents"), "doc_id", 0.1, 0
    )
    out = new_folder(spark, "split")
    streams.write_batches(labelled, out, new_folder(spark, "state")).awaitTermination()
    return with_md5(spark.read.parquet(out), "doc_id", "split")


def stream_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "shuffle")
    streams.stream_shuffle(
        _stream(spark, sf_dir, "documents"), "doc_id", 0, out,
        new_folder(spark, "state"),
    ).awaitTermination()
    return with_md5(spark.read.parquet(out), "doc_id", "batch_id", "shuffle_pos")


def stream_log_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = _stream(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"), (F.col("event_id") + 1).alias("step"),
        F.col("value").alias("loss"),
    )
    out = new_folder(spark, "windows")
    streams.stream_log_windows(
        steps, ["loss"], 50, out, new_folder(spark, "state"), run="run"
    ).awaitTermination()
    return _all_rounded(
        streams.latest(spark, out, ["run", "step"]), ["run", "step", "n_steps"]
    )


def stream_completion_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "steps")
    streams.stream_step_stats(
        _as_completions(_stream(spark, sf_dir, "documents")), out, new_folder(spark, "state")
    ).awaitTermination()
    return _all_rounded(
        streams.read_completion_windows(spark, out, 5), ["step", "n_steps"]
    )


def feed(df: DataFrame, key: str, start: Callable[[DataFrame], StreamingQuery],
         parts: int = 3) -> None:
    """``df`` as a stream that grows by ``parts`` in the order of ``key``.

    The query is started once per part and stops when it has read it, so all but the first start
    is a restart from the state of the one before.
    """
    spark, folder = df.sparkSession, new_folder(df.sparkSession, "fed")
    n, below = df.count(), F.lit(False)
    for part in range(1, parts + 1):
        last = nth_key(df, n * part // parts, [key]) if part < parts and n >= parts else None
        mine = ~below
        if last is not None:
            below = F.col(key) <= last[key]
            mine = mine & below
        df.where(mine).write.mode("append").parquet(folder)
        start(stream_corpus(spark, folder, df.schema)).awaitTermination()
        if last is None:
            break


def stream_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, state = new_folder(spark, "packed"), new_folder(spark, "state")
    feed(table(spark, sf_dir, "documents"), "doc_id", lambda texts: carried.stream_pack(
        texts, "text", "doc_id", out, state, 1024))
    return spark.read.parquet(out).select("chunk_id", digest(F.col("tokens")).alias("tokens_md5"))


def stream_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, state = new_folder(spark, "buffer"), new_folder(spark, "state")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    feed(documents, "doc_id", lambda rows: buffers.stream_buffer(
        rows, "doc_id", 0, out, state, buffer=100, shards=4))
    written = spark.read.parquet(out).drop("batch_id")
    left = buffers.drained(spark, state, documents, "doc_id")
    return with_md5(written.unionByName(left), "doc_id", "shard", "shuffle_pos")


def stream_cumulative_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, state = new_folder(spark, "totals"), new_folder(spark, "state")
    steps = table(spark, sf_dir, "documents").select(
        F.col("source").alias("run"), F.col("doc_id").alias("step"),
        tokens.token_count(F.col("text")).alias("n_tokens"))
    feed(steps, "step", lambda rows: carried.stream_cumulative_tokens(rows, out, state))
    return spark.read.parquet(out).select("run", "step", "num_tokens", "late")


def stream_windows_evicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, state = new_folder(spark, "windows"), new_folder(spark, "state")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    feed(documents, "doc_id", lambda rows: streams.stream_completion_windows(
        _as_completions(rows), 5, 20, out, state))
    return _all_rounded(spark.read.parquet(out).drop("batch_id"), ["step", "n_steps"])


def stream_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, state = new_folder(spark, "aligned"), new_folder(spark, "state")
    completions, targets = (
        _stream(spark, sf_dir, name).select("doc_id", column, F.col("doc_id").alias("number"))
        for name, column in (("documents", "n_chars"), ("labels", "quality")))
    streams.stream_alignment(
        completions, targets, "doc_id", "number", 50, out, state).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "status", "n_chars", "quality")


# Prepared tables and logs of any keys


def prepared_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = streams.stream_split(table(spark, sf_dir, "conversations"), "conv_id", 0.2, 0)
    openings = messages.groupBy("conv_id").agg(F.min_by("text", "turn").alias("opening"))
    names = []
    for df, order, parts in ((messages, "turn", "split"), (openings, (), ())):
        name, path = layout.new_table(spark)
        names.append(layout.write_layout(df, name, "conv_id", 8, order, parts, path))
    train = spark.table(names[0]).where("split = 'train'").join(spark.table(names[1]), "conv_id")
    return train.select("conv_id", "turn", F.md5("text").alias("text_md5"),
                        F.md5("opening").alias("opening_md5"))


def log_record_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    def or_null(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit("null"))

    kind = F.col("event_type")
    line = F.concat(
        F.lit('{"step":'), F.col("event_id").cast("string"), F.lit(',"run":"'), kind, F.lit('","'),
        kind, F.lit('/value":'), or_null(F.col("value")), F.lit(',"'), kind, F.lit('/k":'),
        or_null(F.get_json_object("props", "$.k")), F.lit("}"))
    folder = new_folder(spark, "lines")
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(folder)
    records = read_log_records(spark, folder, history=None).select(
        F.try_variant_get("record", "$.run", "string").alias("run"), "record")
    found = log_values(records).groupBy("run", "key").agg(
        F.count("*").alias("n"), F.min("step").alias("first_step"), F.max("step").alias("last_step"),
        F.avg("value").alias("mean"))
    return found.withColumn("mean", rounded(F.col("mean")))


# User-supplied Python


def map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = summary_pairs(spark, sf_dir)

    def shape(row: dict) -> dict:
        return {
            "conv_id": row["conv_id"], "turn": row["turn"],
            "text": f"{text.TLDR_PARTS[0]}{row['prompt']}"
                    f"{text.TLDR_PARTS[1]}{row['completion']}",
        }

    return hooks.map_rows(pairs, shape, "conv_id bigint, turn bigint, text string")


def reward_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    def share_of_letters_used(completions: list[str], **columns) -> list[float]:
        return [len(set(c)) / n for c, n in zip(completions, columns["n_chars"])]

    score = hooks.reward_udf(share_of_letters_used, ["n_chars"])
    return table(spark, sf_dir, "documents").select(
        "doc_id", rounded(score(F.col("text"))).alias("reward")
    )


def tokenize_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = hooks.tokenizer_udf(lambda t: [word for word in t.split(" ") if word])
    listed = table(spark, sf_dir, "documents").select(
        "doc_id", words(F.col("text")).alias("words")
    )
    return listed.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"),
        digest(F.col("words")).alias("words_md5"),
    )


def generate_with(spark: SparkSession, sf_dir: str) -> DataFrame:
    def answer(batch: pd.DataFrame) -> pd.DataFrame:
        first = batch["prompt"].str.extract(r"(<ID_\d+>)", expand=False)
        return batch[["doc_id", "gen_id", "target_id"]].assign(
            completion=batch["text"] + "So I select it.<END_THINK>\n" + first
        )

    asked = tasks.expand_generations(_tasks(spark, sf_dir), GENERATIONS).select(
        "doc_id", "gen_id", "target_id", "prompt", "text"
    )
    answered = hooks.generate_with(
        asked, answer, "doc_id bigint, gen_id int, target_id bigint, completion string"
    )
    return answered.select(
        "doc_id", "gen_id", F.md5("completion").alias("completion_md5"),
        rewards.task_reward(F.col("completion"), F.col("target_id")).alias("reward"),
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        corpus_stats, dialogue_pairs, qa_text, tldr_text, chat_prompt,
        chat_prompt_gen, strip_special, generated_part, generated_tokens, head_rows, take_skip,
        take_skip_sizes, fraction_split, fraction_split_wide, shuffle_positions,
        shuffle_blocks, repeat_epochs, repeat_until, batch_plan, batch_plan_generations,
        token_counts, chars_per_token, chunk_estimate, packed_chunks, packed_answers,
        packed_answers_epochs, packed_answers_by_head, train_chars_per_token, truncate_tokens,
        agent_tasks, agent_dataset, agent_dataset_graded, special_tokens,
        expand_generations, parse_action, task_reward, outcome_summary, accuracy,
        reward_alignment, alignment_report, agent_round, round_records, unique_chars, unique_chars_reward,
        combined_reward, group_reward_stats, group_advantage, preference_pairs,
        step_completion_stats, step_reward_stats, log_windows, cumulative_tokens, metric_deltas, run_summary,
        compare_runs, compare_all_runs, summary_batches, stream_split, stream_shuffle, stream_log_windows,
        stream_completion_windows, stream_pack, stream_buffer, stream_cumulative_tokens,
        stream_windows_evicted, stream_alignment, prepared_layout, log_record_values, map_rows, reward_udf, tokenize_udf, generate_with,
    )
}
