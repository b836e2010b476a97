"""The catalogue's queries as plain SQL over the same tables, for DuckDB.

Written from the definition of each operator, with windows over whole tables where the Spark
side avoids them.
"""

from __future__ import annotations

TOKENS = r"regexp_extract_all({}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s]')"
DOCUMENT_TOKENS = TOKENS.format("text")
NEWLINE = "chr(10)"

PAIRS = """
pairs AS (
  SELECT conv_id, turn, text AS question, next_text AS response_j
  FROM (
    SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
  ) WHERE role = 'user' AND next_role = 'assistant'
)"""

QA = f"'Question: ' || question || {NEWLINE} || {NEWLINE} || 'Answer: ' || response_j"
TLDR = f"'Post: ' || question || {NEWLINE} || {NEWLINE} || 'TL;DR: ' || response_j"


def _chat(opening: str) -> str:
    return f"""
SELECT conv_id, 0::BIGINT AS part,
  CASE WHEN arg_min(role, turn) <> 'system'
       THEN '<|im_start|>system' || {NEWLINE} || 'You are a helpful assistant.<|im_end|>'
            || {NEWLINE}
       ELSE '' END
  || string_agg('<|im_start|>' || role || {NEWLINE} || text || '<|im_end|>' || {NEWLINE}, ''
                ORDER BY turn)
  || {opening} AS prompt
FROM conversations GROUP BY conv_id"""


def _packed(texts: str, group: str, length: int) -> str:
    """Every token on a row of its own, numbered over the whole stream, then cut."""
    return f"""
WITH texts AS ({texts}),
stream AS (
  SELECT {group} AS grp, pos, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i
  FROM (SELECT *, list_append({TOKENS.format("text")}, '<eos>') AS toks FROM texts)
),
numbered AS (
  SELECT grp, tok, row_number() OVER (PARTITION BY grp ORDER BY pos, i) - 1 AS n FROM stream
)
SELECT grp, n // {length} AS chunk_id, md5(string_agg(tok, ' ' ORDER BY n)) AS tokens_md5
FROM numbered GROUP BY grp, n // {length} HAVING count(*) = {length}"""


def _hash_number(*keys: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(keys)})), 1, 8))::BIGINT"


def _tasks(difficulty: str, columns: str = "") -> str:
    draw = f"{_hash_number(chr(39) + '7' + chr(39), 'doc_id', 'j')} % j + 1"
    return f"""
sizes AS (SELECT doc_id, text, least({difficulty} + 1, 299) AS k{columns} FROM documents),
drawn AS (
  SELECT *, list_transform(range(301 - k, 301), lambda j: {{'j': j, 'd': {draw}}}) AS draws
  FROM sizes
),
tasks AS (
  SELECT *, list_sort(list_reduce(
      draws,
      lambda taken, x: list_append(taken, CASE WHEN list_contains(taken, x.d) THEN x.j
                                               ELSE x.d END),
      []::BIGINT[])) AS item_ids
  FROM drawn
),
shown AS (
  SELECT *, item_ids[1] AS target_id, array_to_string(item_ids, ' ') AS item_ids_str,
    array_to_string(list_transform(item_ids, lambda i: '<ID_' || i || '>'), ' ') AS ids
  FROM tasks
),
agent AS (
  SELECT *, '<|obs|>' || ids || '<|agent|><THINK>The items are ' || ids
    || '. I need to identify the first item and select it.<END_THINK>' AS prompt
  FROM shown
)"""


TASKS = _tasks("4")
_SEVEN = "'7'"
COMPLETIONS = f"""{TASKS},
asked AS (
  SELECT agent.*, g::INTEGER AS gen_id FROM agent, range(4) AS r(g)
),
completions AS (
  SELECT *, text || CASE {_hash_number(_SEVEN, 'doc_id', 'gen_id')} % 3
      WHEN 0 THEN 'It is the first one.<END_THINK> <ID_' || target_id || '>'
      WHEN 1 THEN '<END_THINK><ID_' || (target_id % 300 + 1) || '>'
      ELSE '<ID_' || target_id || '>' END AS completion
  FROM asked
),
parsed AS (
  SELECT *, regexp_extract(completion, '<END_THINK>\\s*<ID_(\\d+)>', 1) AS digits
  FROM completions
),
judged AS (
  SELECT *, digits <> '' AS matched, try_cast(digits AS BIGINT) AS action,
    CASE WHEN digits = '' THEN -1.0 WHEN try_cast(digits AS BIGINT) = target_id THEN 1.0
         ELSE -0.5 END::DOUBLE AS reward,
    CASE WHEN digits = '' THEN 'INVALID ACTION'
         WHEN try_cast(digits AS BIGINT) = target_id THEN 'CORRECT'
         ELSE 'INCORRECT' END AS outcome
  FROM parsed
)"""

UNIQUE = "len(list_distinct(regexp_extract_all(text, '(?s).')))"
SCALED = f"least({UNIQUE} / 100.0::DOUBLE, 1.0::DOUBLE)"
SCORED = f"""
scored AS (
  SELECT *, doc_id // 4 AS prompt_id, doc_id % 4 AS gen_id, {SCALED} AS reward
  FROM documents
)"""

STEP_STATS = f"""
lengths AS (
  SELECT doc_id // 2 + 1 AS step, len({DOCUMENT_TOKENS}) AS full_length FROM documents
),
stats AS (
  SELECT step,
    avg(CASE WHEN full_length >= 128 THEN 1.0::DOUBLE ELSE 0.0 END)
      AS completions__clipped_ratio,
    min(least(full_length, 128))::DOUBLE AS completions__min_length,
    avg(least(full_length, 128)) AS completions__mean_length,
    max(least(full_length, 128))::DOUBLE AS completions__max_length,
    coalesce(min(full_length) FILTER (full_length < 128), 0)::DOUBLE
      AS completions__min_terminated_length,
    coalesce(avg(full_length) FILTER (full_length < 128), 0)::DOUBLE
      AS completions__mean_terminated_length,
    coalesce(max(full_length) FILTER (full_length < 128), 0)::DOUBLE
      AS completions__max_terminated_length
  FROM lengths GROUP BY step
)"""
STAT_NAMES = [
    "clipped_ratio", "min_length", "mean_length", "max_length", "min_terminated_length",
    "mean_terminated_length", "max_terminated_length",
]
LOG_WINDOWS = f"""
WITH {STEP_STATS}
SELECT ((step - 1) // 5 + 1) * 5 AS step, count(*) AS n_steps,
  {', '.join(f'round(avg(completions__{n}), 6) AS completions__{n}' for n in STAT_NAMES)}
FROM stats GROUP BY (step - 1) // 5"""

SPLIT_ROWS = """
SELECT {keys}, md5(text) AS text_md5,
  CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', '{seed}', {keys})), {keys})
    <= ceil({size}::DOUBLE * (SELECT count(*) FROM {table})) THEN 'test' ELSE 'train' END AS split
FROM {table}"""

METRIC_LOG = """
log AS (SELECT event_type AS run, event_id AS step, value AS loss FROM events)"""

BATCH_PLAN = """
SELECT {keys}, md5(text) AS text_md5, s // {step} + 1 AS step, s // {batch} % {accum} AS micro_step,
  round(least((s // {step} + 1) * {step}, total) / total::DOUBLE, 6) AS epoch_progress
FROM samples"""


def _plan(keys: str, batch: int, accum: int) -> str:
    return BATCH_PLAN.format(keys=keys, batch=batch, accum=accum, step=batch * accum)


SQL: dict[str, str] = {
    "corpus_stats": """
SELECT (SELECT count(*) FROM documents) AS n_rows,
  'doc_id,text,lang,source,n_chars' AS column_names,
  doc_id AS first_doc_id, text AS first_text
FROM documents ORDER BY doc_id LIMIT 1""",
    "dialogue_pairs": f"WITH {PAIRS} SELECT * FROM pairs",
    "qa_text": f"WITH {PAIRS} SELECT conv_id, turn, {QA} AS text FROM pairs",
    "tldr_text": f"WITH {PAIRS} SELECT conv_id, turn, {TLDR} AS text FROM pairs",
    "chat_prompt": _chat("''"),
    "chat_prompt_gen": _chat(f"'<|im_start|>assistant' || {NEWLINE}"),
    "strip_special": f"""
WITH chats AS ({_chat("''")})
SELECT conv_id, part, regexp_replace(prompt, '<\\|im_start\\|>|<\\|im_end\\|>', '', 'g') AS plain
FROM chats""",
    "generated_part": f"""
WITH {PAIRS}, texts AS (SELECT *, {QA} AS text FROM pairs)
SELECT conv_id, turn, substr(text, length('Question: ' || question || 'Answer: ') + 3) AS answer
FROM texts""",
    "generated_tokens": f"""
WITH {PAIRS}
SELECT conv_id, turn,
  md5(array_to_string({TOKENS.format("response_j")}, ' ')) AS tokens_md5
FROM pairs""",
    "head_rows": "SELECT * FROM documents ORDER BY doc_id LIMIT 100",
    "take_skip": """
SELECT conv_id, turn, md5(text) AS text_md5,
  CASE WHEN row_number() OVER (ORDER BY conv_id, turn) <= 400 THEN 'take' ELSE 'skip' END AS split
FROM conversations""",
    "take_skip_sizes": """
WITH numbered AS (SELECT row_number() OVER (ORDER BY event_id) AS n FROM events)
SELECT CASE WHEN n <= 4000 THEN 'take' ELSE 'skip' END AS split, count(*) AS n_rows
FROM numbered GROUP BY 1""",
    "fraction_split": SPLIT_ROWS.format(keys="doc_id", seed=0, size=0.005, table="documents"),
    "fraction_split_wide": SPLIT_ROWS.format(
        keys="conv_id, turn", seed=3, size=0.37, table="conversations"
    ),
    "shuffle_positions": """
SELECT doc_id, md5(text) AS text_md5, row_number() OVER (ORDER BY md5('0|' || doc_id), doc_id) - 1 AS shuffle_pos
FROM documents""",
    "shuffle_blocks": """
WITH blocks AS (
  SELECT *, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 500 AS block FROM conversations
)
SELECT conv_id, turn, md5(text) AS text_md5, block, block * 500 - 1
  + row_number() OVER (
      PARTITION BY block ORDER BY md5(concat_ws('|', '0', conv_id, turn)), conv_id, turn)
  AS shuffle_pos
FROM blocks""",
    "repeat_epochs": """
SELECT doc_id, md5(text) AS text_md5, e::INTEGER AS epoch FROM documents, range(3) AS r(e)""",
    "repeat_until": """
WITH sized AS (
  SELECT doc_id, md5(text) AS text_md5, row_number() OVER (ORDER BY doc_id) - 1 AS n,
    count(*) OVER () AS total
  FROM documents
),
placed AS (
  SELECT doc_id, text_md5, e::INTEGER AS epoch, e * total + n AS position
  FROM sized, range((SELECT (40000 + total - 1) // total FROM sized LIMIT 1)) AS r(e)
)
SELECT * FROM placed WHERE position < 40000""",
    "batch_plan": f"""
WITH {PAIRS},
samples AS (
  SELECT *, {QA} AS text, row_number() OVER (ORDER BY conv_id, turn) - 1 AS s,
    count(*) OVER () AS total
  FROM pairs QUALIFY s < total // 4 * 4
)
{_plan("conv_id, turn", 4, 1)}""",
    "batch_plan_generations": f"""
WITH rows AS (
  SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS n,
    count(*) OVER () * 4 AS total
  FROM documents
),
samples AS (
  SELECT doc_id, text, g::INTEGER AS gen_id, n * 4 + g AS s, total FROM rows, range(4) AS r(g)
)
{_plan("doc_id, gen_id", 2, 2)}""",
    "token_counts": f"SELECT doc_id, len({DOCUMENT_TOKENS}) AS n_tokens FROM documents",
    "chars_per_token": f"""
WITH first AS (SELECT text FROM documents ORDER BY doc_id LIMIT 400)
SELECT sum(length(text))::BIGINT AS n_chars, sum(len({DOCUMENT_TOKENS}))::BIGINT AS n_tokens,
  round(sum(length(text)) / sum(len({DOCUMENT_TOKENS}))::DOUBLE, 6) AS chars_per_token
FROM first""",
    "chunk_estimate": f"""
WITH first AS (SELECT text FROM documents ORDER BY doc_id LIMIT 400),
ratio AS (
  SELECT sum(length(text)) / sum(len({DOCUMENT_TOKENS}))::DOUBLE AS chars_per_token FROM first
)
SELECT sum(length(text))::BIGINT AS n_chars,
  round(sum(length(text)) / any_value(chars_per_token) / 1024, 6) AS expected_chunks
FROM documents, ratio""",
    "packed_chunks": f"""
SELECT chunk_id, tokens_md5 FROM (
{_packed("SELECT doc_id AS pos, text FROM documents", "0", 1024)})""",
    "packed_answers": f"""
SELECT grp AS split, chunk_id, tokens_md5 FROM ({_packed(f'''
  WITH {PAIRS}
  SELECT CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', '0', conv_id, turn)),
                                      conv_id, turn)
           <= ceil(0.2::DOUBLE * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split,
    row(md5(concat_ws('|', '0', conv_id, turn)), conv_id, turn) AS pos, {QA} AS text
  FROM pairs''', "split", 256)})""",
    "packed_answers_epochs": f"""
SELECT grp AS split, chunk_id, tokens_md5 FROM ({_packed(f'''
  WITH {PAIRS},
  labelled AS (
    SELECT *, {QA} AS text, CASE WHEN row_number() OVER (
        ORDER BY md5(concat_ws('|', '0', conv_id, turn)), conv_id, turn)
      <= ceil(0.2::DOUBLE * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
    FROM pairs
  )
  SELECT split, text, row(e, CASE e WHEN 0 THEN md5(concat_ws('|', '0', conv_id, turn))
      ELSE md5(concat_ws('|', '0', conv_id, turn, e)) END, conv_id, turn) AS pos
  FROM labelled, range(2) AS r(e) WHERE split = 'train' OR e = 0''', "split", 256)})
WHERE grp <> 'train' OR chunk_id < 30""",
    "train_chars_per_token": f"""
WITH {PAIRS},
ranked AS (
  SELECT {QA} AS text, count(*) OVER () AS total, row_number() OVER (
    ORDER BY md5(concat_ws('|', '0', conv_id, turn)), conv_id, turn) AS n
  FROM pairs
),
first AS (
  SELECT text FROM ranked WHERE n > ceil(0.2::DOUBLE * total) ORDER BY n LIMIT 400
)
SELECT sum(length(text))::BIGINT AS n_chars, sum(len({TOKENS.format("text")}))::BIGINT AS n_tokens,
  round(sum(length(text)) / sum(len({TOKENS.format("text")}))::DOUBLE, 6) AS chars_per_token
FROM first""",
    "packed_answers_by_head": f"""
SELECT grp AS split, chunk_id, tokens_md5 FROM ({_packed(f'''
  WITH {PAIRS},
  placed AS (
    SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS n FROM pairs
  )
  SELECT CASE WHEN n < 100 THEN 'valid' ELSE 'train' END AS split, {QA} AS text,
    CASE WHEN n < 100 THEN row(n, '')
         ELSE row((n - 100) // 50, md5(concat_ws('|', '0', conv_id, turn))) END AS pos
  FROM placed''', "split", 256)})""",
    "truncate_tokens": f"""
WITH listed AS (SELECT doc_id, {DOCUMENT_TOKENS} AS toks FROM documents)
SELECT doc_id, md5(array_to_string(toks[greatest(len(toks) - 255, 1):], ' ')) AS prompt_md5,
  md5(array_to_string(toks[:128], ' ')) AS completion_md5,
  least(len(toks), 128) AS completion_length, len(toks) >= 128 AS clipped
FROM listed""",
    "agent_tasks": f"""
WITH {TASKS} SELECT doc_id, len(item_ids) AS n_items, target_id FROM agent""",
    "agent_dataset": f"""
WITH {TASKS} SELECT doc_id, prompt, target_id, item_ids_str FROM agent""",
    "agent_dataset_graded": f"""
WITH {_tasks("least(n_chars // 100, 320)", ", n_chars")}
SELECT doc_id, target_id, item_ids_str FROM agent""",
    "special_tokens": f"""
WITH {TASKS},
vocabulary AS (
  SELECT unnest(['<|obs|>', '<|agent|>', '<THINK>', '<END_THINK>', '<|pad|>']) AS token,
    'protocol' AS kind, NULL::BIGINT AS item_id
  UNION ALL SELECT '<ID_' || i || '>', 'item', i FROM range(1, 301) AS r(i)
)
SELECT token, kind, item_id,
  (SELECT coalesce(sum((length(prompt) - length(replace(prompt, token, '')))
                       // length(token)), 0)::BIGINT FROM agent) AS n_uses
FROM vocabulary""",
    "expand_generations": f"""
WITH {TASKS} SELECT doc_id, g::INTEGER AS gen_id, prompt FROM agent, range(4) AS r(g)""",
    "parse_action": f"""
WITH {COMPLETIONS} SELECT doc_id, gen_id, matched, action FROM judged""",
    "task_reward": f"WITH {COMPLETIONS} SELECT doc_id, gen_id, reward FROM judged",
    "outcome_summary": f"""
WITH {COMPLETIONS}
SELECT gen_id, outcome, count(*) AS n,
  round(count(*) / (sum(count(*)) OVER (PARTITION BY gen_id))::DOUBLE, 6) AS share
FROM judged GROUP BY gen_id, outcome""",
    "accuracy": f"""
WITH {COMPLETIONS}
SELECT gen_id, round(avg((outcome = 'CORRECT')::INTEGER), 6) AS accuracy
FROM judged GROUP BY gen_id""",
    "reward_alignment": f"""
WITH {COMPLETIONS}
SELECT c.doc_id, c.gen_id, t.target_id, c.reward
FROM judged c JOIN agent t ON t.doc_id = c.doc_id""",
    "alignment_report": """
SELECT
  (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) AS n_aligned,
  (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
    AS n_without_target,
  (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))
    AS n_without_completion,
  (SELECT count(*) FROM (SELECT doc_id FROM labels GROUP BY doc_id HAVING count(*) > 1))
    AS n_repeated_targets""",
    "agent_round": f"""
WITH {COMPLETIONS}
SELECT doc_id, gen_id, reward, outcome,
  round((reward - avg(reward) OVER w) / (stddev_samp(reward) OVER w + 1e-4), 6) + 0::DOUBLE AS advantage
FROM judged WINDOW w AS (PARTITION BY doc_id)""",
    "round_records": f"""
WITH {COMPLETIONS},
samples AS (
  SELECT doc_id, reward, len({TOKENS.format("prompt")}) AS p, len({TOKENS.format("completion")}) AS w,
    row_number() OVER (ORDER BY doc_id, gen_id) - 1 AS s, count(*) OVER () AS total
  FROM judged
),
planned AS (
  SELECT *, s // 4 + 1 AS step, least(w, 128) AS n, w >= 128 AS clipped FROM samples
  WHERE s // 2 < total // 2
),
deviations AS (
  SELECT step, avg(sd) AS reward_std FROM (
    SELECT step, doc_id, stddev_samp(reward) AS sd FROM planned GROUP BY ALL) GROUP BY step
),
steps AS (
  SELECT step, avg(clipped::INTEGER) AS clipped_ratio, min(n)::DOUBLE AS min_length,
    avg(n) AS mean_length, max(n)::DOUBLE AS max_length,
    coalesce(min(n) FILTER (NOT clipped), 0)::DOUBLE AS min_terminated_length,
    coalesce(avg(n) FILTER (NOT clipped), 0)::DOUBLE AS mean_terminated_length,
    coalesce(max(n) FILTER (NOT clipped), 0)::DOUBLE AS max_terminated_length,
    avg(reward) AS reward, stddev_samp(reward) AS deviation, sum(p + n) AS tokens,
    max(least(step * 4, total) / total::DOUBLE) AS epoch
  FROM planned GROUP BY step
),
running AS (
  SELECT *, sum(tokens) OVER (ORDER BY step) AS num_tokens FROM steps JOIN deviations USING (step)
)
SELECT ((step - 1) // 5 + 1) * 5 AS step, count(*) AS n_steps,
  {', '.join(f'round(avg({n}), 6) + 0::DOUBLE AS completions__{n}' for n in STAT_NAMES)},
  round(avg(reward), 6) + 0::DOUBLE AS reward, round(avg(reward_std), 6) AS reward_std,
  round(avg(reward), 6) + 0::DOUBLE AS rewards__task_reward__mean,
  round(avg(deviation), 6) AS rewards__task_reward__std,
  round(arg_max(epoch, step), 6) AS epoch, arg_max(num_tokens, step)::BIGINT AS num_tokens
FROM running GROUP BY (step - 1) // 5""",
    "unique_chars": f"SELECT doc_id, {UNIQUE} AS unique_chars FROM documents",
    "unique_chars_reward": f"SELECT doc_id, round({SCALED}, 6) AS reward FROM documents",
    "combined_reward": f"""
SELECT doc_id, {UNIQUE}::DOUBLE AS unique_chars, round({SCALED}, 6) AS unique_chars_reward,
  round({UNIQUE} * 0.5::DOUBLE + {SCALED}, 6) AS reward
FROM documents""",
    "group_reward_stats": f"""
WITH {SCORED}
SELECT prompt_id, count(*) AS n, round(avg(reward), 6) AS reward_mean,
  round(stddev_samp(reward), 6) AS reward_std
FROM scored GROUP BY prompt_id""",
    "group_advantage": f"""
WITH {SCORED}
SELECT doc_id, round(coalesce(
  (reward - avg(reward) OVER w) / (stddev_samp(reward) OVER w + 1e-4), 0), 6)
  + 0::DOUBLE AS advantage
FROM scored WINDOW w AS (PARTITION BY prompt_id)""",
    "preference_pairs": f"""
WITH {SCORED},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY prompt_id ORDER BY reward DESC, gen_id) AS best,
    row_number() OVER (PARTITION BY prompt_id ORDER BY reward, gen_id) AS worst,
    row_number() OVER (PARTITION BY prompt_id ORDER BY gen_id) AS first
  FROM scored
)
SELECT prompt_id, max(source) FILTER (first = 1) AS question,
  max(text) FILTER (best = 1) AS response_j, max(text) FILTER (worst = 1) AS response_k
FROM ranked GROUP BY prompt_id HAVING max(reward) > min(reward)""",
    "step_completion_stats": f"""
WITH {STEP_STATS}
SELECT step,
  {', '.join(f'round(completions__{n}, 6) AS completions__{n}' for n in STAT_NAMES)}
FROM stats""",
    "step_reward_stats": f"""
WITH {SCORED},
by_prompt AS (
  SELECT prompt_id // 2 + 1 AS step, stddev_samp(reward) AS std FROM scored GROUP BY prompt_id
),
deviations AS (SELECT step, avg(std) AS std FROM by_prompt GROUP BY step)
SELECT s.step, round(avg(reward), 6) AS reward,
  round(avg(reward), 6) AS rewards__unique_chars__mean,
  round(stddev_samp(reward), 6) AS rewards__unique_chars__std,
  round(any_value(d.std), 6) AS reward_std
FROM (SELECT *, prompt_id // 2 + 1 AS step FROM scored) s JOIN deviations d ON d.step = s.step
GROUP BY s.step""",
    "log_windows": LOG_WINDOWS,
    "cumulative_tokens": f"""
WITH steps AS (SELECT source AS run, doc_id AS step, len({DOCUMENT_TOKENS}) AS n FROM documents)
SELECT run, step, (sum(n) OVER (PARTITION BY run ORDER BY step))::BIGINT AS num_tokens
FROM steps""",
    "metric_deltas": f"""
WITH {METRIC_LOG}
SELECT run, step, round(loss, 6) AS loss, round(lag(loss) OVER w, 6) AS previous,
  round(loss - lag(loss) OVER w, 6) AS delta
FROM log WINDOW w AS (PARTITION BY run ORDER BY step)""",
    "run_summary": f"""
WITH {METRIC_LOG}
SELECT run, 'loss' AS metric, count(loss) AS n_logged,
  round(arg_min(loss, step), 6) AS first_value, round(arg_max(loss, step), 6) AS last_value,
  round(arg_max(loss, step) - arg_min(loss, step), 6) AS change
FROM log GROUP BY run""",
    "compare_runs": f"""
WITH {METRIC_LOG}
SELECT step // 50 AS step,
  {', '.join(f"round(avg(loss) FILTER (run = '{run}'), 6) AS {run}"
             for run in ("click", "error", "purchase", "signup", "view"))}
FROM log GROUP BY step // 50""",
    "compare_all_runs": f"""
WITH {METRIC_LOG}
SELECT step // 50 AS step, run, round(avg(loss), 6) AS loss FROM log GROUP BY step // 50, run""",
    "summary_batches": f"""
WITH {PAIRS},
head AS (SELECT * FROM pairs ORDER BY conv_id, turn LIMIT 100),
samples AS (
  SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS s, count(*) OVER () AS total
  FROM head
)
SELECT conv_id, turn, {TLDR} AS text, s // 4 + 1 AS step, s % 4 AS micro_step,
  round(least((s // 4 + 1) * 4, total) / total::DOUBLE, 6) AS epoch_progress
FROM samples WHERE s // 4 + 1 <= 20""",
    "stream_split": f"""
SELECT doc_id, md5(text) AS text_md5,
  CASE WHEN {_hash_number("'0'", "doc_id")} < {int(0.1 * 16**8)}
  THEN 'test' ELSE 'train' END AS split
FROM documents""",
    "stream_shuffle": """
SELECT doc_id, md5(text) AS text_md5, 0 AS batch_id,
  row_number() OVER (ORDER BY md5('0|' || doc_id), doc_id) - 1 AS shuffle_pos
FROM documents""",
    "stream_log_windows": f"""
WITH {METRIC_LOG}
SELECT run, (step // 50 + 1) * 50 AS step, count(*) AS n_steps, round(avg(loss), 6) AS loss
FROM log GROUP BY run, step // 50""",
    "stream_completion_windows": LOG_WINDOWS,
    "stream_pack": f"""
SELECT chunk_id, tokens_md5 FROM (
{_packed("SELECT doc_id AS pos, text FROM documents", "0", 1024)})""",
    "stream_buffer": """
WITH hashed AS (SELECT doc_id, text, md5('0|' || doc_id) AS h FROM documents),
sharded AS (
  SELECT *, (('0x' || substr(h, 1, 8))::BIGINT % 4)::INTEGER AS shard,
    ('0x' || substr(h, 9, 8))::BIGINT % 100 AS delay FROM hashed
),
leaving AS (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 + delay AS leaves FROM sharded
)
SELECT doc_id, shard, md5(text) AS text_md5,
  row_number() OVER (PARTITION BY shard ORDER BY leaves, h, doc_id) - 1 AS shuffle_pos
FROM leaving""",
    "stream_cumulative_tokens": f"""
WITH steps AS (SELECT source AS run, doc_id AS step, len({DOCUMENT_TOKENS}) AS n FROM documents)
SELECT run, step, (sum(n) OVER (PARTITION BY run ORDER BY step))::BIGINT AS num_tokens, false AS late
FROM steps""",
    "stream_windows_evicted": f"""
SELECT * FROM ({LOG_WINDOWS}) WHERE step + 1 <= (SELECT max(doc_id // 2 + 1) FROM documents) - 20""",
    "stream_alignment": """
WITH closed AS (
  SELECT least((SELECT max(doc_id) FROM documents), (SELECT max(doc_id) FROM labels)) - 100 AS last
)
SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, n_chars, quality,
  CASE WHEN l.doc_id IS NULL THEN 'without_target' WHEN d.doc_id IS NULL THEN 'without_completion'
       ELSE 'aligned' END AS status
FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id
WHERE d.doc_id = l.doc_id OR coalesce(d.doc_id, l.doc_id) < (SELECT last FROM closed)""",
    "prepared_layout": f"""
SELECT conv_id, turn, md5(text) AS text_md5,
  md5(arg_min(text, turn) OVER (PARTITION BY conv_id)) AS opening_md5
FROM conversations WHERE {_hash_number("'0'", "conv_id")} >= {int(0.2 * 16**8)}""",
    "log_record_values": """
SELECT run, key, count(*) AS n, min(step) AS first_step, max(step) AS last_step,
  round(avg(v), 6) + 0::DOUBLE AS mean
FROM (
  SELECT event_type AS run, event_id AS step, event_type || '/value' AS key, value AS v FROM events
  UNION ALL
  SELECT event_type, event_id, event_type || '/k', (props ->> '$.k')::DOUBLE FROM events
) WHERE v IS NOT NULL GROUP BY run, key""",
    "map_rows": f"WITH {PAIRS} SELECT conv_id, turn, {TLDR} AS text FROM pairs",
    "reward_udf": f"""
SELECT doc_id, round({UNIQUE} / n_chars::DOUBLE, 6) AS reward FROM documents""",
    "tokenize_udf": """
WITH listed AS (
  SELECT doc_id, list_filter(string_split(text, ' '), lambda w: w <> '') AS words FROM documents
)
SELECT doc_id, len(words) AS n_words, md5(array_to_string(words, ' ')) AS words_md5 FROM listed""",
    "generate_with": f"""
WITH {TASKS}
SELECT doc_id, g::INTEGER AS gen_id,
  md5(text || 'So I select it.<END_THINK>' || {NEWLINE} || '<ID_' || target_id || '>')
    AS completion_md5,
  1.0::DOUBLE AS reward
FROM agent, range(4) AS r(g)""",
}
