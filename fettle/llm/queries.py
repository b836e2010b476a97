"""The operators as queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from public_tokenizers import path as tokenizer_path

from fettle.llm.centroids import cluster, whole_vectors
from fettle.llm.decontaminate import contaminated
from fettle.llm.divergence import source_divergence
from fettle.llm.mixing import mix_sources
from fettle.llm.neardup import near_duplicates
from fettle.llm.paragraphs import repeated_passages
from fettle.llm.pieces import decode_pieces, encode_pieces
from fettle.llm.sharding import SLOTS, assign_shards, table_sql
from fettle.llm.substrings import repeated_strings
from fettle.llm.tokencount import token_counts
from fettle.llm.topk import quantized, top_inner_products
from fettle.llm.toxicity import fit_toxicity, held_out, score_toxicity
from fettle.llm.warc import read_archives, write_archives

TOXIC_FROM = 0.3
LENGTH_TILT = 1.0  # the entropy counts documents: long ones bear more of the change
SHARDS = [f"shard-{k:02d}" for k in range(24)]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that occurs in it."""
    return contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per occurrence of a passage that has others, with the occurrence that stays."""
    return repeated_passages(_read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document; labels that are held out are never learnt from."""
    docs = _read(spark, sf_dir, "documents")
    model = fit_toxicity(docs, _read(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
        "n_segments",
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts(_read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text without its repeated strings of 200 bytes."""
    return repeated_strings(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives, then reads every record back."""
    return read_archives(write_archives(_read(spark, sf_dir, "pages")))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows by integer inner product for every 50th vector."""
    vectors = _read(spark, sf_dir, "embeddings").select(
        "vec_id", quantized(F.col("embedding")).alias("embedding"))
    return top_inner_products(vectors, F.col("vec_id") % 50 == 0)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document, on shingles of two words."""
    return near_duplicates(_read(spark, sf_dir, "documents"), shingle_words=2)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its slot and shard; the text as its md5."""
    docs = _read(spark, sf_dir, "documents").select(
        "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), "source")
    return assign_shards(docs, "doc_id", SHARDS)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix of all sources takes."""
    return mix_sources(_read(spark, sf_dir, "documents"), length_tilt=LENGTH_TILT)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the text they decode to."""
    model = tokenizer_path("piece_bpe_32k.model")
    encoded = encode_pieces(_read(spark, sf_dir, "documents"), model)
    return decode_pieces(encoded, model).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "unlike",
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source is from the others of its language, and the terms that set it apart."""
    return source_divergence(_read(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector of 64 components after five rounds with 40 centroids."""
    vectors = _read(spark, sf_dir, "embeddings").select(
        "vec_id", whole_vectors(F.col("embedding"), 64).alias("embedding"))
    return cluster(vectors)


def _cluster_sql(clusters: int = 40, rounds: int = 5) -> str:
    """Centroids as rows (number, place, value); each round is two common table expressions."""
    steps = ["""
v AS (
  SELECT row_number() OVER () AS row, vec_id, e FROM (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
    FROM embeddings WHERE len(embedding) = 64
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
)""", f"""
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), e) - 1 AS number, e
  FROM v WHERE vec_id IS NOT NULL
  QUALIFY number < {clusters}
)"""]
    nearest = """
a{0} AS MATERIALIZED (
  SELECT row, min(struct_pack(distance, number)) AS best FROM (
    SELECT row, number, list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) ** 2))
      ::BIGINT AS distance
    FROM v, c{0} c) GROUP BY row
)"""
    for k in range(rounds):
        steps += [nearest.format(k), f"""
c{k + 1} AS MATERIALIZED (
  SELECT number, coalesce(moved, c.e) AS e FROM c{k} c LEFT JOIN (
    SELECT number, list(value ORDER BY place) AS moved FROM (
      SELECT number, place, ((s - ((s % n) + n) % n) // n)::BIGINT AS value FROM (
        SELECT best.number AS number, place, sum(e[place]) AS s, count(*) AS n
        FROM a{k} JOIN v USING (row), range(1, 65) t(place) GROUP BY ALL)
    ) GROUP BY number) USING (number)
)"""]
    steps.append(nearest.format(rounds))
    return "WITH " + ",".join(steps) + f"""
SELECT vec_id, best.number::INTEGER AS cluster, best.distance AS distance,
  (sum(best.distance) OVER (PARTITION BY best.number))::BIGINT AS cluster_inertia,
  (sum(best.distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (row) JOIN c{rounds} c ON number = best.number"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate, op2_paragraphs, op3_toxicity, op4_token_counts, op5_substrings,
        op6_warc, op7_top_k, op8_near_duplicates, op9_sharding, op10_mixing, op11_sentencepiece,
        op12_source_divergence, op13_centroids,
    )
}

SQL: dict[str, str] = {
    "op6_warc": """
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
  CASE WHEN page_id IS NOT DISTINCT FROM largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to,
  payload_digest
FROM (
  SELECT page_id, payload, max(page_id) OVER (PARTITION BY payload) AS largest,
    (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
        ('0x' || substr(sha1(payload) || '0000', 1 + 5 * (g // 4), 5))::BIGINT
        >> (15 - 5 * (g % 4)) & 31)::INTEGER, 1), '' ORDER BY g)
     FROM range(32) t(g)) AS payload_digest
  FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages)
)""",
    "op7_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
  AS rank, vec_id, score
FROM s QUALIFY rank <= 5""",
    "op8_near_duplicates": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 1
    THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS shingle
  FROM words
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
sized AS MATERIALIZED (SELECT doc_id, shingle, n FROM sets JOIN sizes USING (doc_id)),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sized a JOIN sized b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), sides AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(a, b) AS (
  SELECT a, b FROM sides UNION SELECT r.a, s.b FROM reached r JOIN sides s ON s.a = r.b
), smallest AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, b) AS component_id,
  d.doc_id = least(d.doc_id, b) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN smallest ON a = d.doc_id""",
    "op9_sharding": f"""
SELECT doc_id, md5(coalesce(text, '')) AS text_md5, source, slot, shard
FROM (
  SELECT *, ('0x' || substr(md5('0|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT
    % {SLOTS} AS slot
  FROM documents
) JOIN ({table_sql(SHARDS)}) USING (slot)""",
    "op12_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce("text", '') AS body FROM documents
), t AS MATERIALIZED (
  SELECT doc, lang, source, translate(unnest(regexp_extract_all(
      body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d
), kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT doc) >= 3
), groups AS (SELECT DISTINCT lang, source FROM d),
counted AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
vocabulary AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counted GROUP BY ALL),
shares AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(s.total, 0) + v.v)) AS p,
    (1 + (1000000000::HUGEINT * (k.n + 1)) // (v.total + v.v)) AS q
  FROM groups g JOIN kept k USING (lang) JOIN vocabulary v USING (lang)
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN totals s ON s.lang = g.lang AND s.source = g.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY ALL
  ) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
  FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (
  PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (FROM pairs UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= 200""",
    "op13_centroids": _cluster_sql(),
}
