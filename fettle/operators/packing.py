"""Characters per token and packing into constant-length chunks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fettle.functions.hashing import columns_of
from fettle.functions.tokens import tokenize
from fettle.operators.ordered import join_null_safe, running_total
from fettle.operators.split import head_rows
from fettle.shared import cut


def chars_per_token(df: DataFrame, text: str, order_by: str | Sequence[str], n: int = 400,
                    tokenizer: Callable[[Column], Column] = tokenize) -> DataFrame:
    """One row: characters, tokens and their ratio over the first ``n`` texts of the order.

    The ratio is one of sums, not a mean of ratios; without a token it is null.
    """
    order = columns_of(order_by)
    head = head_rows(df.select(*dict.fromkeys([*order, text])), n, order)
    sums = head.agg(
        F.sum(F.length(text)).alias("n_chars"),
        F.sum(F.size(tokenizer(F.col(text)))).alias("n_tokens"),
    )
    return sums.withColumn("chars_per_token", F.try_divide("n_chars", "n_tokens"))


def chunk_estimate(df: DataFrame, text: str, order_by: str | Sequence[str],
                   seq_length: int = 1024, n: int = 400,
                   tokenizer: Callable[[Column], Column] = tokenize) -> DataFrame:
    """One row: characters of all texts, and the chunks to expect of them by the ratio of the
    first ``n``. Only those are tokenized."""
    ratio = chars_per_token(df, text, order_by, n, tokenizer).first()["chars_per_token"]
    return df.agg(F.sum(F.length(text)).alias("n_chars")).withColumn(
        "expected_chunks", F.col("n_chars") / F.lit(ratio) / F.lit(seq_length)
    )


def pack_sequences(df: DataFrame, text: str, order_by: str | Sequence[str],
                   seq_length: int = 1024, sep: str = "<eos>",
                   group_by: str | Sequence[str] = (),
                   tokenizer: Callable[[Column], Column] = tokenize) -> DataFrame:
    """(group, ``chunk_id``, ``tokens``): texts joined in order and cut every ``seq_length``.

    Our definition: the tokens of each text and a separator, one text after the other inside a
    group; the remainder that does not fill a chunk is left out. A null text counts as empty.

    First only token counts are summed up, to give each text its start in the stream. Then a
    text is cut at the chunk borders it crosses, so it yields one row per chunk it touches, not
    one per token, and a chunk gathers at most ``seq_length`` such pieces. (group, order) must
    be unique.
    """
    chunks = all_chunks(df, text, order_by, seq_length, sep, group_by, tokenizer)
    return chunks.where(F.size("tokens") == seq_length)


def all_chunks(df: DataFrame, text: str, order_by: str | Sequence[str], seq_length: int = 1024,
               sep: str = "<eos>", group_by: str | Sequence[str] = (),
               tokenizer: Callable[[Column], Column] = tokenize,
               carried: DataFrame | None = None) -> DataFrame:
    """As ``pack_sequences``, with the last chunk of each group even if it is not filled.

    ``carried`` (group, ``chunk_id``, ``tokens``) holds the unfilled chunks an earlier call left:
    the texts of a group go on where its own one ends, and it comes back where it has no text.
    """
    if seq_length < 1:
        raise ValueError("seq_length must be at least 1")
    order, groups = columns_of(order_by), columns_of(group_by)
    keys = [*groups, *order]
    # Tokens of the default tokenizer have no spaces, so they can travel as one string, which is
    # far smaller than an array of strings.
    as_text = tokenizer is tokenize and not any(c.isspace() for c in sep)
    filled = tokenizer(F.coalesce(F.col(text), F.lit("")))
    listed = df.select(*keys, F.concat(filled, F.array(F.lit(sep))).alias("__tokens"))
    # Tokenized once: finding range borders reads its input a second time, and the tokens are
    # placed when the sums are known.
    texts = cut(listed.select(*keys, F.size("__tokens").cast("bigint").alias("__n"), (
        F.array_join("__tokens", " ") if as_text else F.col("__tokens")).alias("__tokens")))
    starts = running_total(texts, F.col("__n"), order, groups, name="__start")

    if carried is not None:
        before = carried.select(*groups, (
            F.col("chunk_id") * seq_length + F.size("tokens")).alias("__before"))
        starts = (join_null_safe(starts, before, groups, "left") if groups
                  else starts.join(before, F.lit(True), "left"))
        starts = starts.select(
            *keys, (F.col("__start") + F.coalesce("__before", F.lit(0))).alias("__start"))
    texts = texts.drop("__n")
    placed = join_null_safe(texts, starts, keys) if groups else texts.join(starts, keys)
    streams = placed.select(
        *groups,
        "__start",
        (F.split("__tokens", " ") if as_text else F.col("__tokens")).alias("__tokens"),
    )
    if carried is not None:
        streams = streams.union(carried.where(F.size("tokens") > 0).select(
            *groups, (F.col("chunk_id") * seq_length).alias("__start"), "tokens"))
    length = F.lit(seq_length)
    last = F.col("__start") + F.size("__tokens") - 1
    touched = F.sequence(
        F.floor(F.col("__start") / length), F.floor(last / length)
    )
    pieces = streams.select("*", F.explode(touched).alias("chunk_id"))
    begin = F.greatest(F.col("chunk_id") * length, F.col("__start"))
    end = F.least((F.col("chunk_id") + 1) * length, last + 1)
    piece = F.slice(
        F.col("__tokens"),
        (begin - F.col("__start") + 1).cast("int"),
        (end - begin).cast("int"),
    )
    pieces = pieces.select(
        *groups,
        "chunk_id",
        F.struct(
            begin.alias("at"), (F.array_join(piece, " ") if as_text else piece).alias("piece")
        ).alias("__piece"),
    )
    chunks = pieces.groupBy(*groups, "chunk_id").agg(
        F.array_sort(F.collect_list("__piece")).alias("__pieces"))
    gathered = F.col("__pieces.piece")
    tokens = F.split(F.array_join(gathered, " "), " ") if as_text else F.flatten(gathered)
    return chunks.select(*groups, "chunk_id", tokens.alias("tokens"))
