"""Sharding by a permutation-filled lookup table.

Every shard has an order of preference over the slots of a table of prime size. Shards take turns;
at its turn a shard claims the first slot of its order that is still free, until the table is
full. A key goes to the slot given by its hash, so placement is one lookup in a table whose size
does not depend on the data, shards differ by at most one slot, and a change of the shard list
moves few other keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.functions.hashing import columns_of, hash_number, require_new, seeded_hash

SLOTS = 4099


def fill_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The shard (its place in ``shards``) that owns each slot; ``slots`` must be prime."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, and each only once")
    if slots < len(shards) or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime and not below the number of shards")
    starts, steps = zip(*[_preference(name, slots) for name in shards])
    owner, tried = [-1] * slots, [0] * len(shards)
    for turn in range(slots):
        shard = turn % len(shards)
        while True:
            slot = (starts[shard] + tried[shard] * steps[shard]) % slots
            tried[shard] += 1
            if owner[slot] < 0:
                owner[slot] = shard
                break
    return owner


def _preference(name: str, slots: int) -> tuple[int, int]:
    """First slot and step of a shard's order, from the two halves of md5 of its name."""
    digest = hashlib.md5(name.encode()).hexdigest()
    return int(digest[:15], 16) % slots, int(digest[16:31], 16) % (slots - 1) + 1


def assign_shards(docs: DataFrame, key: str | Sequence[str], shards: Sequence[str],
                  slots: int = SLOTS, seed: int = 0) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``; the table, of ``slots`` rows, is broadcast.

    The hash is md5 of the seed and the key columns as text, a null reading as empty text; equal
    keys, repeated rows included, share a shard. Columns named ``slot`` or ``shard`` must not
    exist yet. No row is moved between tasks.
    """
    require_new(docs, "slot", "shard")
    owner = fill_table(shards, slots)
    table = docs.sparkSession.createDataFrame(
        [(slot, shards[shard]) for slot, shard in enumerate(owner)], "slot bigint, shard string"
    )
    hashed = hash_number(seeded_hash(seed, *columns_of(key)), 1, 15)
    return (
        docs.withColumn("slot", hashed % slots)
        .join(F.broadcast(table), "slot").select(*docs.columns, "slot", "shard")
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def table_sql(shards: Sequence[str], slots: int = SLOTS) -> str:
    """A SQL query for (slot, shard) that fills the table turn by turn."""
    names = ", ".join(f"({k}, {_quoted(name)})" for k, name in enumerate(shards))
    return f"""
WITH RECURSIVE names(k, name) AS (VALUES {names}),
orders AS MATERIALIZED (
  SELECT list(prefers ORDER BY k) AS prefers FROM (
    SELECT k, list_transform(range({slots}), lambda j: 1 + (start + j * step) % {slots}) AS prefers
    FROM (SELECT k, ('0x' || substr(md5(name), 1, 15))::BIGINT % {slots} AS start,
            ('0x' || substr(md5(name), 17, 15))::BIGINT % {slots - 1} + 1 AS step FROM names))
),
turns(turn, owner) AS (
  SELECT 0::BIGINT, list_transform(range({slots}), lambda j: -1)
  UNION ALL
  SELECT turn + 1, owner[:place - 1] || [(turn % {len(shards)})::INTEGER] || owner[place + 1:]
  FROM (
    SELECT turn, owner, mine[list_position(list_select(owner, mine), -1)] AS place
    FROM (SELECT turn, owner, prefers[turn % {len(shards)} + 1] AS mine
          FROM turns, orders WHERE turn < {slots})
  )
),
slots AS (
  SELECT generate_subscripts(owner, 1) - 1 AS slot, unnest(owner) AS k
  FROM turns WHERE turn = {slots}
)
SELECT slot, name AS shard FROM slots JOIN names USING (k)"""
