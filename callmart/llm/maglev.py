"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size: slot ``offset + i * skip``. Shards
take turns, and each claims the first slot of its order that is still free, until the table is full; so
shares differ by one slot at most, and when a shard comes or goes few other slots change hands. The
table's size is a parameter, as the list of shards is, and does not grow with the data. A row is placed by one hash and one look at the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots: a prime, many times the number of shards.
SLOTS = 65_537
#: Largest table that is sent to the executors.
MOST_SLOTS = 2_000_003


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: Sequence[str], slots: int = SLOTS, turns: Mapping[str, int] | None = None) -> list[str]:
    """The shard of each slot. ``turns``: how many slots a shard claims in a round, 1 if not given."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if not len(shards) <= slots <= MOST_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"the table's size must be a prime from the number of shards to {MOST_SLOTS}")
    turns = dict(turns or {})
    if any(n < 1 for n in turns.values()):
        raise ValueError("a shard takes one turn in a round at least")
    state = [[_number(s, "offset") % slots, _number(s, "skip") % (slots - 1) + 1] for s in shards]
    table: list[str | None] = [None] * slots
    claimed = 0
    while True:
        for shard, at in zip(shards, state, strict=True):
            for _ in range(turns.get(shard, 1)):
                while table[at[0]] is not None:
                    at[0] = (at[0] + at[1]) % slots
                table[at[0]] = shard
                claimed += 1
                if claimed == slots:
                    return table


def slot_of(key: Column | str, slots: int = SLOTS) -> Column:
    """The slot that a key falls on; a missing key has a slot of its own like any value."""
    text = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string") if isinstance(key, str) else key.cast("string")), F.lit(""))
    # 60 bits of the digest: the same number in any engine.
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(slots))


def assign(rows: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS, turns: Mapping[str, int] | None = None) -> DataFrame:
    """``rows`` with their slot and shard.

    The table has ``slots`` entries, MOST_SLOTS at most, so it is sent to all tasks; nothing is shuffled. Equal
    keys get equal shards, and a missing key always the same one. Hot keys matter only if they are placed
    by: take a key that tells rows apart. Columns named slot or shard are replaced.
    """
    spark = rows.sparkSession
    table = spark.createDataFrame(list(enumerate(lookup_table(shards, slots, turns))), "_slot long, _shard string")
    kept = [c for c in rows.columns if c.lower() not in ("slot", "shard")]
    # Everything of the row in one column, so that no name of it can clash.
    placed = rows.select(slot_of(key, slots).alias("_at"), F.struct("*").alias("_row"))
    return placed.join(F.broadcast(table), F.col("_at") == F.col("_slot")).select(
        *[F.col("_row")[c].alias(c) for c in kept], F.col("_at").alias("slot"), F.col("_shard").alias("shard")
    )
