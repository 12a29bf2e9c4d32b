"""Sharding by a permutation-filled lookup table (operator 3).

Each shard prefers the slots of a prime-sized table in an order of its own
(an offset and a step from its name's hash).  The shards take turns to
claim the next free slot they prefer until the table is full, so shares
differ by one slot at most, and a shard that comes or goes moves little
besides its own slots (Eisenbud et al. 2016).

The table depends on the shards' names and its size alone, not on the data;
it is broadcast as ``size`` rows of two numbers.  A row's place is its
key's hash modulo the size and one lookup: no shuffle, so a hot key, source
or group of copies costs nothing extra.  Rows are placed by DataFrame
functions only.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _bits(text: str) -> int:
    """60 bits of the MD5 of a text."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: list[str], size: int) -> list[int]:
    """The shard number of each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need names of their own")
    if size < len(shards) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError(f"{size} is not a prime of at least the number of shards")
    at = [_bits(f"{s}:offset") % size for s in shards]
    step = [_bits(f"{s}:step") % (size - 1) + 1 for s in shards]
    table = [-1] * size
    for turn in range(size):
        i = turn % len(shards)
        while table[at[i]] >= 0:
            at[i] = (at[i] + step[i]) % size
        table[at[i]] = i
    return table


def lookup(spark: SparkSession, shards: list[str], size: int) -> DataFrame:
    """(slot, shard) rows of the filled table."""
    table = ",".join(map(str, fill_table(shards, size)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(table), ",").cast("array<int>")).alias("__slot", "__shard"))


def place(docs: DataFrame, shards: list[str], size: int, key: str = "doc_id", slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``docs`` with the columns ``slot`` and ``shard`` (a shard's position in
    ``shards``); columns that have these names are replaced.

    The key is hashed as text, a null key like an empty one; rows of the same
    key go to the same shard, whatever their text.  An empty table gives an
    empty result."""
    if key in (slot, shard):
        raise ValueError(f"{key} is read and replaced")
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    seed = F.coalesce(F.col(f"c{names.index(key)}").cast("string"), F.lit(""))
    hashed = F.conv(F.substring(F.md5(seed.cast("binary")), 1, 15), 16, 10).cast("long")
    rows = plain.withColumn("at", (hashed % size).cast("int"))
    return rows.join(F.broadcast(lookup(docs.sparkSession, shards, size)), F.col("at") == F.col("__slot")).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c not in (slot, shard)], F.col("__slot").alias(slot), F.col("__shard").alias(shard))
