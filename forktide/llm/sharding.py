"""Sharding by a permutation-filled lookup table, on DataFrame functions alone.

Each shard prefers the slots of a prime-sized table in its own order, ``(offset + j * skip) mod size``.  The shards take
turns; at its turn a shard claims the first slot of its order that is still free.  The table differs in size between
shards by one slot at most, and taking a shard away moves few of the other shards' slots.  A row's slot is a hash of its
key modulo the size, and a broadcast table of ``size`` entries gives the shard in constant time.  The broadcast is bounded
by the size of the table, whatever the input holds.

Defined cases: a null key hashes like the empty string; equal keys go to one shard; an empty table gives an empty result;
columns of the input are kept, and the three new ones replace columns of the same name.  Hot keys do no harm: no row is
shuffled.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of the table, a prime.  Shards hold size / n slots each, within one.
TABLE_SIZE = 8191
SHARDS = [f"shard-{i:02d}" for i in range(24)]


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def preference(shard: str, size: int) -> tuple[int, int]:
    """(offset, skip) of a shard's order of slots; any skip below a prime size visits every slot."""
    return _number(f"{shard}:offset") % size, _number(f"{shard}:skip") % (size - 1) + 1


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """The shard's index for each slot.  Work is bounded by the table: it doesn't depend on the rows."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and at least one")
    if size < len(shards) or any(size % p == 0 for p in range(2, int(size**0.5) + 1)):
        raise ValueError("size must be a prime not below the number of shards")
    order = [preference(s, size) for s in shards]
    table, at, free = [-1] * size, [0] * len(shards), size
    while free:
        for i, (offset, skip) in enumerate(order):
            if not free:
                break
            while table[slot := (offset + at[i] * skip) % size] >= 0:
                at[i] += 1
            table[slot], free = i, free - 1
    return table


def key_hash(key: Column) -> Column:
    """The first 60 bits of MD5 of the key as text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def table_frame(spark: SparkSession, shards: list[str], size: int) -> DataFrame:
    """(slot, shard): four hex digits a slot in one literal, cut apart by Spark."""
    digits = "".join(f"{i:04x}" for i in lookup_table(shards, size))
    index = F.conv(F.substring(F.lit(digits), (F.col("slot") * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")
    names = F.array(*map(F.lit, shards))
    return spark.range(0, size, 1, 1).select(F.col("id").alias("slot")).select("slot", F.element_at(names, index + 1).alias("shard"))


def shard_rows(df: DataFrame, key: str, shards: list[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """df with key_hash long, slot long and shard string."""
    table = table_frame(df.sparkSession, shards, size)
    hashed = df.withColumn("key_hash", key_hash(F.col(f"`{key}`"))).withColumn("slot", F.col("key_hash") % size).drop("shard")
    return hashed.join(F.broadcast(table), "slot", "left")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard_rows(docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes")), "doc_id").select("doc_id", "n_bytes", "key_hash", "slot", "shard")


def _sql() -> str:
    rows = ",".join(f"({i},'{s}',{o},{k})" for i, s in enumerate(SHARDS) for o, k in [preference(s, TABLE_SIZE)])
    # Turn t of shard i is round t // n.  A round-free statement of the same rule needs the claims so far, so the
    # recursion carries the claimed slots as a list of flags and each shard's next position.
    n = len(SHARDS)
    return f"""
WITH RECURSIVE prefs(i, shard, o, k) AS (VALUES {rows}),
lists AS (SELECT list(o ORDER BY i) AS os, list(k ORDER BY i) AS ks, list(shard ORDER BY i) AS names FROM prefs),
turns AS (
  SELECT 0 AS t, list_transform(range({TABLE_SIZE}), lambda x: false) AS taken, CAST(-1 AS BIGINT) AS slot, os, ks, names FROM lists
  UNION ALL
  SELECT t + 1, list_concat(taken[1:s], [true], taken[s + 2:]), s, os, ks, names
  FROM (SELECT *, list_filter(list_transform(range({TABLE_SIZE}), lambda j: (os[t % {n} + 1] + j * ks[t % {n} + 1]) % {TABLE_SIZE}), lambda x: NOT taken[x + 1])[1] AS s
        FROM turns WHERE t < {TABLE_SIZE})),
placed AS (SELECT slot, names[(t - 1) % {n} + 1] AS shard FROM turns WHERE t > 0),
keyed AS (SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key_hash FROM documents)
SELECT doc_id, n_bytes, key_hash, key_hash % {TABLE_SIZE} AS slot, shard FROM keyed JOIN placed ON placed.slot = key_hash % {TABLE_SIZE}
"""


ORACLE_SQL = _sql()
