"""Sharding by a permutation-filled lookup table, in DataFrame expressions only.

Every shard has its own order of preference over the slots of a table of prime
size (an offset and a step derived from a hash of its name; as the size is
prime, each step visits all slots).  Shards take turns, each claiming its next
free slot, until the table is full.  Slots per shard differ by one at most, and
a shard that joins or leaves moves few other keys.

The table has ``SLOTS`` entries, however many rows there are.  It is one array literal, so
a row's shard is one hash and one array access: no join and no shuffle.

Defined cases: a null key has its own place (all null keys meet); equal keys get
the same shard; an empty table gives no rows; ``place`` adds its column to
all others and refuses a name that is taken.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fuelsight.llm.common import table

#: Prime, and a hundred slots or more per shard keep the shards even.
SLOTS = 65537
SHARDS = tuple(f"shard-{i:03d}" for i in range(256))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number of every slot."""
    if not _is_prime(slots) or not 0 < len(shards) <= slots or len(set(shards)) != len(shards):
        raise ValueError("a prime number of slots, and between one and that many different shards")
    orders = []
    for name in shards:
        digest = hashlib.sha256(name.encode()).digest()
        orders.append([int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1])
    found, free = [-1] * slots, slots
    while free:
        for k, order in enumerate(orders):
            while found[order[0]] >= 0:
                order[0] = (order[0] + order[1]) % slots
            found[order[0]] = k
            free -= 1
            if not free:
                break
    return found


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """A key's slot: the first 60 bits of the MD5 of its text form, modulo the number of slots."""
    digest = F.md5(F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def place(df: DataFrame, key_col: str, shards: list[str] = SHARDS, slots: int = SLOTS, out_col: str = "shard") -> DataFrame:
    """``df`` with the number of each row's shard."""
    if out_col in df.columns:
        raise ValueError(f"there is a column {out_col} already")
    packed = ",".join(map(str, lookup_table(list(shards), slots)))
    entries = F.split(F.lit(packed), ",").cast("array<int>")  # a constant: folded once into an array literal
    return df.withColumn(out_col, F.get(entries, slot_of(F.col(f"`{key_col}`"), slots)))


def write_sharded(df: DataFrame, path: str, key_col: str, shards: list[str] = SHARDS, slots: int = SLOTS, files: int = 4) -> None:
    """One folder per shard, each written by ``files`` tasks, so a large shard is not one task's work."""
    placed = place(df, key_col, shards, slots)
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files))
    placed.repartition(F.col("shard"), spread).write.partitionBy("shard").parquet(path)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their slot and one of 256 shards."""
    docs = place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    return docs.select("doc_id", slot_of(F.col("doc_id")).alias("slot"), "shard")


def oracle() -> str:
    """The same placement in DuckDB; the table of slots is the literal list."""
    packed = ",".join(map(str, lookup_table(list(SHARDS))))
    digest = "md5(coalesce('k' || doc_id::varchar, 'null'))"
    return f"""
        with t as (select string_split('{packed}', ',')::int[] as entries),
        d as (select doc_id, (('0x' || substr({digest}, 1, 15))::bigint % {SLOTS})::int as slot from documents)
        select d.doc_id, d.slot, t.entries[d.slot + 1] as shard from d, t"""
