"""Placement on shards by a permutation-filled lookup table (operator 9).

Every shard has a preference order of all slots of a table of prime size: a
first slot and a stride from two hashes of its name, which visits every slot
once as the size is prime. The shards take turns; each claims the first slot of
its order that is still free, until none is. Shards so hold equally many slots (or
one more), and when a shard goes, nearly only its own slots change hands. A
row's slot is a hash of its id modulo the size: one look-up in a broadcast table
of fixed size.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import name

#: Slots of the table; a prime, and over a hundred times the usual number of shards.
SLOTS = 65537


def _prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def _hash(name: str, seed: str) -> int:
    return int.from_bytes(hashlib.md5(f"{seed}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Shard number of every slot. The result depends on the names and their order only."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if not _prime(slots) or slots < len(shards):
        raise ValueError("slots must be a prime number, not below the number of shards")
    at = [_hash(s, "offset") % slots for s in shards]
    stride = [_hash(s, "skip") % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            if not free:
                break
            while table[at[i]] >= 0:
                at[i] = (at[i] + stride[i]) % slots
            table[at[i]] = i
            free -= 1
    return table


def place(docs: DataFrame, shards: list[str], slots: int = SLOTS, key_col: str = "doc_id") -> DataFrame:
    """The rows of `docs` with columns slot and shard (a name of `shards`) added.

    Rows with equal keys, null among them, go to the same shard. Columns of
    `docs` called slot or shard are replaced; others may have any names. No shuffle.
    """
    names = docs.sparkSession.createDataFrame(
        [(k, shards[i]) for k, i in enumerate(lookup_table(shards, slots))], "slot int, shard string")
    kept = [name(c) for c in docs.columns if c not in ("slot", "shard")]
    slot = F.pmod(F.xxhash64(F.coalesce(name(key_col).cast("string"), F.lit("null"))), F.lit(slots)).cast("int")
    # the row travels as one struct, so its columns may have any names; the table has `slots` rows whatever
    # the data: safe to broadcast
    return docs.select(slot.alias("slot"), F.struct(*kept).alias("row")).join(F.broadcast(names), "slot").select("row.*", "slot", "shard")


def write_shards(docs: DataFrame, shards: list[str], path: str, parts: int = 8, slots: int = SLOTS, key_col: str = "doc_id") -> None:
    """Write `docs` as Parquet, a folder for each shard, in up to `parts` files each (a shard is dealt to several tasks)."""
    out = place(docs, shards, slots, key_col)
    deal = F.pmod(F.xxhash64(name(key_col), F.lit(1)), F.lit(parts))
    out.repartition(len(shards) * parts, "shard", deal).write.partitionBy("shard").parquet(path)


def default_shards(n: int = 64) -> list[str]:
    return [f"shard-{i:03d}" for i in range(n)]
