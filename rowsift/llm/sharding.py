"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table: an offset and
a step from hashes of its name, which visit each slot once. The shards take turns, each
claiming the next free slot of its order, until the table is full; with weights, a
shard gets turns in proportion. A key goes to the shard in the slot of its hash. The
table is small, of a size fixed by parameter, so it is broadcast and placement is one
lookup. Adding or removing a shard moves few keys beside those it must.

Defined results. Null key: hashed as the word null, so it has a shard too. Equal keys share a
shard, so repeated rows meet. Empty table: no rows. Text never matters. Ties between
shards fall to the order of the list. A shard of weight 0 gets nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsift.llm.common import free_name

#: Slots; a prime well above 100 times the shards keeps shares within about one percent.
SLOTS = 65_537
SHARDS = 64


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], weights: Sequence[float] | None = None, slots: int = SLOTS) -> list[int]:
    """Index of the shard in each slot."""
    if not _is_prime(slots):
        raise ValueError("the number of slots must be prime")
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shards need names, each once")
    weights = list(weights or [1.0] * len(shards))
    if min(weights) < 0 or max(weights) <= 0 or len(weights) != len(shards) or len(shards) > slots:
        raise ValueError("weights must not be negative, one per shard, and shards no more than slots")
    start = [_number(f"offset:{s}") % slots for s in shards]
    step = [_number(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    table, taken, at, due = [-1] * slots, 0, [0] * len(shards), [0.0] * len(shards)
    top = max(weights)
    while taken < slots:
        for i in range(len(shards)):
            due[i] += weights[i] / top
            if due[i] < 1:
                continue
            due[i] -= 1
            slot = (start[i] + at[i] * step[i]) % slots
            while table[slot] >= 0:
                at[i] += 1
                slot = (start[i] + at[i] * step[i]) % slots
            table[slot] = i
            at[i] += 1
            taken += 1
            if taken == slots:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key, the same in every engine with MD5."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % F.lit(slots)).cast("int")


def place(
    docs: DataFrame, key: str = "doc_id", shards: Sequence[str] | None = None, weights: Sequence[float] | None = None, slots: int = SLOTS
) -> DataFrame:
    """Add the columns slot (int) and shard (string) to every row, without shuffling."""
    shards = list(shards or default_shards())
    table = lookup_table(shards, weights, slots)
    at, to = free_name(docs.columns, "slot"), free_name(docs.columns, "shard")
    # as many rows as there are slots, which the caller fixes
    lookup = F.broadcast(docs.sparkSession.createDataFrame([(i, shards[s]) for i, s in enumerate(table)], f"`{at}` int, `{to}` string"))
    return docs.withColumn(at, slot_of(F.col(key), slots)).join(lookup, at).select(*docs.columns, at, to)


def default_shards(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", files: int = 4, **placing) -> None:
    """Write one folder per shard, each by up to ``files`` tasks, so that no task holds a shard alone."""
    placed = place(docs, key, **placing)
    shard = placed.columns[-1]
    salt = F.pmod(F.xxhash64(*docs.columns), F.lit(files))
    placed.repartition(shard, salt).write.partitionBy(shard).parquet(path)
