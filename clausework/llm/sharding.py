"""Consistent sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime
size. The shards take turns claiming their next preferred free slot until the
table is full. A key goes to slot ``hash(key) mod size`` and so to that slot's
shard: one broadcast lookup a row. All shards hold nearly the same number of
slots, and leaving a shard out moves few keys of the others.

Defined cases: a null key is a key of its own (all null keys share a slot); an
empty text is an ordinary key; repeated rows go to the same shard; an empty
table gives an empty result; other columns are kept, and ``slot`` and
``shard`` of the input are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# slots of the table; a prime over 100 times the number of shards keeps them even within 1 %
TABLE_SIZE = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def preference(name: str, size: int) -> tuple[int, int]:
    """Offset and step of a shard's order of slots: ``(offset + i * step) mod size``."""
    digest = hashlib.md5(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:], "big") % (size - 1) + 1


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> np.ndarray:
    """The shard index of every slot. The work is ``size`` claims, whatever the data."""
    if not _is_prime(size):
        raise ValueError(f"the table size must be prime, not {size}")
    if not shards or len(shards) > size or len(set(shards)) != len(shards):
        raise ValueError("give between one and `size` distinct shard names")
    steps = [preference(s, size) for s in shards]
    table, at, left = np.full(size, -1, dtype=np.int32), [0] * len(shards), size
    while left:
        for s, (offset, step) in enumerate(steps):
            while table[slot := (offset + at[s] * step) % size] >= 0:
                at[s] += 1
            table[slot] = s
            left -= 1
            if not left:
                break
    return table


def key_slot(key: F.Column, size: int = TABLE_SIZE) -> F.Column:
    """The slot of a key: the first 15 hex digits of its text's MD5, modulo ``size``."""
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(df: DataFrame, key: str, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """Add ``slot`` and ``shard`` (a name of ``shards``) to every row.

    The table has ``size`` rows, so its broadcast does not grow with the data;
    no row is shuffled.
    """
    spark = df.sparkSession
    table = lookup_table(shards, size)
    slots = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(table.tolist())], "slot int, shard string")
    keep = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], key_slot(F.col(f"`{key}`"), size).alias("slot"))
    return rows.join(F.broadcast(slots), "slot", "left").select(*[f"`{c}`" for c in keep], "slot", "shard")


def write_shards(df: DataFrame, key: str, shards: list[str], path: str, size: int = TABLE_SIZE) -> None:
    """Write the rows as Parquet, one folder ``shard=<name>`` per shard."""
    place(df, key, shards, size).write.partitionBy("shard").parquet(path)
