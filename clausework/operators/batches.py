"""Exact seeded mini-batches (F1, F3): every epoch another order, every batch exactly so many windows.

An epoch's order is that of md5(seed:epoch:key). The windows are
range-partitioned and sorted by it and written; numbers within the partitions
and one count per partition number them from 0, so a batch is a range of
numbers. Its filter names partitions and places within them, which the written
files' statistics prune: a step reads its batch, not the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import order_key
from ._util import stored

SEED = 42
_BITS = 33  # a partition's rows are numbered in the low bits


class Order:
    """One epoch's order of a table with a ``key`` column."""

    def __init__(self, rows: DataFrame, seed: int, epoch: int, key: str = "key"):
        keyed = rows.withColumn("__order", order_key(f"{seed}:{epoch}", F.col(key)))
        sorted_rows = keyed.repartitionByRange("__order", key).sortWithinPartitions("__order", key).drop("__order")
        number = F.monotonically_increasing_id()
        self.rows = stored(sorted_rows.withColumn("__n", number)
                           .withColumn("__part", F.shiftright("__n", _BITS).cast("int")), f"epoch-{epoch}")
        self.rows = self.rows.withColumn("__place", F.col("__n").bitwiseAND((1 << _BITS) - 1))
        # one count per partition: bounded by their number
        counts = sorted((r["__part"], r["count"]) for r in self.rows.groupBy("__part").count().collect())
        self.starts, self.size = [], 0
        for part, n in counts:
            self.starts.append((part, self.size, n))
            self.size += n

    def numbered(self) -> DataFrame:
        """The rows with their ``number`` in the order."""
        starts = self.rows.sparkSession.createDataFrame([(p, s) for p, s, _ in self.starts] or [(0, 0)], "__part int, __start long")
        return (self.rows.join(F.broadcast(starts), "__part").withColumn("number", F.col("__start") + F.col("__place"))
                .drop("__part", "__place", "__n", "__start"))

    def between(self, first: int, end: int) -> DataFrame:
        """The rows numbered from ``first`` up to below ``end``."""
        wanted = F.lit(False)
        for part, start, n in self.starts:
            if first < start + n and end > start:
                low = (part << _BITS) + max(0, first - start)
                wanted = wanted | F.col("__n").between(low, (part << _BITS) + min(n, end - start) - 1)
        return self.rows.where(wanted).drop("__part", "__place", "__n")
