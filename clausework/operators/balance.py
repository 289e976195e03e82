"""Partitions that hold equal shares of a weight, such as the tokens of a text.

Text work costs by the token, and texts differ a thousandfold in length, so
partitions of equal rows are not equal work. A row goes where the running sum
of the weights before it falls: sums are taken inside the written partitions,
in order, one total per partition gives the offsets, and the place is an exact
partition number (no hash, no sampled ranges). A partition exceeds the mean by
less than one row's weight. Texts are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import ROW, stored

_PART, _SUM = "__part", "__sum"


def running_sums(weights: DataFrame, weight: str) -> DataFrame:
    """``weights`` with its partition's number and the sum of ``weight`` before each row in that partition, written."""
    schema = T.StructType([*weights.schema.fields, T.StructField(_PART, T.LongType()), T.StructField(_SUM, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for b in batches:
            w = b[weight].to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.cumsum(w) - w + before
            before += int(w.sum())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(b), part, dtype=np.int64)), pa.array(sums)],
                                             names=[*b.schema.names, _PART, _SUM])

    return stored(weights.mapInArrow(run, schema), "running-sums")


def balanced(df: DataFrame, weight: Column, parts: int) -> DataFrame:
    """``df`` in ``parts`` partitions of about equal sums of ``weight`` (null and negative count 0).

    The rows are written once with their sums, as their numbers must hold
    while totals are counted; columns stay as they are.
    """
    if parts < 1:
        raise ValueError("one partition at least")
    w = F.greatest(F.coalesce(weight.cast("long"), F.lit(0)), F.lit(0))
    rows = running_sums(df.withColumn(ROW, w), ROW)
    # one total per partition of the scan: bounded by their number
    totals = rows.groupBy(_PART).agg(F.sum(ROW).alias("n")).orderBy(_PART).collect()
    starts = np.cumsum([0, *(r["n"] for r in totals)]).tolist()
    total = starts[-1]
    offsets = df.sparkSession.createDataFrame([(r[_PART], s) for r, s in zip(totals, starts[:-1], strict=True)] or [(0, 0)], f"{_PART} long, __off long")
    # the middle of the row's own weight decides, so a heavy row is not always first
    middle = F.col(_SUM) + F.col("__off") + F.col(ROW) / 2
    place = F.least(F.floor(middle * F.lit(parts) / F.lit(max(1, total))), F.lit(parts - 1)).cast("int")
    placed = rows.join(F.broadcast(offsets), _PART).withColumn(ROW, place)
    return placed.repartitionById(parts, ROW).select(*df.columns)


def loads(df: DataFrame, weight: Column) -> DataFrame:
    """``(part, rows, weight)`` of each partition that has rows."""
    return (df.select(F.spark_partition_id().alias("part"), F.coalesce(weight.cast("long"), F.lit(0)).alias("w"))
            .groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("w").alias("weight")))
