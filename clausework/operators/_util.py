"""Small shared helpers: size-checked broadcast, stored tables, scan spreading, worker-side caches."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

# A side is broadcast only when its checked size is at most this.
BROADCAST_MAX_BYTES = 64 << 20
# the number of a row where keys may repeat
ROW = "__row"
# bytes that a value of a type counts for; anything else counts as a text
TYPE_BYTES = {T.IntegerType: 4, T.LongType: 8, T.DoubleType: 8, T.FloatType: 4, T.BooleanType: 1}
TEXT_BYTES = 64


def row_bytes(schema: T.StructType) -> int:
    """About how many bytes a row of labels, ids and numbers takes."""
    return 16 + sum(TYPE_BYTES.get(type(f.dataType), TEXT_BYTES) for f in schema.fields)


def bounded_broadcast(df: DataFrame, max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its counted rows stay within ``BROADCAST_MAX_BYTES`` (or ``max_rows``).

    Beyond the bound the frame is returned as is, and the join falls back to a
    shuffle join (AQE can still turn it into a broadcast from runtime sizes,
    and splits skewed partitions).
    """
    n = df.count() if rows is None else rows
    most = BROADCAST_MAX_BYTES // row_bytes(df.schema) if max_rows is None else max_rows
    return F.broadcast(df) if n <= most else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder below ``spark.checkpoint.dir`` and read back: lineage ends at shared files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, out: str = ROW) -> DataFrame:
    """``df`` with a number per row, written, so that the numbers hold in every later use."""
    return stored(df.withColumn(out, F.monotonically_increasing_id()), name)


def require_columns(df: DataFrame, required: list[str]) -> None:
    """V1: raise listing the missing columns (schema check, no job)."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"the input table lacks {', '.join(absent)}; it has {', '.join(df.columns)}")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Hash-partition a table scan on ``key`` when it has fewer splits than the session has cores.

    Text work is CPU-bound per row, and a table of one small file would
    otherwise run in one task. Meant for plain scans: their splits are planned
    without running a job. On a cluster scan nothing is shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def literal(value, kind: T.DataType) -> Column:
    """A collected value as a literal, structs included."""
    if isinstance(kind, T.StructType) and isinstance(value, (Row, tuple)):
        return F.struct(*[literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields, strict=True)])
    return F.lit(value).cast(kind)


def identity_of(make: Callable) -> str:
    """A name for what a function and everything it holds would do on a worker."""
    from pyspark import cloudpickle

    return hashlib.md5(cloudpickle.dumps(make)).hexdigest()


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker process.

    Plug-in models and tokenizers are built once per worker and kept here.
    It hangs off the ``pyspark`` module, which every worker has imported, so
    it survives even when this package's functions are pickled by value.
    """
    import pyspark

    cache = getattr(pyspark, "_clausework_cache", None)
    if cache is None:
        cache = {}
        pyspark._clausework_cache = cache
    return cache


def built(slot: str, identity: str, make: Callable):
    """What ``make`` builds, kept per worker under ``slot`` until another identity comes."""
    cache = worker_cache()
    if cache.get(slot, ("",))[0] != identity:
        cache[slot] = (identity, make())
    return cache[slot][1]
