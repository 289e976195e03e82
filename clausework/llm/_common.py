"""Helpers shared by the operators: stored intermediate tables, vector checks, block joins, top-k."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators._util import built
from ..session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below ``spark.checkpoint.dir`` and read it back.

    The shared files cut the lineage: a lost executor costs a reread, not the
    steps before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_memory(owner: str, make: Callable):
    """What ``make`` builds, kept per worker until another owner asks: a worker holds one operator's memory of words."""
    return built("word-memory", owner, make)


def give_back() -> None:
    """Return memory that Arrow's pool and the C library keep after large batches of text; workers live on between tasks."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # a GNU C library
        trim(0)


def sound_vectors(df: DataFrame, id_col: str, vec_col: str, drop_zero: bool = False, any_length: bool = False) -> DataFrame:
    """``(vec_id, vec array<double>)`` of the vectors that can take part.

    A vector takes part if it is not null or empty, holds no null and no
    non-finite component (with ``drop_zero`` also some component that is not
    0), and, unless ``any_length``, has the most frequent length of the table
    (ties: the longer one).
    """
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & F.coalesce(finite, F.lit(False))
    if drop_zero:
        ok = ok & F.exists(vec_col, lambda x: x != F.lit(0.0))
    rows = (df.where(ok & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec")))
    if any_length:
        return rows
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("vec") == (lengths[0]["n"] if lengths else 0))


def block_of(key: str, blocks: int) -> F.Column:
    """An even block number from a hash of ``key`` (the seed differs from Spark's shuffle hash)."""
    return F.pmod(F.xxhash64(F.lit("block"), F.col(key)), F.lit(blocks)).cast("int")


def block_join(rows: DataFrame, queries: DataFrame, row_key: str, query_key: str, row_blocks: int, query_blocks: int,
               fn: Callable, schema: str) -> DataFrame:
    """Run ``fn(query block, row block)`` for every pair of blocks.

    Rows and queries are dealt to blocks by a hash of their ids, so that no
    value can make a block large; a row is sent once per query block, a query
    once per row block. ``fn`` takes two pandas frames and returns one.
    """
    def copies(n: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    q = queries.withColumn("qb", block_of(query_key, query_blocks)).withColumn("rb", copies(row_blocks))
    r = rows.withColumn("rb", block_of(row_key, row_blocks)).withColumn("qb", copies(query_blocks))
    return (q.groupBy("qb", "rb").cogroup(r.groupBy("qb", "rb"))
            .applyInPandas(lambda a, b: fn(a, b), schema))


def best_per_query(found: DataFrame, k: int, *order: F.Column) -> DataFrame:
    """The first ``k`` rows of each ``query_id`` in the given order, with ``rank`` from 1."""
    w = Window.partitionBy("query_id").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
