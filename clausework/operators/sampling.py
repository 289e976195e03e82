"""Seeded exact samples, first-n, and hold-out splits.

Rows are ordered by a 60-bit key from md5(seed:key), so the result does not
depend on partitioning or input order. Every exact cut takes one path,
whatever n is: the order values alone are range-partitioned and written, the
per-partition counts say in which partition the n-th value lies, and the cut
is then a plain distributed filter against that one value. No row of text is
sorted or sent to one task.

Keys may be of any orderable type, structs included. Where the value at the
cut is repeated, exactly as many of its rows are taken as n asks for.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import order_key, unit_hash
from ..session import scratch_path
from ._util import literal

# Seed and hold-out share of the split being matched.
SEED = 42
TEST_SHARE = 0.2


def _cut(df: DataFrame, n: int, order: Column) -> tuple[Column, int, bool] | None:
    """The n-th smallest order value as a literal, how many rows at it belong to the first n, and whether that is all of them.

    None when there are at most n rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "order")
    ranged = df.select(order.alias("o"))
    ranged.repartitionByRange("o").sortWithinPartitions("o").select(
        "o", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")).write.parquet(path)
    stored = spark.read.parquet(path)
    # one row per range partition
    parts = stored.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).orderBy("part").collect()
    if sum(p["n"] for p in parts) <= n:
        return None
    before = 0
    for p in parts:
        if before + p["n"] >= n:
            break
        before += p["n"]
    kind = stored.schema["o"].dataType
    edge = literal(stored.where((F.col("part") == p["part"]) & (F.col("at") == p["first"] + n - before - 1)).first()["o"], kind)
    counts = stored.agg(F.count_if(F.col("o") < edge).alias("below"), F.count_if(F.col("o").eqNullSafe(edge)).alias("equal")).first()
    take = n - counts["below"]
    return edge, take, take == counts["equal"]


def _order(key: str, *first: Column) -> Column:
    return F.struct(*first, F.col(key).alias("key"))


def smallest_n(df: DataFrame, n: int, order: Column) -> DataFrame:
    """Exactly min(n, rows) rows with the smallest ``order`` (a struct)."""
    if n <= 0:
        return df.limit(0)
    cut = _cut(df, n, order)
    if cut is None:
        return df
    edge, take, whole = cut
    if whole:
        return df.where(order <= edge)
    # rows that share the n-th value are interchangeable in this order: any of them make up the number
    return df.where(order < edge).unionByName(df.where(order.eqNullSafe(edge)).limit(take))


def sample_exact(df: DataFrame, n: int, seed: int = SEED, key: str = "row_id", strict: bool = False) -> DataFrame:
    """Exactly n rows without replacement, seeded; all rows when n >= rows.

    ``strict=True`` fails when n exceeds the row count, as a fixed-n pandas
    sample does.
    """
    if strict and n > (rows := df.count()):
        raise ValueError(f"a sample of {n} rows cannot be drawn from {rows}")
    return smallest_n(df, n, _order(key, order_key(seed, F.col(key)).alias("k")))


def first_n(df: DataFrame, n: int | None, key: str = "row_id") -> DataFrame:
    """The first n rows by key (no limit when n is None)."""
    return df if n is None else smallest_n(df, n, _order(key))


def split_hash(df: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED,
               key: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """P4 (default): (train, test) by a stable hash bucket; no shuffle, share approximate."""
    u = unit_hash(seed, F.col(key))
    return df.where(u >= test_share), df.where(u < test_share)


def split_exact(df: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED,
                key: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """P4 (exact): test = ceil(share * rows) rows of the seeded order, train = the rest.

    Both sides are filters against one value (no anti-join). Rows that repeat
    the key at the cut all go to the test side, so that no key is on both.
    """
    order = _order(key, order_key(seed, F.col(key)).alias("k"))
    n_test = math.ceil(test_share * df.count())
    if n_test <= 0:
        return df, df.limit(0)
    cut = _cut(df, n_test, order)
    if cut is None:
        return df.limit(0), df
    return df.where(order > cut[0]), df.where(order <= cut[0])
