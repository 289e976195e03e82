"""Exact samples and splits: sizes, seed stability, top-k path == threshold path."""

import math

import pytest
from pyspark.sql import functions as F

from clausework.operators import sampling as P


def test_exact_n_and_all(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_id")
    assert P.sample_exact(df, 137).count() == 137
    assert P.sample_exact(df, 5000).count() == 1000
    with pytest.raises(ValueError):
        P.sample_exact(df, 5000, strict=True)


def test_sample_equals_a_full_sort(spark):
    from clausework.functions.text import order_key

    df = spark.range(5000).withColumnRenamed("id", "row_id").repartition(7)
    for n in (1, 1234, 4999):
        got = P.sample_exact(df, n)
        assert "TakeOrderedAndProject" not in got._jdf.queryExecution().executedPlan().toString()
        want = df.withColumn("k", order_key(42, F.col("row_id"))).orderBy("k", "row_id").limit(n).select("row_id")
        assert {r[0] for r in got.collect()} == {r[0] for r in want.collect()}
    assert {r[0] for r in P.first_n(df, 321).collect()} == set(range(321))


def test_repeated_keys_give_exactly_n(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("row_id"), F.col("id").alias("v"))
    for n in (5, 100, 143, 999):
        assert P.sample_exact(df, n).count() == n and P.first_n(df, n).count() == n


def test_keys_of_other_types(spark):
    rows = [(f"k{i % 50:02d}", i // 50, i) for i in range(300)] + [(None, 1, 300)]
    df = spark.createDataFrame(rows, "a string, b int, v long").withColumn("key", F.struct("a", "b"))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert {r["v"] for r in P.first_n(df, 40, "key").collect()} == {r[2] for r in order[:40]}
    texts = df.where("b = 3")
    assert {r["a"] for r in P.first_n(texts, 5, "a").collect()} == {f"k{i:02d}" for i in range(5)}
    for key in ("key", "v"):
        train, test = P.split_exact(df, key=key)
        a, b = {r["v"] for r in train.collect()}, {r["v"] for r in test.collect()}
        assert len(b) == math.ceil(0.2 * 301) and not a & b and len(a | b) == 301


def test_split_exact_sizes_and_disjoint(spark):
    df = spark.range(1001).withColumnRenamed("id", "row_id")
    train, test = P.split_exact(df)
    t = {r[0] for r in test.collect()}
    r = {x[0] for x in train.collect()}
    assert len(t) == math.ceil(0.2 * 1001) and not (t & r) and len(t | r) == 1001


def test_split_hash_invariant_to_partitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "row_id")
    a = {r[0] for r in P.split_hash(df)[1].collect()}
    b = {r[0] for r in P.split_hash(df.repartition(5).orderBy(F.rand(3)))[1].collect()}
    assert a == b and 300 < len(a) < 500
