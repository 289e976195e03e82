"""Vocabulary, multi-hot, wide table and warm start."""

import pytest
from pyspark.sql import functions as F

from clausework.operators import labels as L, scoring


def _clauses(spark):
    rows = [(1, ["b", "a"]), (2, ["c"]), (3, []), (4, ["a", "a", "d"]), (5, ["ä", "B"])]
    return spark.createDataFrame(rows, "row_id long, actors array<string>")


def test_vocab_sorted_dense(spark):
    v = L.vocabulary(_clauses(spark).repartition(3))
    got = [(r[0], r[1]) for r in v.orderBy("label_id").collect()]
    labels = sorted({"b", "a", "c", "d", "ä", "B"})
    assert got == list(enumerate(labels))


def test_multi_hot_roundtrip(spark):
    c = _clauses(spark)
    v = L.vocabulary(c)
    k = v.count()
    mh = L.multi_hot(L.label_ids(c, v), k).collect()
    names = {r[0]: r[1] for r in v.collect()}
    for r in mh:
        decoded = {names[i] for i, bit in enumerate(r["labels"]) if bit}
        src = {x for x in [row for row in c.where(F.col("row_id") == r["row_id"]).first()["actors"]]}
        assert decoded == src


def test_ids_beside_the_row_equal_joined_ids(spark):
    c = _clauses(spark)
    v = L.vocabulary(c.where("row_id <> 4"))
    near = {r["row_id"]: r["label_ids"] for r in L.with_label_ids(c, v).collect()}
    assert near == {r["row_id"]: r["label_ids"] for r in L.label_ids(c, v).collect()} and near[3] == []
    assert L.label_names(v, most=2) is None


def test_wide_and_clash(spark):
    c = _clauses(spark)
    with pytest.raises(ValueError, match="'B', 'b'"):   # they cannot both be columns case-insensitively
        L.label_wide(c, ["a", "b", "B"])
    with pytest.raises(ValueError, match="row_id"):
        L.label_wide(c, ["Row_Id"])
    w = {r["row_id"]: r for r in L.label_wide(c, ["a", "c", "zz"]).collect()}
    assert (w[1]["a"], w[1]["c"], w[3]["a"], w[4]["a"], w[2]["c"], w[2]["zz"]) == (1, 0, 0, 1, 1, 0)
    cells = {(r["row_id"], r["label"]) for r in L.label_cells(c, L.vocabulary(c)).collect()}
    assert cells == {(r["row_id"], x) for r in c.collect() for x in r["actors"]}


def test_warm_start(spark):
    new = spark.createDataFrame([(0, "Donors"), (1, "Rebels"), (2, "Zeta")], "label_id int, label string")
    old = spark.createDataFrame([(0, "Criminals"), (1, "Politicians")], "label_id int, label string")
    warm = L.warm_map_table(spark)
    pairs = {(r[0], r[1]) for r in L.warm_pairs(warm, new, old).collect()}
    assert pairs == {("Rebels", "Criminals")}
    skipped = {r[0] for r in L.warm_skipped(warm, new, old).collect()}
    assert "Donors" in skipped and "Rebels" not in skipped and len(skipped) == 15
    nh, oh = scoring.hash_head(new), scoring.hash_head(old, salt="old")
    copied = L.warm_copy(nh, oh, L.warm_pairs(warm, new, old))
    a = {r["feature"]: r["weight"] for r in copied.where("label = 'Rebels'").collect()}
    b = {r["feature"]: r["weight"] for r in oh.where("label = 'Criminals'").collect()}
    assert a == b and -1 in a
    z1 = {r["feature"]: r["weight"] for r in copied.where("label = 'Zeta'").collect()}
    z2 = {r["feature"]: r["weight"] for r in nh.where("label = 'Zeta'").collect()}
    assert z1 == z2
