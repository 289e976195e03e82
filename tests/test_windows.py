"""Window counts and contents of both windowings against plain-Python definitions."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clausework.functions.text import CLS_ID, SEP_ID
from clausework.operators import windows as W


def py_fixed(ids, L=512, step=256):
    full = [CLS_ID] + ids + [SEP_ID]
    return [full[s:s + L] for s in range(0, len(full), step)]


def py_overlap(ids, L=512, overlap=256):
    cap, step = L - 2, L - 2 - overlap
    out, s = [], 0
    while True:
        out.append([CLS_ID] + ids[s:s + cap] + [SEP_ID])
        if s + cap >= len(ids):
            return out
        s += step


def spark_windows(spark, n_list, fn):
    df = spark.createDataFrame([(i, list(range(3, 3 + n))) for i, n in enumerate(n_list)], "row_id long, ids array<int>")
    rows = fn(df).orderBy("row_id", "window").collect()
    out = {}
    for r in rows:
        out.setdefault(r["row_id"], []).append(list(r["window_ids"]))
    return out


def test_fixed_step_counts(spark):
    # n counts the two specials
    lengths = {2: 1, 256: 1, 257: 2, 512: 2, 513: 3}
    got = spark_windows(spark, [n - 2 for n in lengths], W.fixed_step_windows)
    assert [len(got[i]) for i in range(len(lengths))] == list(lengths.values())


def test_overlap_counts(spark):
    lengths = {0: 1, 510: 1, 511: 2, 764: 2, 765: 3, 1018: 3, 1019: 4, 5184: 20}
    got = spark_windows(spark, list(lengths), W.overlap_windows)
    assert [len(got[i]) for i in range(len(lengths))] == list(lengths.values())
    assert [W.overlap_count(n) for n in lengths] == list(lengths.values())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=3000), min_size=1, max_size=6))
def test_windows_equal_python(spark, ns):
    got_f = spark_windows(spark, ns, W.fixed_step_windows)
    got_o = spark_windows(spark, ns, W.overlap_windows)
    for i, n in enumerate(ns):
        ids = list(range(3, 3 + n))
        assert got_f[i] == py_fixed(ids)
        assert got_o[i] == py_overlap(ids)
        covered = {t for w in got_o[i] for t in w[1:-1]}
        assert covered == set(ids)


def test_padding_and_mask(spark):
    df = spark.createDataFrame([(0, [5, 6, 7])], "row_id long, ids array<int>")
    r = W.pad_windows(W.overlap_windows(df)).first()
    assert len(r["input_ids"]) == 512 and len(r["attention_mask"]) == 512
    assert r["input_ids"][:5] == [CLS_ID, 5, 6, 7, SEP_ID] and set(r["input_ids"][5:]) == {0}
    assert sum(r["attention_mask"]) == 5 == r["n_tokens"]


def test_a_null_text_keeps_its_row(spark):
    df = spark.createDataFrame([(1, None), (2, "a b")], "row_id long, clause string")
    ids = W.with_token_ids(df)
    for windows in (W.fixed_step_windows, W.overlap_windows):
        got = {r["row_id"]: r["window_ids"] for r in windows(ids).collect()}
        assert got[1] == [CLS_ID, SEP_ID] and len(got[2]) == 4
