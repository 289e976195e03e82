"""Hard negatives: intervals hold the scores, results equal brute force, defined cases."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clausework.llm import exact, hard_negatives as H
from clausework.llm import queries as Q

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchors, positives=5, negatives=3, lowest=50, highest=95, scale=256):
    """All rows of the result by scoring every pair."""
    ok = [(i, tuple(math.floor(scale * x) for x in v), y) for i, v, y in rows
          if i is not None and y is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v, y in ok:
        if anchors(i):
            asked[i] = min(asked.get(i, (y, v)), (y, v))
    out = set()

    def ranked(pairs, k):
        best = {}
        for s, i in pairs:
            best[i] = max(best.get(i, s), s)
        return sorted(((-s, i) for i, s in best.items()))[:k]

    for a, (y, v) in asked.items():
        scored = [(sum(p * q for p, q in zip(v, w)), i, z) for i, w, z in ok if i != a and len(w) == len(v)]
        for minus, p in ranked([(s, i) for s, i, z in scored if z == y], positives):
            fits = [(s, i) for s, i, z in scored if z != y and lowest * -minus <= 100 * s <= highest * -minus]
            out |= {(a, p, n, i, -minus, -m) for n, (m, i) in enumerate(ranked(fits, negatives), 1)}
    return out


def mined(spark, rows, anchors, **options):
    got = H.mine(spark.createDataFrame(rows, SCHEMA), anchors, **options).collect()
    assert len(set(got)) == len(got)
    return {tuple(r) for r in got}


def vectors(n, length, seed, labels=3):
    g = np.random.default_rng(seed)
    centres = g.standard_normal((4, length))
    return [(i, (centres[i % 4] + 0.7 * g.standard_normal(length)).tolist(), int(g.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("length", [1, 3, 64, 130])
def test_intervals_hold_the_scores(length):
    g = np.random.default_rng(length)
    turns = H.rotations(length, 5)
    assert all(np.allclose(t @ t.T, np.eye(length)) for t in turns)
    x, q = np.floor(256 * g.standard_normal((300, length))), np.floor(256 * g.standard_normal((9, length)))
    x[0], q[0], x[1] = 0, 0, q[1]
    score, last = q @ x.T, np.inf
    for codes in (1, 2, 5):
        code, along, residual = H.encode(x, turns[:codes])
        low, high = H.intervals(q, code, along, residual, turns[:codes])
        assert (low <= score).all() and (score <= high).all()
        if length >= 64:  # every code narrows them, and the first is narrower than what lengths alone tell
            norms = np.sqrt((q ** 2).sum(axis=1))[1:, None] * np.sqrt((x ** 2).sum(axis=1))[None, 1:]
            width = ((high - low)[1:, 1:] / (2 * norms)).mean()
            assert width < min(0.7, 0.7 * last)
            last = width


def test_intervals_rule_out_most_rows():
    """Without any structure in the vectors, few rows are scored, and the answer is that of scoring all."""
    g = np.random.default_rng(4)
    x = g.standard_normal((4000, 64))
    x = np.floor(256 * x / np.sqrt((x ** 2).sum(axis=1, keepdims=True)))
    labels, ids = g.integers(0, 10, 4000), np.arange(4000)
    code, along, residual = H.encode(x, H.rotations(64))
    rows = pd.DataFrame({"vec_id": ids, "label": labels, "vec": list(x), "code": [c.tobytes() for c in code], "along": list(along), "residual": residual})
    asked = pd.DataFrame({"query_id": ids[:40], "label": labels[:40], "vec": list(x[:40])})
    scored, real = [], H._Block.scores

    def counting(self, some, anchor):
        scored.append(len(some))
        return real(self, some, anchor)

    H._Block.scores = counting
    try:
        near = H._positives(asked, rows, 5)
        best = {i: [{"vec_id": v, "score": s} for v, s in zip(r["vec_id"], r["score"])] for i, r in near.groupby("query_id")}
        far = H._negatives(asked.assign(positives=[best[i] for i in ids[:40]]), rows, 3, 50, 95)
    finally:
        H._Block.scores = real
    assert sum(scored) < 0.1 * 40 * 4000
    assert {(a, p, s) for a, p, s in near.itertuples(index=False)} == {
        (a, p, int(x[a] @ x[p])) for a in range(40) for p in sorted(np.flatnonzero((labels == labels[a]) & (ids != a)), key=lambda p: (-(x[a] @ x[p]), p))[:5]}
    for a, p, n, ps, ns in far.itertuples(index=False):
        assert labels[n] != labels[a] and ns == int(x[a] @ x[n]) and 50 * ps <= 100 * ns <= 95 * ps


@pytest.mark.parametrize("options", [{}, {"row_block": 40, "anchor_block": 7}, {"positives": 2, "negatives": 1}, {"lowest": 0, "highest": 100}])
def test_equals_brute_force(spark, options):
    rows = vectors(240, 16, 2)
    own = {k: v for k, v in options.items() if "block" not in k}
    got = mined(spark, rows, F.col("vec_id") % 5 == 0, **options)
    assert got == brute(rows, lambda i: i % 5 == 0, **own) and got


def test_defined_cases(spark):
    rows = vectors(60, 4, 5, 2) + [(100, None, 1), (101, [1.0, None, 0.0, 0.0], 1), (102, [NAN, 0.0, 0.0, 0.0], 0), (103, [INF, 0.0, 0.0, 0.0], 0),
                                   (104, [1.0, 1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0, 1.0], 1), (105, [], 1), (106, [2.0, 1.0], 0),
                                   (108, [1.9, 1.1], 0), (109, [1.5, 0.5], 1), (110, [0.0] * 4, 0)]
    rows += [(2, rows[7][1], 0), (2, rows[9][1], 1), rows[3], rows[3], (0, rows[11][1], 1)]  # repeated ids, other vectors and labels
    want = brute(rows, lambda i: i % 2 == 0)
    assert mined(spark, rows, F.col("vec_id") % 2 == 0) == want and any(a == 106 for a, *_ in want)


def test_negative_scores_have_an_empty_band(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.7, 0.0], 2), (3, [0.0, 1.0], 1), (4, [0.0, -1.0], 2)]
    want = brute(rows, lambda i: i == 0)
    assert mined(spark, rows, F.col("vec_id") == 0) == want == {(0, 3, 1, 4, 0, 0)}


def test_large_components_are_exact_and_too_large_ones_refused(spark):
    rows = [(0, [2e6, 1.0, 0.0], 1), (1, [2e6, -3.0, 1.0], 1), (2, [1.5e6, 7.0, 0.1], 2), (3, [1.4999999e6, 9.0, 0.2], 2), (4, [1.0, 1.0, 1.0], 2)]
    assert mined(spark, rows, F.col("vec_id") == 0) == brute(rows, lambda i: i == 0)
    with pytest.raises(Exception, match="leaves a long"):
        mined(spark, [(0, [1e17], 1), (1, [1e17], 1), (2, [0.9e17], 2)], F.col("vec_id") == 0)


def test_inner_products_of_every_size():
    g = random.Random(1)
    for size in (3, 2**20, 2**27, 2**30):
        x = np.array([[float(g.randint(-size, size)) for _ in range(5)] for _ in range(20)] + [[1.0] * 5])
        q = np.array([float(g.randint(-size, size)) for _ in range(5)])
        assert exact.inner_products(x, q).tolist() == [sum(int(a) * int(b) for a, b in zip(r, q)) for r in x]


def test_empty_table_and_other_columns(spark):
    assert H.mine(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    rows = vectors(30, 4, 1)
    df = spark.createDataFrame([(i, v, y, "x", 1) for i, v, y in rows], "id long, v array<double>, y int, rank string, query_id int")
    got = {tuple(r) for r in H.mine(df, F.col("vec_id") % 3 == 0, "id", "v", "y").collect()}
    assert got == brute(rows, lambda i: i % 3 == 0)


def test_query_equals_brute_force(spark, sf_small):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    rows = [(i, v, (y + 1) % 10 if i % 7 == 0 and y is not None else y) for i, v, y in rows]
    got = {tuple(r) for r in Q.QUERIES["op12_one_bit_hard_negatives"](spark, sf_small).collect()}
    assert got == brute(rows, lambda i: i % 50 == 0)
