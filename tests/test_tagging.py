"""Pooling and decision rules; narrow path == joined path == plug-in models."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clausework.operators import labels as L, scoring, tagging, windows as W
from clausework.plans import pipelines
from clausework.sources import tables

NAN = float("nan")
CASES = {
    1: ([0.1, 0.3, 0.2], ["L1"]),           # none passes -> argmax
    2: ([0.5, 0.49, 0.9], ["L0", "L2"]),    # exact 0.5 passes, id order
    3: ([0.2, 0.4, 0.4], ["L1"]),           # tie -> smaller id
    4: ([0.2, NAN, 0.3], ["L1"]),           # NaN never passes; the first NaN wins the argmax
    5: ([NAN, 0.9, NAN], ["L1"]),
    6: (None, ["Unknown"]),                 # failed row
}


@pytest.fixture(scope="module")
def small(spark, sf_small):
    vocab = L.vocabulary(tables.gold_actors(tables.table(spark, sf_small, "documents"), tables.table(spark, sf_small, "labels")))
    vocab.cache()
    return tables.documents(spark, sf_small), vocab, scoring.hash_head(vocab)


def test_decision_rules(spark):
    df = spark.createDataFrame([(i, p) for i, (p, _) in CASES.items()], "row_id long, probs array<double>")
    names = ["L0", "L1", "L2"]
    got = {r[0]: r[1] for r in df.select("row_id", tagging.decided(F.col("probs"), names)).collect()}
    assert got == {i: want for i, (_, want) in CASES.items()}
    with pytest.raises(Exception, match="scoring failed for clause 6"):
        df.select(tagging.decided(F.col("probs"), names, on_error="raise", key=F.col("row_id"))).collect()
    with pytest.raises(ValueError):
        tagging.decided(F.col("probs"), names, on_error="other")


def test_long_decision_agrees(spark):
    vocab = spark.createDataFrame([(i, f"L{i}") for i in range(3)], "label_id int, label string")
    rows = [(i, k, p) for i, (ps, _) in CASES.items() if ps for k, p in enumerate(ps)]
    probs = spark.createDataFrame(rows, "row_id long, label_id int, p double")
    assert {r[0]: r[1] for r in tagging.decide(probs, vocab).collect()} == {i: w for i, (p, w) in CASES.items() if p}


def test_pool_is_mean_of_sigmoid(spark):
    want = (1 / (1 + math.exp(-2)) + 1 / (1 + math.exp(1))) / 2
    df = spark.createDataFrame([(1, [[2.0, 0.0], [-1.0, 0.0]])], "row_id long, z array<array<double>>")
    assert df.select(tagging.pooled(F.col("z"), 2)).first()[0] == pytest.approx([want, 0.5])
    logits = spark.createDataFrame([(1, 0, 0, 2.0), (1, 1, 0, -1.0)], "row_id long, window int, label_id int, logit double")
    assert math.isclose(tagging.pool(logits).first()["p"], want)


def tags(df):
    return {r[0]: r[1] for r in df.collect()}


def test_narrow_equals_joined(small):
    docs, vocab, head = small
    ids = W.with_token_ids(docs)
    probs = tagging.pool(scoring.score_windows(W.overlap_windows(ids), head))
    got = tags(pipelines.tag(docs, head, vocab))
    assert got == tags(tagging.decide(probs, vocab)) and len(got) == docs.count()


def test_a_head_too_large_is_joined(small, monkeypatch):
    docs, vocab, head = small
    want = tags(pipelines.tag(docs.limit(20), head, vocab))
    monkeypatch.setattr(scoring, "MAX_CELLS", 10)
    assert tags(pipelines.tag(docs.limit(20), head, vocab)) == want


def test_feature_count_is_one_parameter(small):
    docs, vocab, _ = small
    some = docs.limit(30)
    narrow = tags(pipelines.tag(some, scoring.hash_head(vocab, n_features=1024), vocab))
    ids = W.with_token_ids(some)
    long = tagging.pool(scoring.score_windows(W.overlap_windows(ids), scoring.hash_head(vocab, n_features=1024), n_features=1024))
    assert narrow == tags(tagging.decide(long, vocab))
    used = {t % 1024 for r in ids.select("ids").collect() for t in r[0]}
    assert max(used) > 255


def test_invariant_to_partitioning(small):
    docs, vocab, head = small
    assert tags(pipelines.tag(docs, head, vocab)) == tags(pipelines.tag(docs.repartition(3).orderBy(F.rand(7)), head, vocab))


def test_null_clause_is_text_nan(spark):
    vocab = spark.createDataFrame([(0, "A"), (1, "B")], "label_id int, label string")
    df = spark.createDataFrame([(1, None), (2, "nan")], "row_id long, clause string")
    got = tags(pipelines.tag(df, scoring.hash_head(vocab), vocab))
    assert got[1] == got[2]


def _recording(fail: bool):
    """A model of two labels that refuses batches over the size asked for, and windows with token 13 if told to."""
    def make():
        def predict(input_ids, attention_mask):
            if len(input_ids) > 4 or attention_mask.sum(axis=1).max() != input_ids.shape[1]:
                raise RuntimeError("batch too large or padded beyond its longest window")
            if fail and (input_ids == 13).any():
                raise RuntimeError("no score")
            z = (input_ids * attention_mask).sum(axis=1) % 5 - 2.0
            return np.stack([z, -z], axis=1)
        return predict
    return make


def test_windows_batches_and_failures(spark):
    rows = [(i, list(range(3, 3 + n))) for i, n in enumerate([0, 1, 5, 9, 10, 11, 12, 30, 31])] + [(99, None)]
    df = spark.createDataFrame(rows, "row_id long, ids array<int>").coalesce(1)

    def logits(ids, fixed):
        full = [1, *(ids or []), 2]
        if fixed:
            wins = [full[s:s + 10] for s in range(0, len(full), 5)]
        else:
            ids, wins, s = ids or [], [], 0
            while True:
                wins.append([1, *ids[s:s + 8], 2])
                if s + 8 >= len(ids):
                    break
                s += 5
        return [None if 13 in w else [sum(w) % 5 - 2.0, 2.0 - sum(w) % 5] for w in wins]

    for windowing, options in (("overlap", {"overlap": 3}), ("fixed", {"step": 5})):
        for fail in (False, True):
            z = scoring.window_logits(F.col("ids"), _recording(fail), windowing=windowing, max_length=10, batch_size=4, **options)
            got = {r[0]: r[1] for r in df.select("row_id", z).collect()}
            for i, ids in rows:
                want = logits(ids, windowing == "fixed")
                if not fail:
                    assert all(w is not None or 13 in (ids or []) for w in want)
                    assert got[i] is not None and len(got[i]) == len(want)
                else:
                    assert got[i] == (None if None in want else want), (i, windowing)
