"""Plug-in surfaces: foreign tokenizer, entailment model, training pipeline, streaming."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from clausework.functions.text import N_FEATURES
from clausework.operators import labels as L, scoring, stance as Z, windows as W
from clausework.plans import pipelines
from clausework.session import scratch_path
from clausework.sources import tables


def test_foreign_tokenizer(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocab = {"[UNK]": 0, "[CLS]": 1, "[SEP]": 2, "[PAD]": 3, "hello": 4, "world": 5}
    tok = Tokenizer(models.WordLevel(vocab, unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    path = str(tmp_path / "tok.json")
    tok.save(path)

    def make():
        t = Tokenizer.from_file(path)
        return lambda texts: [e.ids for e in t.encode_batch(texts)]

    df = spark.createDataFrame([(1, "hello world"), (2, "world zzz hello"), (3, None)], "row_id long, clause string")
    got = {r[0]: r[1] for r in W.with_foreign_token_ids(df, make).select("row_id", "ids").collect()}
    assert got == {1: [4, 5], 2: [5, 0, 4], 3: None}
    wins = W.overlap_windows(W.with_foreign_token_ids(df.where("row_id < 3"), make), cls_id=1, sep_id=2)
    assert [list(r[0]) for r in wins.orderBy("row_id").select("window_ids").collect()] == [[1, 4, 5, 2], [1, 5, 0, 4, 2]]


_WORD = re.compile(r"[^ \t\n\r]+")


def _overlap_model():
    def fn(premises, hypotheses, max_length):
        out = []
        for p, h in zip(premises, hypotheses):
            hyp = _WORD.findall(h.lower())
            budget = 1 << 30 if max_length is None else max_length - 3 - len(hyp)
            prem = _WORD.findall(p.lower())[:max(budget, 0)]
            d = list(dict.fromkeys(hyp))
            if len(premises) > 5:
                raise AssertionError("a call of over batch_size pairs")
            if budget < 0 or not d:
                raise ValueError("hypothesis does not fit")
            out.append([sum(1 for x in d if x in set(prem)) / len(d), 0.0, 0.0])
        return np.array(out)
    return fn


@pytest.mark.parametrize("limit", [None, 512])
def test_pair_model_equals_relational(spark, sf_small, limit):
    """Both scorers read whole premises unless a limit is given, and then the same part of them."""
    src = tables.stance_input(spark, sf_small)
    a = Z.stance(src, attach=False, max_length=limit).select("row_id", "predicted_sentiments", "sentiment_scores")
    b = Z.stance(src, attach=False, pair_model=_overlap_model, batch_size=5, max_length=limit).select(
        "row_id", "predicted_sentiments", "sentiment_scores")
    ra = {r[0]: (r[1], [tuple(round(v, 9) for v in s) for s in r[2]]) for r in a.collect()}
    rb = {r[0]: (r[1], [tuple(round(v, 9) for v in s) for s in r[2]]) for r in b.collect()}
    assert ra == rb and len(ra) > 0


def _broken():
    def fn(premises, hypotheses, max_length):
        raise RuntimeError("model down")
    return fn


def test_failed_templates_count_zero(spark):
    df = spark.createDataFrame([(1, "text", "['A', 'B']")], "row_id long, clause string, predicted_actors string")
    r = Z.stance(df, pair_model=_broken).first()
    assert r["predicted_sentiments"] == ["positive", "positive"]
    assert [tuple(s) for s in r["sentiment_scores"]] == [(0.0, 0.0, 0.0), (0.0, 0.0, 0.0)]


def test_fit_tagger_with_warm_start(spark, sf_small):
    c = tables.clauses(spark, sf_small).select("row_id", "clause", F.col("actors_text").alias("regularized_actors"))
    old_vocab = spark.createDataFrame([(0, "en"), (1, "Politicians")], "label_id int, label string")
    old_head = scoring.hash_head(old_vocab, salt="old")
    warm = spark.createDataFrame([("Government", "Politicians"), ("src1", "en")], "new_label string, old_label string")
    out = pipelines.fit_tagger(c, old_head=old_head, old_vocab=old_vocab, warm_map=warm, epochs=2, steps_per_epoch=1)
    assert {r[0] for r in out["skipped"].collect()} == {"Government"}
    assert out["epochs"].count() == 2 and out["metrics"].count() == 1
    assert out["head"].count() == out["vocab"].count() * (N_FEATURES + 1)
    assert set(out["heads"]) == {1, 2}


def test_stream_equals_batch(spark, sf_small):
    src = tables.stance_input(spark, sf_small)
    inbox = scratch_path(spark, "inbox")
    src.repartition(3).write.parquet(inbox)
    stream = spark.readStream.schema(src.schema).parquet(inbox)
    sink = scratch_path(spark, "stream-out")
    from clausework.streaming import stance_stream
    q = stance_stream(stream, sink, available_now=True)
    q.awaitTermination(300)
    got = spark.read.parquet(sink).drop("epoch")
    want = Z.stance(src)
    assert got.count() == want.count()
    assert got.select("row_id", "predicted_sentiments").exceptAll(want.select("row_id", "predicted_sentiments")).count() == 0


def _signed_model():
    def fn(premises, hypotheses, max_length):
        # entailment logit -1 for the "positive" templates, 0 for the others
        pos = ("is positive.", "are favorable.", "is supportive.")
        return np.array([[-1.0 if h.endswith(pos) else 0.0, 0.0, 0.0] for h in hypotheses])
    return fn


def test_negative_beats_neutral_on_equal_zero(spark):
    df = spark.createDataFrame([(1, "text", "['A']")], "row_id long, clause string, predicted_actors string")
    r = Z.stance(df, pair_model=_signed_model).first()
    assert r["predicted_sentiments"] == ["negative"]
    assert [tuple(s) for s in r["sentiment_scores"]] == [(-1.0, 0.0, 0.0)]


def test_tag_stream_equals_batch(spark, sf_small):
    c = tables.clauses(spark, sf_small).select("row_id", "clause")
    vocab = L.vocabulary(tables.clauses(spark, sf_small), "actors")
    head = scoring.hash_head(vocab)
    inbox = scratch_path(spark, "tag-inbox")
    c.repartition(2).write.parquet(inbox)
    sink = scratch_path(spark, "tag-out")
    from clausework.streaming import tag_stream
    q = tag_stream(spark.readStream.schema(c.schema).parquet(inbox), head, vocab, sink, available_now=True)
    q.awaitTermination(300)
    got = {r[0]: r[1] for r in spark.read.parquet(sink).select("row_id", "predicted_actors").collect()}
    want = {r[0]: r[1] for r in pipelines.tag(c, head, vocab).collect()}
    assert got == want and len(got) == c.count()


def _counting_model():
    """Entailment in column 2; fails on one actor; checks the size of every call."""
    def fn(premises, hypotheses, max_length):
        assert len(premises) <= 3 and max_length == 64
        if any("Bad" in h for h in hypotheses):
            raise RuntimeError("no score")
        return np.array([[9.0, 9.0, float(len(h))] for h in hypotheses])
    return fn


def test_batch_size_entailment_index_and_failures(spark):
    df = spark.createDataFrame([(1, "text", "['A', 'Bad', '', 'A']"), (2, "", "['A']"), (3, "text", "['A']")],
                               "row_id long, clause string, predicted_actors string")
    got = {r["row_id"]: r for r in Z.stance(df, pair_model=_counting_model, batch_size=3, entail_idx=2, model_max_length=64).collect()}
    mean = sum(len(t.replace("{actor}", "A")) for s, t in Z.TEMPLATES if s == "positive") / 3
    assert got[1]["sentiment_scores"][0]["positive"] == mean == got[3]["sentiment_scores"][0]["positive"]
    assert tuple(got[1]["sentiment_scores"][1]) == (0.0, 0.0, 0.0) and got[1]["predicted_sentiments"][2] == "neutral"
    assert got[1]["sentiment_scores"][3] == got[1]["sentiment_scores"][0] and got[2]["predicted_sentiments"] == ["neutral"]


def test_tag_and_fit_with_a_foreign_tokenizer(spark, sf_small):
    def make():
        return lambda texts: [[10 + len(w) for w in t.split()] for t in texts]

    c = tables.clauses(spark, sf_small).limit(60)
    rows = c.select("row_id", "clause", F.col("actors_text").alias("regularized_actors"))
    out = pipelines.fit_tagger(rows, make_tokenizer=make, cls_id=7, sep_id=8, epochs=1, steps_per_epoch=1, n_features=64)
    assert out["head"].count() == out["vocab"].count() * 65
    got = pipelines.tag(c.select("row_id", "clause"), out["head"], out["vocab"], make_tokenizer=make, cls_id=7, sep_id=8)
    assert got.count() == 60


def test_models_are_kept_by_identity():
    from clausework.operators._util import built, worker_cache

    made = []

    def factory(n):
        def make():
            made.append(n)
            return n
        return make

    for n in (1, 1, 2, 2, 1):
        assert built("test-slot", str(n), factory(n)) == n
    assert made == [1, 2, 1] and len([k for k in worker_cache() if k == "test-slot"]) == 1
