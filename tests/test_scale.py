"""Distinct pairs over the whole table, balanced partitions, one outcome on both sides of every size bound."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clausework.functions.text import tokens
from clausework.operators import balance, labels as L, metrics as M, pairs, scoring, stance as Z
from clausework.plans import pipelines
from clausework.sources import tables


ROWS = [(1, "the tone regarding Rebels is supportive", "['Rebels', 'Donors']"), (1, "the tone regarding Rebels is supportive", "['Rebels', 'Rebels']"),
        (2, "the tone regarding Rebels is supportive", "['Donors', '']"), (3, "", "['Rebels']"), (4, None, "['Rebels']"), (5, "other words", None),
        (6, "other words", "{[]:1}"), (7, "other words", "[]"), (8, "other words", "['Rebels']")] + [(9, "a hot premise", "['Rebels']")] * 40


@pytest.mark.parametrize("salt_rows", [100_000, 7])
def test_distinct_pairs_give_the_same_lists(spark, monkeypatch, salt_rows):
    monkeypatch.setattr(pairs, "MOST_HOT", 100)
    df = spark.createDataFrame(ROWS, "row_id long, clause string, predicted_actors string").repartition(5)
    want = Z.stance(df, pair_model=scoring.overlap_pair_model)
    got = pairs.stance_distinct(df, scoring.overlap_pair_model, salt_rows=salt_rows)
    assert got.columns == want.columns
    key = lambda d: sorted((str(r.row_id), str(r.clause), str(r.predicted_sentiments), str([tuple(s) for s in r.sentiment_scores])) for r in d.collect())
    assert key(got) == key(want)


def test_the_model_gets_each_pair_once(spark):
    df = spark.createDataFrame(ROWS, "row_id long, clause string, predicted_actors string").repartition(5)
    got = pairs.distinct_scores(df, scoring.overlap_pair_model, batch_size=4).collect()
    assert len(got) == len({(bytes(r.premise_hash), r.actor) for r in got}) == 4
    assert all(r.calls == [1] * 9 for r in got) and {r.rows for r in got} == {3, 2, 1, 40}


def test_failed_pairs_count_their_tries(spark):
    def weak():
        fn = scoring.overlap_pair_model()

        def score(premises, hypotheses, max_length):
            if any("unfavorable" in h for h in hypotheses):
                raise RuntimeError("no score")
            return fn(premises, hypotheses, max_length)
        return score

    df = spark.createDataFrame(ROWS, "row_id long, clause string, predicted_actors string")
    key = lambda d: sorted((str(r.row_id), str(r.clause), str(r.sentiment_scores)) for r in d.collect())
    assert key(pairs.stance_distinct(df, weak)) == key(Z.stance(df, pair_model=weak))
    for r in pairs.distinct_scores(df, weak, batch_size=9).collect():
        assert r.scores[4] is None and sum(s is None for s in r.scores) == 1 and r.calls == [2] * 9


def test_a_hypothesis_is_read_once():
    """Actors come back with every premise; the words of their hypotheses are found once."""
    class Read(str):
        times = 0

        def lower(self):
            Read.times += 1
            return str.lower(self)

    fn = scoring.overlap_pair_model()
    h = Read("The tone regarding Rebels is supportive.")
    got = fn([f"{i} the rebels\tis\x0b the" for i in range(50)], [h] * 50, None)
    assert Read.times == 1
    # "is" and a vertical tab are one word
    assert got[:, 0].tolist() == [2 / 6] * 50


def test_a_worker_takes_few_pairs_of_a_batch(spark, monkeypatch):
    """Pairs leave an Arrow batch some at a time, in the model calls that the whole batch would give."""
    sizes = spark.createDataFrame([(str(i), [f"a{j}" for j in range(3)]) for i in range(9)], "clause string, predicted_actors array<string>").coalesce(1)

    def counting():
        return lambda premises, hypotheses, _: [[len(premises), 0, 0]] * len(premises)

    monkeypatch.setattr(pairs, "PAIRS", 8)
    one = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = pairs.distinct_scores(sizes, counting, batch_size=4).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", one)
    seen = sorted(x for r in got for x in r.scores)
    assert len(got) == 27 and seen == [3.0] * 3 + [4.0] * 240


def test_empty_tables(spark):
    df = spark.createDataFrame([], "row_id long, clause string, predicted_actors string")
    assert pairs.stance_distinct(df, scoring.overlap_pair_model).count() == 0
    assert balance.balanced(df, F.length("clause"), 4).count() == 0


@pytest.mark.parametrize("parts", [1, 5, 16])
def test_balanced_partitions(spark, parts):
    rnd = np.random.default_rng(3)
    sizes = [int(x) for x in np.minimum(5000, rnd.pareto(1.0, 4000) * 20 + 1)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sorted(sizes))], "id long, n int").repartition(7)
    out = balance.balanced(df, F.col("n"), parts)
    load = [r.weight for r in balance.loads(out, F.col("n")).collect()]
    mean = sum(sizes) / parts
    assert len(load) == parts and sum(load) == sum(sizes) and max(load) <= mean + max(sizes)
    assert sorted(tuple(r) for r in out.collect()) == sorted(tuple(r) for r in df.collect())


def test_rows_without_weight_stay(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, -4)], "id long, n int")
    assert sorted(r.id for r in balance.balanced(df, F.col("n"), 3).collect()) == [1, 2, 3]


def test_tags_do_not_depend_on_the_balance(spark, sf_small):
    docs, vocab = tables.documents(spark, sf_small), L.vocabulary(tables.clauses(spark, sf_small), "actors")
    head = scoring.hash_head(vocab)
    even = balance.balanced(docs, F.size(tokens(F.col("clause"))), 6)
    load = [r.weight for r in balance.loads(even, F.size(tokens(F.col("clause")))).collect()]
    assert max(load) <= 1.2 * sum(load) / 6
    key = lambda d: sorted((r.row_id, tuple(r.predicted_actors)) for r in d.collect())
    assert key(pipelines.tag(even, head, vocab)) == key(pipelines.tag(docs, head, vocab))


def test_rows_that_repeat_a_key_are_kept_apart(spark, monkeypatch):
    """The joined paths give what the paths beside the row give."""
    vocab = spark.createDataFrame([(0, "a"), (1, "b")], "label_id int, label string")
    df = spark.createDataFrame([(1, ["a"]), (1, ["b"]), (2, None), (None, ["b", "a", "b"]), (None, [])], "row_id long, actors array<string>")
    key = lambda d, c: sorted((str(r.row_id), str(r[c])) for r in d.collect())
    want = key(L.with_label_ids(df, vocab), "label_ids")
    monkeypatch.setattr(L, "INLINE_LABELS", 1)
    monkeypatch.setattr(L.label_names, "__defaults__", (None, 1))
    assert key(L.with_label_ids(df, vocab), "label_ids") == want == key(L.label_ids(df, vocab), "label_ids")


def _model():
    def predict(input_ids, attention_mask):
        z = (input_ids * attention_mask).sum(axis=1) % 7 - 3.0
        return np.stack([z, -z, z * 0], axis=1)
    return predict


def _weak():
    fn = _model()

    def predict(input_ids, attention_mask):
        if len(input_ids) > 1 or input_ids.shape[1] == 5:
            raise RuntimeError("no score")
        return fn(input_ids, attention_mask)
    return predict


@pytest.mark.parametrize("make", [None, _model, _weak])
def test_tags_on_both_sides_of_the_bounds(spark, monkeypatch, make):
    vocab = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "label_id int, label string")
    head = scoring.hash_head(vocab, n_features=64)
    rows = [(1, "one two"), (1, "other words here"), (2, None), (None, "x"), (None, ""), (3, " ".join(str(i) for i in range(1200)))]
    df = spark.createDataFrame(rows, "row_id long, clause string")
    key = lambda d: sorted((str(r.row_id), str(r.clause)[:20], str(r.predicted_actors)) for r in d.collect())
    options = dict(make_predict_fn=make, n_features=64, keep=("clause",))
    want = key(pipelines.tag(df, head, vocab, **options))
    assert len(want) == len(rows)
    monkeypatch.setattr(pipelines, "MAX_NAMES", 2)
    assert key(pipelines.tag(df, head, vocab, **options)) == want


def test_counts_beside_the_row_equal_cells(spark):
    rows = [(1, [[0.5, -1.0, float("nan")], [2.0, 0.0, -3.0]], [0, 2]), (2, [[0.1, 0.2, -0.3]], []), (3, [], [1]), (4, None, [0])]
    df = spark.createDataFrame(rows, "row_id long, logits array<array<double>>, label_ids array<int>")
    cells = M.cells(df)
    want, loss = M.confusion(cells).first(), M.bce_loss(cells.where("NOT isnan(logit)")).first()
    got = M.confusion_counts(df).first()
    assert (got.tp, got.fp, got.fn, got.tn) == tuple(want)
    clean = df.withColumn("logits", F.expr("transform(logits, w -> filter(w, z -> NOT isnan(z)))"))
    assert abs(M.mean_loss(M.confusion_counts(clean)).first().loss - loss.loss) < 1e-12
    assert M.mean_loss(M.confusion_counts(df.limit(0))).first().n_cells == 0
