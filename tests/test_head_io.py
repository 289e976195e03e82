"""Fitting and sinks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clausework.operators import head as H, labels as L, scoring
from clausework.plans import pipelines
from clausework.session import scratch_path
from clausework.sources import io, tables


def test_fit_loss_falls(spark, sf_small):
    c = tables.clauses(spark, sf_small)
    vocab = L.vocabulary(c, "actors")
    x = H.window_rows(pipelines.training_windows(L.with_label_ids(c, vocab)))
    init = scoring.hash_head(vocab)
    _, epochs, heads = H.fit(x, init, evaluation=x, epochs=3, steps_per_epoch=2, lr=0.05)
    losses = [r["loss"] for r in epochs.orderBy("epoch").collect()]
    assert losses[-1] < losses[0] and len(heads) == 2
    assert epochs.where("best").count() == 1
    # mini-batches: three parts, updated after two and after one of them, evaluated in between
    _, epochs, heads = H.fit(x, init, evaluation=x, epochs=1, batches=3, accumulate=2, eval_every=1, keep=1)
    assert [(r["epoch"], r["step"], r["best"]) for r in epochs.orderBy("step").collect()] == [(1, 1, False), (1, 2, True)] and len(heads) == 1


def test_csv_roundtrip_and_backup(spark):
    rows = [(1, 'he said "hi", then\nleft', "['a']"), (2, "  leading blank", "['b', 'c']"),
            (3, "back\\slash", None), (4, "NA", "[]")]
    df = spark.createDataFrame(rows, "row_id long, clause string, predicted_actors string") \
        .withColumn("lst", F.array(F.lit("x"), F.lit("y")))
    path = scratch_path(spark, "csv-test")
    rep = io.save_with_backup(df, path)
    assert rep["rows_written"] == rep["rows_read"] == rep["rows_backup"] == 4 and rep["backup"] != path
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("clause", T.StringType()),
                           T.StructField("predicted_actors", T.StringType()), T.StructField("lst", T.StringType())])
    back = {r["row_id"]: r for r in io.read_csv(spark, path, schema).collect()}
    assert back[1]["clause"] == rows[0][1]
    assert back[2]["clause"] == rows[1][1]
    assert back[3]["clause"] == rows[2][1] and back[3]["predicted_actors"] is None
    assert back[4]["clause"] is None                      # "NA" reads as null, as pandas does
    copy = {r["row_id"]: r for r in io.read_csv(spark, rep["backup"], schema).collect()}
    assert copy == back
    assert back[1]["lst"] == '["x","y"]'


def test_one_step_equals_numpy_gradient(spark):
    import numpy as np

    n = 256
    wins = spark.createDataFrame([(1, 0, [5, 6, 6], [0]), (1, 1, [7], [0]), (2, 0, [5, 300, 9], [1])],
                                 "row_id long, window int, window_ids array<int>, label_ids array<int>")
    vocab = spark.createDataFrame([(0, "A"), (1, "B")], "label_id int, label string")
    init = scoring.hash_head(vocab, n_features=n)
    lr, decay = 0.5, 0.1
    head, _, _ = H.fit(H.window_rows(wins, n), init, epochs=1, steps_per_epoch=1, lr=lr, weight_decay=decay, warmup_ratio=0.0)

    w0 = {(r["label_id"], r["feature"]): r["weight"] for r in init.collect()}
    feats = [-1, *range(n)]
    W0 = np.array([[w0[(k, f)] for f in feats] for k in range(2)])
    X = np.zeros((3, len(feats)))
    for i, ids in enumerate([[5, 6, 6], [7], [5, 300, 9]]):
        X[i, 0] = 1.0
        for t in ids:
            X[i, 1 + t % n] += 1
    Y = np.array([[1, 0], [1, 0], [0, 1]], dtype=float)
    R = 1 / (1 + np.exp(-(X @ W0.T))) - Y
    D = decay * W0
    D[:, 0] = 0
    W1 = W0 - lr * (R.T @ X / 3 + D)
    got = {(r["label_id"], r["feature"]): r["weight"] for r in head.collect()}
    assert np.allclose([[got[(k, f)] for f in feats] for k in range(2)], W1, atol=1e-12)


def test_metrics_and_label_map_sinks(spark):
    from clausework.operators import metrics as M

    conf = spark.createDataFrame([(3, 1, 1, 4)], "tp long, fp long, fn long, tn long")
    path = scratch_path(spark, "eval-json")
    io.write_json_row(M.macro_metrics(conf), path)
    back = spark.read.json(path).first()
    assert abs(back["accuracy"] - 7 / 9) < 1e-12 and abs(back["f1"] - 0.775) < 1e-12

    vocab = L.vocabulary(spark.createDataFrame([(1, ["b", "a"]), (2, ["c", "a"])], "row_id long, actors array<string>"))
    lpath = scratch_path(spark, "label-map")
    io.write_json_row(L.label_map(vocab), lpath)
    assert spark.read.json(lpath).first()["classes"] == ["a", "b", "c"]


def test_best_epoch_keeps_top_two_first_wins_ties(spark):
    t = spark.createDataFrame([(1, 0.5), (2, 0.7), (3, 0.7), (4, 0.6)], "epoch int, f1 double")
    got = [(r["epoch"], r["rank"]) for r in H.best_epoch(t).orderBy("rank").collect()]
    assert got == [(2, 1), (3, 2)]


def test_validation_and_missing_path(spark):
    import pytest

    from clausework.operators import clean

    with pytest.raises(ValueError, match="lacks predicted_actors"):
        clean.validate(spark.createDataFrame([(1, "x")], "row_id long, clause string"))
    with pytest.raises(ValueError, match="no rows"):
        clean.validate(spark.createDataFrame([], "clause string, predicted_actors string"))
    schema = T.StructType([T.StructField("clause", T.StringType())])
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        io.read_csv(spark, scratch_path(spark, "missing") + "/none.csv", schema).collect()
    prof = clean.profile(spark.createDataFrame([("a", None), (None, "[]")], "clause string, predicted_actors string"))
    assert tuple(prof.first()) == (2, 1, 1)


def test_null_spellings_of_pandas(spark):
    from clausework.operators.clean import NA_VALUES

    texts = [*NA_VALUES, "nothing", " NA", "none"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id long, clause string")
    path = scratch_path(spark, "nulls")
    io.write_csv(df, path)
    got = {r["row_id"]: r["clause"] for r in io.read_csv(spark, path, df.schema).collect()}
    assert [got[i] for i in range(len(texts))] == [None] * len(NA_VALUES) + texts[len(NA_VALUES):]


def test_a_bad_line_fails_the_read(spark, tmp_path):
    import pytest

    (tmp_path / "bad.csv").write_text("row_id,clause\n1,a\nx,b\n")
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("clause", T.StringType())])
    with pytest.raises(Exception):
        io.read_csv(spark, str(tmp_path / "bad.csv"), schema).collect()


def test_stance_file_entry(spark):
    import pytest

    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("clause", T.StringType()), T.StructField("predicted_actors", T.StringType())])
    df = spark.createDataFrame([(1, "comments about zed are unfavorable.", "['Zed']"), (2, None, "n/a")], schema)
    src, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    io.write_csv(df, src)
    report = pipelines.stance_file(spark, src, out, schema)
    assert report["rows_backup"] == 2
    got = {r["row_id"]: r["predicted_sentiments"] for r in spark.read.csv(report["path"], header=True, escape='"').collect()}
    assert got == {"1": '["negative"]', "2": "[]"}
    io.write_csv(df.limit(0), src)
    with pytest.raises(Exception):
        pipelines.stance_file(spark, src, out, schema)
