"""Types inferred from texts, verified copies, published versions, models by path, metric hooks."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clausework.operators import hooks, labels as L, metrics as M, scoring, stance as Z
from clausework.plans import pipelines
from clausework.session import scratch_path
from clausework.sources import inference, io, tables

KINDS = {"i": "bigint", "f": "double", "b": "boolean", "O": "string"}
COLUMNS = {
    "whole": ["1", "-2", "+3", " 4 "], "whole_missing": ["1", "", "NA", "4"], "number": ["1", "2.5", "-.5", "1e-3"], "endless": ["1", "inf", "-Infinity", ""],
    "truth": ["True", "FALSE", "true", "false"], "truth_missing": ["True", "", "False", "True"], "mixed": ["True", "1", "0", "1"],
    "missing": ["", "NA", "null", "NaN"], "text": ["a", "1", "2", "3"], "beyond": ["92233720368547758080", "x", "1", "2"], "zeros": ["007", "1", "2", "3"],
    "point": ["1.", "2", "3", "4"], "words": ["nan", "none", "None", "n/a"], "breaks": ['a\nb', 'say "x"', ",", "é"],
}


def test_types_are_those_of_pandas(spark, tmp_path):
    frame = pd.DataFrame(COLUMNS)
    frame.to_csv(tmp_path / "t.csv", index=False)
    want = pd.read_csv(tmp_path / "t.csv")
    got = io.read_csv(spark, str(tmp_path / "t.csv"))
    assert dict(got.dtypes) == {c: KINDS[want[c].dtype.kind] for c in want.columns}
    rows = got.collect()
    for c in want.columns:
        for r, v in zip(rows, want[c], strict=True):
            if pd.isna(v):
                assert r[c] is None
            else:
                assert r[c] == v or str(r[c]) == str(v), c


def test_types_merge_over_files(spark, tmp_path):
    for i, (a, b) in enumerate([("1", "1"), ("2", "x"), ("2.5", "True")]):
        pd.DataFrame({"a": [a], "b": [b]}).to_csv(tmp_path / f"{i}.csv", index=False)
    assert dict(io.read_csv(spark, str(tmp_path)).dtypes) == {"a": "double", "b": "string"}


def test_types_of_a_table_without_rows(spark):
    assert inference.column_types(spark.createDataFrame([], "a string, b string")) == {"a": "string", "b": "string"}


def test_copies_are_compared_by_value(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a", ["x"]), (2, None, []), (2, None, [])], "row_id long, clause string, tags array<string>")
    path = scratch_path(spark, "copies")
    for fmt in ("csv", "parquet"):
        report = io.save_with_backup(df, f"{path}-{fmt}", fmt)
        assert report["rows_written"] == report["rows_read"] == report["rows_backup"] == 3
        again = io.save_with_backup(df.repartition(2), f"{path}-{fmt}", fmt)
        assert again["checksum"] == report["checksum"]
    real = io._write_summed

    def other(d, target, fmt):  # a copy of as many rows with another value
        return real(d if "_backup_" in target else d.withColumn("clause", F.lit("changed")), target, fmt)

    monkeypatch.setattr(io, "_write_summed", other)
    with pytest.raises(RuntimeError, match="differ"):
        io.save_with_backup(df, f"{path}-other")


def test_a_failing_run_leaves_the_former_result(spark):
    path = scratch_path(spark, "kept")
    good = spark.createDataFrame([(1, "a")], "row_id long, clause string")
    bad = good.withColumn("clause", F.raise_error(F.lit("no")))
    io.save_with_backup(good, path, "parquet")
    with pytest.raises(Exception, match="no"):
        io.save_with_backup(bad, path, "parquet")
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, "a")]
    io.publish(good, path + "-v")
    with pytest.raises(Exception, match="no"):
        io.publish(bad, path + "-v")
    assert [tuple(r) for r in io.read_published(spark, path + "-v").collect()] == [(1, "a")]
    manifest = io.publish(good.limit(0), path + "-v")
    assert manifest["rows"] == 0 and io.read_published(spark, path + "-v").count() == 0


def test_nulls_and_empty_texts_have_different_checksums(spark):
    a, b = (spark.createDataFrame([(1, v)], "row_id long, clause string") for v in ("", None))
    path = scratch_path(spark, "nulls")
    assert io.publish(a, path + "a")["checksum"] != io.publish(b, path + "b")["checksum"]


def test_a_model_by_path(spark, sf_small):
    docs, vocab = tables.documents(spark, sf_small).limit(30), L.vocabulary(tables.clauses(spark, sf_small), "actors")
    head = scoring.hash_head(vocab, n_features=128)
    folder = scratch_path(spark, "model")
    io.write_table(head, folder)
    model = scoring.shipped(spark, folder, scoring.load_head)
    key = lambda d: sorted((r.row_id, tuple(r.predicted_actors)) for r in d.collect())
    assert key(pipelines.tag(docs, None, vocab, make_predict_fn=model)) == key(pipelines.tag(docs, head, vocab))


def test_a_pair_model_by_path(spark):
    folder = scratch_path(spark, "pair-model")
    spark.createDataFrame([("0.25",)], "value string").coalesce(1).write.text(folder)

    def load(local):
        names = [n for n in os.listdir(local) if n.startswith("part-")]
        with open(os.path.join(local, names[0])) as f:
            score = float(f.read())
        return lambda premises, hypotheses, max_length: np.full((len(premises), 3), score)

    df = spark.createDataFrame([(1, "text", "['A']")], "row_id long, clause string, predicted_actors string")
    got = Z.stance(df, pair_model=scoring.shipped(spark, folder, load)).first()
    assert tuple(got.sentiment_scores[0]) == (0.25, 0.25, 0.25)


def test_hooks_merge_in_a_tree(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=(int(rng.integers(0, 4)), 3)).tolist(), [int(x) for x in np.flatnonzero(rng.random(3) < 0.5)]) for i in range(90)] + [(90, None, [1])]
    df = spark.createDataFrame(rows, "row_id long, logits array<array<double>>, label_ids array<int>").repartition(23)
    want = M.macro_metrics(M.confusion(M.cells(df))).first()
    for fan in (2, 3, 64):
        got = hooks.measured(df, hooks.macro(3), 3, fan=fan).first()
        assert all(abs(got[c] - want[c]) < 1e-12 for c in ("accuracy", "f1", "precision", "recall"))
    per = {r.label_id: r for r in hooks.measured(df, hooks.label_f1(3), 3).collect()}
    cells = M.cells(df).collect()
    for i in range(3):
        own = [(r.logit >= 0, r.y == 1) for r in cells if r.label_id == i]
        tp, fp, fn = (sum(1 for c in own if c == k) for k in ((True, True), (True, False), (False, True)))
        assert abs(per[i].f1 - 2 * tp / (2 * tp + fp + fn)) < 1e-12
    assert tuple(hooks.measured(df.limit(0), hooks.macro(3), 3).first()) == (0.0, 0.0, 0.0, 0.0)
