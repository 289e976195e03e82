"""Fitting, scoring and plug-ins whose memory and work do not grow beyond the input."""

import pytest
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from clausework.operators import head as H, scoring, sharded, windows as W

ROWS = [(i, "a:0", 1, [0, 3, 5 + i % 7], [1.0, 2.0, 1.0], [i % 2]) for i in range(40)]
SCHEMA = "win long, key string, part int, features array<int>, counts array<double>, labels array<int>"


def _head(spark, features=12):
    return scoring.hash_head(spark.createDataFrame([(0, "A"), (1, "B")], "label_id int, label string"), n_features=features)


def test_a_worker_takes_few_windows_of_a_batch(monkeypatch):
    monkeypatch.setattr(H, "WINDOWS", 8)
    batch = pa.RecordBatch.from_pydict({"features": [[1, 2]] * 20, "counts": [[1.0, 2.0]] * 20, "labels": [[0]] * 20})
    assert [len(w.truth) for w in H.some_windows(iter([batch.slice(1, 18)]), 2)] == [8, 8, 2]


def test_features_in_any_order_and_repeated():
    batch = pa.RecordBatch.from_pydict({"features": [[3, 1, 3], [], [2]], "counts": [[1.0, 2.0, 4.0], [], [1.0]], "labels": [[1], [], [0]]})
    (w,) = H.some_windows(iter([batch]), 2)
    weights = np.arange(8.0).reshape(4, 2)
    assert np.allclose(w.logits(weights, np.array([1.0, 0.0])), [5 * weights[3] + 2 * weights[1] + [1, 0], [1, 0], weights[2] + [1, 0]])
    g = np.zeros((4, 2))
    w.add_gradient(g, np.ones((3, 2)))
    assert np.allclose(g[:, 0], [0, 2, 1, 5])


def test_a_task_sends_blocks_of_its_gradient(spark, monkeypatch):
    """Rows on their way are blocks of features, not cells."""
    sent = []
    real = sharded.streamed

    def streamed(df, *a):
        sent.append(df.count())
        return real(df, *a)

    monkeypatch.setattr(sharded, "streamed", streamed)
    x = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    w, b = scoring.head_arrays(_head(spark))
    g, gb, n = H.gradient(x, w, b)
    assert sent == [2] and n == 40 and np.allclose(g[0], gb) and np.allclose(g[3], 2 * gb)


def test_a_step_in_shards_stores_weights_alone(spark, monkeypatch):
    names = []
    real = sharded.stored
    monkeypatch.setattr(sharded, "stored", lambda df, name: names.append(name) or real(df, name))
    x, model = spark.createDataFrame(ROWS, SCHEMA), sharded.ShardedModel.of(_head(spark), 6)
    del names[:]
    new = model.step(x, 0.1, 0.01, H.BCE)
    assert names == ["shard-weights"] and new.shards == 4
    w, b = scoring.head_arrays(_head(spark))
    g, gb, n = H.gradient(x, w, b)
    got, got_bias = scoring.head_arrays(new.table())
    assert np.allclose(got, w - 0.1 * (g / n + 0.01 * w)) and np.allclose(got_bias, b - 0.1 * gb / n)


def test_long_scores_make_no_row_per_feature(spark):
    """One join, with the bias: the features of a window are not unfolded to meet the head."""
    wins = spark.createDataFrame([(1, 0, [1, 3, 3, 2]), (1, 0, [1, 3, 2]), (None, 0, [5])], "row_id long, window int, window_ids array<int>")
    long = scoring.score_windows(wins, _head(spark), n_features=12)
    assert long._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    w, b = scoring.head_arrays(_head(spark))
    got = {(r.row_id, r.label_id): r.logit for r in long.collect()}
    want = {1: 2 * w[1] + 3 * w[3] + 2 * w[2] + b, None: w[5] + b}
    assert got == pytest.approx({(k, i): v[i] for k, v in want.items() for i in (0, 1)})


def test_a_tokenizer_is_given_few_texts(spark, monkeypatch):
    def make():
        return lambda texts: [[len(texts)] for _ in texts]

    rows = spark.createDataFrame([(i, None if i == 3 else "x") for i in range(600)], "row_id long, clause string").coalesce(1)
    got = {r.row_id: r.ids for r in W.with_foreign_token_ids(rows, make).select("row_id", "ids").collect()}
    assert got[3] is None and max(v[0] for v in got.values() if v) <= 256 and len(got) == 600


def test_the_overlap_model_finds_a_premises_words_once():
    class Text(str):
        lowered = 0

        def lower(self):
            Text.lowered += 1
            return str.lower(self)

    p = Text("the tone is the tone")
    got = scoring.overlap_pair_model()([p] * 3, ["tone is", "no tone", "the x y z"], None)
    assert got[:, 0].tolist() == [1.0, 0.5, 0.25] and Text.lowered == 1


def test_a_local_folder_is_shipped_where_folders_are_refused(spark, tmp_path, monkeypatch):
    """A cluster's addFile refuses folders of a local file system."""
    folder = tmp_path / "a model"
    (folder / "deep").mkdir(parents=True)
    (folder / "deep" / "x.txt").write_text("7")

    def refuse(self, path, recursive=False):
        raise RuntimeError("local directories are not supported when not running local mode")

    monkeypatch.setattr(type(spark.sparkContext), "addFile", refuse)

    def load(local):
        import os

        with open(os.path.join(local, "deep", "x.txt")) as f:
            return int(f.read())

    for where in (str(folder), folder.as_uri()):
        make = scoring.shipped(spark, where, load)
        assert spark.range(2).select(F.udf(lambda _: make(), "int")("id").alias("x")).distinct().collect() == [(7,)]
