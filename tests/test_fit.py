"""Fitting: exact batches, shards, the loss hook, resuming."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clausework.operators import batches, head as H, labels as L, scoring, sharded
from clausework.plans import pipelines
from clausework.sources import tables

FEATURES = 256


@pytest.fixture(scope="module")
def data(spark, sf_small):
    c = tables.clauses(spark, sf_small).select("row_id", "clause", "actors").where("row_id < 40")
    vocab = L.vocabulary(c, "actors")
    x = H.window_rows(pipelines.training_windows(L.with_label_ids(c, vocab)), FEATURES)
    return x, scoring.hash_head(vocab, n_features=FEATURES)


def weights(head):
    return {(r.label, r.feature): r.weight for r in head.collect()}


def close(a, b):
    assert a.keys() == b.keys()
    assert max(abs(a[k] - b[k]) for k in a) < 1e-12


def test_an_order_numbers_every_window_once(spark, data):
    x, _ = data
    import hashlib

    keys = [r.key for r in x.select("key").collect()]
    seen = []
    for epoch in (1, 2):
        order = batches.Order(x, 7, epoch)
        got = {r.number: r.key for r in order.numbered().select("number", "key").collect()}
        want = sorted(keys, key=lambda k: (int(hashlib.md5(f"7:{epoch}:{k}".encode()).hexdigest()[:15], 16), k))
        assert order.size == len(keys) and [got[i] for i in range(len(keys))] == want
        parts = [[r.key for r in order.between(a, a + 37).select("key").collect()] for a in range(0, len(keys) + 37, 37)]
        assert [sorted(p) for p in parts] == [sorted(want[a:a + 37]) for a in range(0, len(keys) + 37, 37)]
        seen.append(want)
    assert seen[0] != seen[1]


def test_batch_size_steps_equal_a_loop(spark, data):
    """Plain gradient steps over the batches in numpy give the same weights."""
    x, init = data
    rows = {r.key: r for r in x.collect()}
    w, b = scoring.head_arrays(init)
    n = len(rows)
    size = n // 3 + 1
    total, step = 2 * -(-n // size), 0
    for epoch in (1, 2):
        order = [r.key for r in batches.Order(x, 3, epoch).numbered().orderBy("number").select("key").collect()]
        for a in range(0, n, size):
            g, gb = np.zeros_like(w), np.zeros_like(b)
            some = order[a:a + size]
            for k in some:
                r = rows[k]
                f, c = np.array(r.features), np.array(r.counts)
                y = np.zeros(len(b))
                y[r.labels] = 1
                s = 1 / (1 + np.exp(-(c @ w[f] + b))) - y
                np.add.at(g, f, c[:, None] * s)
                gb += s
            rate = H._rate(step, total, 0.05, 0.1)
            w, b, step = w - rate * (g / len(some) + 0.01 * w), b - rate * gb / len(some), step + 1
    got = weights(H.fit(x, init, epochs=2, batch_size=size, seed=3, keep=2)[2][2])
    label = {r.label_id: r.label for r in init.select("label_id", "label").distinct().collect()}
    assert max(abs(got[label[j], i] - w[i, j]) for i in range(len(w)) for j in range(len(b))) < 1e-12


@pytest.mark.parametrize("block_cells", [300, 5000])
def test_shards_equal_the_broadcast_fit(spark, data, monkeypatch, block_cells):
    x, init = data
    options = dict(evaluation=x, epochs=1, steps_per_epoch=2, loss=H.weighted_bce(2.0))
    head, epochs, heads = H.fit(x, init, **options)
    monkeypatch.setattr(scoring, "MAX_CELLS", 10)
    got_head, got_epochs, got_heads = H.fit(x, init, block_cells=block_cells, **options)
    close(weights(got_head), weights(head))
    for a, b in zip(got_epochs.orderBy("epoch").collect(), epochs.orderBy("epoch").collect(), strict=True):
        assert a.asDict().keys() == b.asDict().keys() and all(abs(float(u) - float(v)) < 1e-9 for u, v in zip(a, b, strict=True))
    assert got_heads.keys() == heads.keys()


def test_windows_without_a_label_or_a_feature(spark, monkeypatch):
    rows = [(0, "a:0", 1, [0, 1], [1.0, 2.0], [0]), (1, "b:0", 2, [], [], [1]), (2, "c:0", 3, [2], [1.0], [])]
    x = spark.createDataFrame(rows, "win long, key string, part int, features array<int>, counts array<double>, labels array<int>")
    vocab = spark.createDataFrame([(0, "A"), (1, "B")], "label_id int, label string")
    init = scoring.hash_head(vocab, n_features=3)
    want, _, _ = H.fit(x, init, epochs=1, steps_per_epoch=2)
    monkeypatch.setattr(scoring, "MAX_CELLS", 1)
    got, _, _ = H.fit(x, init, epochs=1, steps_per_epoch=2, block_cells=2)
    close(weights(got), weights(want))


def test_losses_are_checked():
    H.check_loss(H.BCE)
    H.check_loss(H.weighted_bce(3.5))
    H.check_loss(H.Loss(lambda z, y: (z - y) ** 2, lambda z, y: 2 * (z - y)))
    with pytest.raises(ValueError, match="derivative"):
        H.check_loss(H.Loss(H.BCE.value, lambda z, y: y - z))


def test_weight_one_is_plain_cross_entropy():
    z, y = np.linspace(-30, 30, 61), np.arange(61) % 2.0
    assert np.allclose(H.BCE.value(z, y), np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z))))
    assert np.allclose(H.BCE.slope(z, y), 1 / (1 + np.exp(-z)) - y)


def test_a_broken_fit_goes_on(spark, data, tmp_path):
    x, init = data
    size = x.count() // 2 + 1
    options = dict(evaluation=x, epochs=3, batch_size=size, keep=2)
    _, want_epochs, want = H.fit(x, init, **options)
    state, calls = str(tmp_path / "state"), []

    class Broken(Exception):
        pass

    def failing(real):
        def step(self, *a):
            calls.append(1)
            if len(calls) > 5:
                raise Broken
            return real(self, *a)
        return step

    real = H.BroadcastModel.step
    H.BroadcastModel.step = failing(real)
    try:
        with pytest.raises(Broken):
            H.fit(x, init, state=state, **options)
    finally:
        H.BroadcastModel.step = real
    per_epoch, finished = 2, 2
    count = []
    H.BroadcastModel.step = lambda self, *a: count.append(1) or real(self, *a)
    try:
        _, got_epochs, got = H.fit(x, init, state=state, **options)
    finally:
        H.BroadcastModel.step = real
    assert len(count) == (3 - finished) * per_epoch  # no finished epoch is fitted again
    assert [tuple(r) for r in got_epochs.orderBy("step").collect()] == [tuple(r) for r in want_epochs.orderBy("step").collect()]
    assert got.keys() == want.keys()
    for e in want:
        close(weights(got[e]), weights(want[e]))


def test_a_model_in_shards_keeps_its_head(spark, data):
    _, init = data
    close(weights(sharded.ShardedModel.of(init, 64).table()), weights(init))
    assert sharded.ShardedModel.of(init, 64).table().where(F.col("label").isNull()).count() == 0
