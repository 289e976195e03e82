"""Fit a multi-label linear head.

Per-label logistic units over shared window features (token-id buckets plus
a bias), a loss given by its value and its slope by the logit (binary
cross-entropy by default), decoupled weight decay (not on the bias), linear
warm-up then linear decay of the step size, optional warm start (the initial
head is any head table, e.g. from ``labels.warm_copy``).

The training table has one row per window: its features, their counts and its
label ids, written once to the shared folder. A step broadcasts the weights
(size-checked: labels x features), every task adds up the gradient of its
windows, the partial gradients are summed by blocks of features, and the sum,
no larger than the head, updates the weights. Nothing data-sized leaves the
executors. Evaluation sums confusion counts and loss per task. A head too
large for that is fitted in shards (``sharded``), by the same loop.

A step takes all windows, a fixed share of them, or exactly ``batch_size`` ones
of the epoch's own seeded order (``batches``). With a ``state`` folder every
finished epoch is kept there and a broken fit goes on behind it.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import BIAS_FEATURE, CLS_ID, MAX_LENGTH, N_FEATURES, SEP_ID, THRESHOLD, TRAIN_STEP
from . import metrics as M
from ._util import built, identity_of, stored
from .batches import SEED, Order
from .scoring import HEAD_SCHEMA, head_arrays
from .windows import encoded, make_word_ids

# The training settings being matched.
EPOCHS = 5
WEIGHT_DECAY = 0.01
WARMUP_RATIO = 0.1
KEEP_EPOCHS = 2

EPOCH_SCHEMA = "epoch int, step int, loss double, accuracy double, f1 double, precision double, recall double"
# cells (windows x labels) and windows that a worker takes at once
CELLS = 1 << 20
WINDOWS = 512
# numbers of a block of the gradient on its way: 1 MB
BLOCK_CELLS = 1 << 17


class Loss(NamedTuple):
    """A loss per (window, label) cell, ``value(z, y)``, and its slope by the logit, ``slope(z, y)``; both take arrays."""

    value: Callable[[np.ndarray, np.ndarray], np.ndarray]
    slope: Callable[[np.ndarray, np.ndarray], np.ndarray]


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0.0) + np.log1p(np.exp(-np.abs(z)))


def weighted_bce(positive: float = 1.0) -> Loss:
    """Binary cross-entropy in which a true label counts ``positive`` times."""
    def value(z: np.ndarray, y: np.ndarray) -> np.ndarray:
        return positive * y * (_softplus(z) - z) + (1.0 - y) * _softplus(z)

    def slope(z: np.ndarray, y: np.ndarray) -> np.ndarray:
        p = 1.0 / (1.0 + np.exp(-z))
        return p * (positive * y + 1.0 - y) - positive * y

    return Loss(value, slope)


BCE = weighted_bce()


def check_loss(loss: Loss, points: np.ndarray | None = None, tolerance: float = 1e-4) -> None:
    """Refuse a loss whose slope is not that of its value (central differences, both truths)."""
    z = np.linspace(-6.0, 6.0, 49) + 0.013 if points is None else np.asarray(points, dtype=float)
    h = 1e-5
    for truth in (0.0, 1.0):
        y = np.full_like(z, truth)
        told = loss.slope(z, y)
        seen = (loss.value(z + h, y) - loss.value(z - h, y)) / (2 * h)
        if np.shape(told) != z.shape or not np.allclose(told, seen, atol=tolerance, rtol=tolerance):
            raise ValueError("the slope of this loss is not the derivative of its value")


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column one after another and where each list begins and ends; nothing is copied."""
    return column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()


def list_column(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values))


def different(ids: np.ndarray, lengths: np.ndarray, n_features: int) -> tuple[pa.Array, pa.Array]:
    """The different features (id mod ``n_features``) of some windows, ascending, and how often each stands in its window."""
    own = ids % n_features
    most = int(own.max(initial=0)) + 1
    # one sorted run of (window, feature)
    found, n = np.unique(np.repeat(np.arange(len(lengths)), lengths) * most + own, return_counts=True)
    many = np.bincount(found // most, minlength=len(lengths))
    return list_column((found % most).astype(np.int32), many), list_column(n.astype(np.float64), many)


def counted(windows: DataFrame, n_features: int) -> DataFrame:
    """``windows`` whose ``features``, token ids, become their different features (id mod ``n_features``), ascending, and, in ``counts``, how often each stands there.

    Arrow's batches are taken ``WINDOWS`` windows at a time, so that a worker holds little beside its batch.
    """
    found_as = {"features": T.StructField("features", T.ArrayType(T.IntegerType()))}
    schema = T.StructType([*(found_as.get(f.name, f) for f in windows.schema.fields), T.StructField("counts", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, WINDOWS):
                b = batch.slice(at, WINDOWS)
                values, ends = lists(b.column("features"))
                once, n = different(values[ends[0]:ends[-1]].astype(np.int64), np.diff(ends), n_features)
                yield pa.RecordBatch.from_arrays([*[once if c == "features" else b.column(c) for c in b.schema.names], n], names=[*b.schema.names, "counts"])

    return windows.mapInArrow(run, schema)


def _window_rows(counts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return stored(counts.select(F.monotonically_increasing_id().alias("win"), F.concat_ws(":", *[F.col(k).cast("string") for k in keys]).alias("key"),
                                F.pmod(F.xxhash64(*keys), F.lit(1 << 20)).cast("int").alias("part"), "features", "counts", "labels"), "windows")


def window_rows(windows: DataFrame, n_features: int = N_FEATURES, window_ids: str = "window_ids",
                label_ids: str = "label_ids", keys: tuple[str, ...] = ("row_id", "window")) -> DataFrame:
    """X, one row per window: ``(win, key, part, features, counts, labels)``, written and read back.

    ``win`` is a row number, ``key`` the window's key as text, ``part`` a hash
    of it in [0, 2^20), by which fixed shares are cut.
    """
    rows = windows.select(*keys, F.col(window_ids).alias("features"), F.col(label_ids).alias("labels"))
    return _window_rows(counted(rows, n_features), keys)


def text_rows(rows: DataFrame, n_features: int = N_FEATURES, *, key: str = "row_id", text: str = "clause", label_ids: str = "label_ids",
              max_length: int = MAX_LENGTH, step: int = TRAIN_STEP, cls_id: int = CLS_ID, sep_id: int = SEP_ID) -> DataFrame:
    """``window_rows`` of the fixed windows of texts (T1 + T2 + T4) by the default tokenizer.

    Words, ids, windows and counts are found in one worker; no token leaves it.
    """
    if step < 1 or max_length < 1:
        raise ValueError("step and max_length must be positive")
    src = rows.select(F.col(key).alias("row_id"), F.col(label_ids).alias("labels"), F.lower(text).alias("text"))
    schema = T.StructType([src.schema["row_id"], T.StructField("window", T.IntegerType()), src.schema["labels"],
                           T.StructField("features", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.DoubleType()))])
    identity = identity_of(make_word_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = built("word-ids", identity, make_word_ids)
        for batch in batches:
            held: list[tuple[int, int, np.ndarray]] = []
            for i, own in enumerate(encoded(batch.column("text"), encode)):
                full = np.concatenate([[cls_id], () if own is None else own, [sep_id]]).astype(np.int64)
                held += [(i, w, full[s:s + max_length]) for w, s in enumerate(range(0, len(full), step))]
                while len(held) >= WINDOWS:
                    yield packed(batch, held[:WINDOWS])
                    held = held[WINDOWS:]
            if held:
                yield packed(batch, held)

    def packed(batch: pa.RecordBatch, some: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        at = pa.array([i for i, _, _ in some], pa.int64())
        once, n = different(np.concatenate([x for _, _, x in some]), np.array([len(x) for _, _, x in some]), n_features)
        return pa.RecordBatch.from_arrays([batch.column("row_id").take(at), pa.array([w for _, w, _ in some], pa.int32()), batch.column("labels").take(at), once, n],
                                          names=["row_id", "window", "labels", "features", "counts"])

    return _window_rows(src.mapInArrow(run, schema), ("row_id", "window"))


class Windows(NamedTuple):
    """Some windows: their features and counts one after another, where each window begins and ends, and the truth."""

    features: np.ndarray
    counts: np.ndarray
    ends: np.ndarray
    truth: np.ndarray

    def logits(self, w: np.ndarray, b: np.ndarray) -> np.ndarray:
        z = np.empty(self.truth.shape)
        for i, (first, end) in enumerate(zip(self.ends[:-1].tolist(), self.ends[1:].tolist(), strict=True)):
            z[i] = self.counts[first:end] @ w.take(self.features[first:end], axis=0)
        return z + b

    def add_gradient(self, g: np.ndarray, slopes: np.ndarray) -> None:
        """Add every window's counts times its slopes to ``g``; no feature stands twice in a window."""
        most = int(np.diff(self.ends).max(initial=0))
        own, terms = np.empty((2, most, g.shape[1]))
        for i, (first, end) in enumerate(zip(self.ends[:-1].tolist(), self.ends[1:].tolist(), strict=True)):
            f, n = self.features[first:end], end - first
            # "clip" writes into its buffer at once; writing back refuses a feature that ``g`` does not have
            new = g.take(f, axis=0, out=own[:n], mode="clip")
            # one product of a column and a row: faster than multiplying cell by cell, the same numbers
            new += np.dot(self.counts[first:end, None], slopes[i:i + 1], out=terms[:n])
            g[f] = new


def add_by_feature(g: np.ndarray, features: np.ndarray, terms: np.ndarray) -> None:
    """Add ``terms`` to the rows of ``g`` that ``features`` names; a feature may come often."""
    if len(features):
        order = np.argsort(features, kind="stable")
        own = features[order]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        g[own[first]] += np.add.reduceat(terms[order], first, axis=0)


def truth_of(values: np.ndarray, lengths: np.ndarray, n_labels: int) -> np.ndarray:
    """0/1 of windows and labels, from the windows' label ids one after another."""
    y = np.zeros((len(lengths), n_labels))
    y[np.repeat(np.arange(len(lengths)), lengths), values] = 1.0
    return y


def once_each(features: np.ndarray, counts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same windows with every feature once in a window and ascending, as ``window_rows`` writes them."""
    lengths = np.diff(ends)
    later = np.diff(features) > 0
    begins = ends[1:-1]
    later[begins[(begins > 0) & (begins < len(features))] - 1] = True
    if later.all():
        return features, counts, ends
    most = int(features.max()) + 1
    found, at = np.unique(np.repeat(np.arange(len(lengths)), lengths) * most + features, return_inverse=True)
    different = np.bincount(found // most, minlength=len(lengths))
    return found % most, np.bincount(at, weights=counts), np.concatenate([[0], np.cumsum(different)])


def some_windows(batches: Iterator[pa.RecordBatch], n_labels: int) -> Iterator[Windows]:
    """The windows of Arrow batches, few at a time: at most ``WINDOWS``, and ``CELLS`` cells of windows and labels."""
    step = max(1, min(WINDOWS, CELLS // max(1, n_labels)))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            b = batch.slice(at, step)
            (features, ends), (counts, at_counts), (labels, own) = (lists(b.column(c)) for c in ("features", "counts", "labels"))
            yield Windows(*once_each(features[ends[0]:ends[-1]].astype(np.int64), counts[at_counts[0]:at_counts[-1]], ends - ends[0]),
                          truth_of(labels[own[0]:own[-1]], np.diff(own), n_labels))


def gradient(x: DataFrame, weights: np.ndarray, bias: np.ndarray, loss: Loss = BCE) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums over the windows of ``x`` of the loss's gradient by weight and bias, and the number of windows.

    A task sends its sums as blocks of the features that occur in it; blocks are
    added up as they stream by, and only the sum comes to the driver.
    """
    from .sharded import streamed

    if not len(bias):
        return np.zeros_like(weights), np.zeros_like(bias), x.count()
    shared = x.sparkSession.sparkContext.broadcast((weights, bias))
    labels, features = len(bias), len(weights)
    width = max(1, BLOCK_CELLS // max(1, labels))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = shared.value
        g, gb, n = np.zeros_like(w), np.zeros_like(b), 0
        for c in some_windows(batches, len(b)):
            r = loss.slope(c.logits(w, b), c.truth)
            c.add_gradient(g, r)
            gb += r.sum(axis=0)
            n += len(r)
        if n:
            yield block(BIAS_FEATURE, np.array([n]), gb)
            for s in range(-(-len(w) // width)):
                own = g[s * width:(s + 1) * width]
                used = np.flatnonzero(own.any(axis=1))
                if len(used):
                    yield block(s, used, own[used])

    def block(s: int, used: np.ndarray, g: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"s": [s], "features": [used.astype(np.int64).tobytes()], "g": [g.tobytes()]},
                                          schema=pa.schema([("s", pa.int32()), ("features", pa.binary()), ("g", pa.binary())]))

    def added(s: int, rows: Iterator[dict]) -> Iterator[dict]:
        total, n = np.zeros((1 if s == BIAS_FEATURE else min(width, features - s * width), labels)), 0
        for r in rows:
            at = np.frombuffer(r["features"], dtype=np.int64)
            if s == BIAS_FEATURE:
                n, at = n + int(at[0]), np.zeros(1, dtype=np.int64)
            total[at] += np.frombuffer(r["g"]).reshape(len(at), labels)
        yield {"s": s, "n": n, "g": total.tobytes()}

    sums = streamed(x.select("features", "counts", "labels").mapInArrow(partial, "s int, features binary, g binary"), "s", added, "s int, n long, g binary").collect()
    shared.unpersist()
    g, gb, n = np.zeros_like(weights), np.zeros_like(bias), 0
    for r in sums:
        own = np.frombuffer(r["g"]).reshape(-1, labels)
        if r["s"] == BIAS_FEATURE:
            gb, n = own[0].copy(), r["n"]
        else:
            g[r["s"] * width:r["s"] * width + len(own)] = own
    return g, gb, n


def cell_sums(z: np.ndarray, y: np.ndarray, loss: Loss, threshold: float) -> tuple[int, int, int, int, float]:
    """``(tp, fp, fn, tn, loss)`` over cells."""
    hit, true = 1.0 / (1.0 + np.exp(-z)) >= threshold, y == 1
    return (int((hit & true).sum()), int((hit & ~true).sum()), int((~hit & true).sum()), int((~hit & ~true).sum()), float(loss.value(z, y).sum()))


SUMS = "tp long, fp long, fn long, tn long, loss double"


def measures(sums: DataFrame) -> tuple[float, ...]:
    """``(loss, accuracy, f1, precision, recall)`` from rows of ``SUMS``."""
    row = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn", "tn", "loss")]).first()
    m = M.macro_metrics(sums.sparkSession.createDataFrame([(row["tp"], row["fp"], row["fn"], row["tn"])], "tp long, fp long, fn long, tn long")).first()
    cells = row["tp"] + row["fp"] + row["fn"] + row["tn"]
    return (row["loss"] / cells if cells else 0.0, m["accuracy"], m["f1"], m["precision"], m["recall"])


def evaluate(x: DataFrame, weights: np.ndarray, bias: np.ndarray, threshold: float = THRESHOLD, loss: Loss = BCE) -> tuple[float, ...]:
    """``(loss, accuracy, f1, precision, recall)`` over all (window, label) cells of ``x``."""
    shared = x.sparkSession.sparkContext.broadcast((weights, bias))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = shared.value
        total = np.zeros(4, dtype=np.int64), 0.0
        for c in some_windows(batches, len(b)):
            *counts, value = cell_sums(c.logits(w, b), c.truth, loss, threshold)
            total = total[0] + counts, total[1] + value
        yield pa.RecordBatch.from_pydict(dict(zip(("tp", "fp", "fn", "tn", "loss"), ([v] for v in (*total[0].tolist(), total[1])), strict=True)))

    got = measures(x.select("features", "counts", "labels").mapInArrow(partial, SUMS))
    shared.unpersist()
    return got


class BroadcastModel:
    """Weights in the driver, broadcast at every step."""

    def __init__(self, spark, head: DataFrame, weights: np.ndarray, bias: np.ndarray):
        self.spark, self.weights, self.bias = spark, weights, bias
        self.names = {r["label_id"]: r["label"] for r in head.select("label_id", "label").distinct().collect()}

    def step(self, x: DataFrame, rate: float, decay: float, loss: Loss) -> BroadcastModel:
        g, gb, n = gradient(x, self.weights, self.bias, loss)
        new = object.__new__(BroadcastModel)
        new.spark, new.names = self.spark, self.names
        new.weights = self.weights - rate * (g / max(1, n) + decay * self.weights)
        new.bias = self.bias - rate * gb / max(1, n)
        return new

    def evaluate(self, x: DataFrame, threshold: float, loss: Loss) -> tuple[float, ...]:
        return evaluate(x, self.weights, self.bias, threshold, loss)

    def table(self) -> DataFrame:
        return head_table(self.spark, self.names, self.weights, self.bias)


def model_of(head: DataFrame, block_cells: int | None = None, max_cells: int | None = None):
    """The model that a head's size asks for."""
    from .sharded import BLOCK_CELLS, ShardedModel

    arrays = head_arrays(head, most=max_cells)
    if arrays is None:
        return ShardedModel.of(head, BLOCK_CELLS if block_cells is None else block_cells)
    return BroadcastModel(head.sparkSession, head, *arrays)


def _rate(step: int, total: int, lr: float, warmup_ratio: float) -> float:
    warm = math.ceil(total * warmup_ratio)
    if warm and step < warm:
        return lr * (step + 1) / warm
    return lr * max(0.0, (total - step) / max(1, total - warm))


def head_table(spark, names: dict[int, str], weights: np.ndarray, bias: np.ndarray) -> DataFrame:
    """Weights as a head table."""
    features, labels = weights.shape
    wide = np.concatenate([bias[None], weights]).T
    return spark.createDataFrame(pd.DataFrame({
        "label_id": np.repeat(np.arange(labels, dtype=np.int32), features + 1),
        "label": np.repeat(np.array([names[i] for i in range(labels)], dtype=object), features + 1),
        "feature": np.tile(np.arange(-1, features, dtype=np.int32), labels),
        "weight": wide.reshape(-1)}), HEAD_SCHEMA)


def _saved(spark, state: str, epoch: int) -> dict | None:
    """What a finished epoch left, or None: the marker is written last and counts only if it is whole."""
    try:
        row = spark.read.text(f"{state.rstrip('/')}/epoch-{epoch}/done").first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if row is None else json.loads(row[0])


def _save(state: str, epoch: int, table: DataFrame, step: int, rows: list) -> None:
    path = f"{state.rstrip('/')}/epoch-{epoch}"
    table.write.mode("overwrite").parquet(f"{path}/head")
    spark = table.sparkSession
    marker = json.dumps({"step": step, "rows": rows})
    spark.createDataFrame([(marker,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/done")


def fit(train: DataFrame, init_head: DataFrame, *, evaluation: DataFrame | None = None, epochs: int = EPOCHS,
        steps_per_epoch: int = 2, batches: int | None = None, accumulate: int = 1, lr: float = 0.05,
        weight_decay: float = WEIGHT_DECAY, warmup_ratio: float = WARMUP_RATIO, threshold: float = THRESHOLD,
        eval_every: int | None = None, keep: int = KEEP_EPOCHS, batch_size: int | None = None, seed: int = SEED,
        loss: Loss = BCE, state: str | None = None, until: int | None = None, max_cells: int | None = None,
        block_cells: int | None = None) -> tuple[DataFrame, DataFrame, dict[int, DataFrame]]:
    """Returns ``(best head, epoch table, heads of the best epochs by epoch)``.

    ``train`` and ``evaluation`` are ``window_rows``. By default each of an
    epoch's ``steps_per_epoch`` steps uses all windows; with ``batches`` an
    epoch goes through that many disjoint parts; with ``batch_size`` through
    batches of exactly that many windows (the last one what is left) of the
    epoch's own order under ``seed``. Either way it updates after every
    ``accumulate`` of them. The model is evaluated after each epoch, with
    ``eval_every`` also after every so many steps (rows of the table with the
    same ``epoch``). The best epoch has the highest f1, the first one on ties
    (P8); heads of the best ``keep`` epochs are returned. ``loss`` is checked
    against finite differences. ``state`` is a folder for finished epochs: a
    fit called again with the same arguments goes on after the last one there;
    ``until`` ends a call after that epoch. A head of more than ``max_cells``
    weights (``MAX_CELLS``) is not broadcast but fitted in shards of
    ``block_cells``.
    """
    if batches is not None and batch_size is not None:
        raise ValueError("give the number of batches or their size")
    check_loss(loss)
    spark = train.sparkSession
    model = model_of(init_head, block_cells, max_cells)
    per_epoch, rows, heads, step, done = steps_per_epoch, [], {}, 0, 0
    if batches is not None:
        per_epoch = -(-batches // accumulate)
    elif batch_size is not None:
        per_epoch = max(1, -(-(-(-train.count() // batch_size)) // accumulate))

    def record(epoch: int) -> float:
        got = model.evaluate(evaluation, threshold, loss) if evaluation is not None else (None,) * 5
        rows.append((epoch, step, *got))
        return -1.0 if got[2] is None else got[2]

    def remember(epoch: int, f1: float, table: Callable[[], DataFrame]) -> None:
        heads[epoch] = (f1, table)
        for worst in sorted(heads, key=lambda e: (-heads[e][0], e))[keep:]:
            del heads[worst]

    for epoch in range(1, epochs + 1) if state else ():
        saved = _saved(spark, state, epoch)
        if saved is None:
            break
        done, step, rows = epoch, saved["step"], [tuple(r) for r in saved["rows"]]
        table = spark.read.schema(HEAD_SCHEMA).parquet(f"{state.rstrip('/')}/epoch-{epoch}/head")
        remember(epoch, -1.0 if rows[-1][4] is None else rows[-1][4], lambda t=table: t)
    if done:
        model = model_of(table, block_cells, max_cells)
    for epoch in range(done + 1, (epochs if until is None else min(until, epochs)) + 1):
        order = Order(train, seed, epoch) if batch_size is not None else None
        for part in range(per_epoch):
            x, lo, hi = train, part * accumulate, (part + 1) * accumulate
            if order is not None:
                x = order.between(lo * batch_size, hi * batch_size)
            elif batches is not None:
                x = train.where((F.col("part") * batches >= (lo << 20)) & (F.col("part") * batches < (min(batches, hi) << 20)))
            model = model.step(x, _rate(step, epochs * per_epoch, lr, warmup_ratio), weight_decay, loss)
            step += 1
            if eval_every and step % eval_every == 0 and part + 1 < per_epoch:
                record(epoch)
        remember(epoch, record(epoch), model.table)
        if state:
            _save(state, epoch, model.table(), step, rows)
    best = min(heads, key=lambda e: (-heads[e][0], e))
    table = spark.createDataFrame(rows, EPOCH_SCHEMA).withColumn(
        "best", (F.col("epoch") == best) & (F.col("step") == best * per_epoch))
    kept = {e: make() for e, (_, make) in heads.items()}
    return kept[best], table, kept


def best_epoch(epochs_table: DataFrame, metric: str = "f1", keep: int = KEEP_EPOCHS) -> DataFrame:
    """Rank epochs by ``metric`` (first epoch wins ties); keep the top ``keep``."""
    from pyspark.sql import Window

    # one row per epoch: a bounded table, so a single ordered window is fine
    w = Window.orderBy(F.col(metric).desc(), F.col("epoch").asc())
    return epochs_table.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)
