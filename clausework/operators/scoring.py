"""Window scorers.

A head is a long table ``(label_id INT, label STRING, feature INT, weight
DOUBLE)``, dense over features 0..n-1 plus the bias at feature -1. A window's
logit for a label is ``bias + sum over its tokens of weight[label, token_id
mod n]``.

``window_logits`` scores a clause's windows beside its row: one Arrow UDF takes
the clause's token ids and gives the logits of all its windows, so nothing is
shuffled, joined or fanned out by label. Any batch model plugs in through
``make_predict_fn``; the default is the linear head, whose weights are
broadcast behind a check of their size. A head beyond that size is scored by
``score_windows``: blocks of windows meet the head's shards.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import (BIAS_FEATURE, CLS_ID, MAX_LENGTH, N_FEATURES, PAD_ID, PREDICT_OVERLAP, SEP_ID, THRESHOLD, TRAIN_STEP,
                              md5_bits)
from ._util import bounded_broadcast, built, identity_of, stored
from .windows import encoded

HEAD_SCHEMA = T.StructType([
    T.StructField("label_id", T.IntegerType(), False),
    T.StructField("label", T.StringType(), False),
    T.StructField("feature", T.IntegerType(), False),
    T.StructField("weight", T.DoubleType(), False),
])
# weights (labels x features) that are collected and broadcast at most: 64 MB of doubles
MAX_CELLS = 1 << 23
BATCH_SIZE = 16
# hypotheses whose words a worker of the overlap model keeps, and the longest that it keeps
HYPOTHESES = 4096
HYPOTHESIS_CHARS = 1000


def hash_head(vocab: DataFrame, salt: str = "init", scale: float = 0.1, n_features: int = N_FEATURES) -> DataFrame:
    """A deterministic dense head: weight = (md5(salt:label:feature)/2^32 - 0.5) * scale.

    Used as the fresh initialisation of a head and as the fixed head of the
    driver's tagging queries (its labels come from the data's vocabulary).
    """
    rows = vocab.select("label_id", "label",
                        F.explode(F.sequence(F.lit(BIAS_FEATURE), F.lit(n_features - 1))).alias("feature"))
    key = F.concat_ws(":", F.lit(salt), F.col("label"), F.col("feature").cast("string"))
    return rows.select(F.col("label_id").cast("int"), "label", F.col("feature").cast("int"),
                       ((md5_bits(key) / F.lit(4294967296.0) - F.lit(0.5)) * F.lit(scale)).alias("weight"))


def head_arrays(head: DataFrame, rows: int | None = None, most: int | None = None) -> tuple[np.ndarray, np.ndarray] | None:
    """``(weights[features, labels], bias[labels])`` of a head of at most ``most`` rows (``MAX_CELLS``), else None."""
    n = head.count() if rows is None else rows
    if n > (MAX_CELLS if most is None else most):
        return None
    t = head.select("label_id", "feature", "weight").toPandas()
    if not len(t):
        return np.zeros((1, 0)), np.zeros(0)
    labels, body = int(t["label_id"].max()) + 1, t[t["feature"] >= 0]
    bias, own = np.zeros(labels), t[t["feature"] == BIAS_FEATURE]
    weights = np.zeros((int(body["feature"].max()) + 1, labels))
    weights[body["feature"].to_numpy(), body["label_id"].to_numpy()] = body["weight"].to_numpy()
    bias[own["label_id"].to_numpy()] = own["weight"].to_numpy()
    return weights, bias


def _added(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """The sum of the weights of some features, repeats included."""
    return np.ones(len(features)) @ weights.take(features, axis=0)


def linear_predict_fn(spark, weights: np.ndarray, bias: np.ndarray) -> Callable:
    """``make_predict_fn`` of a linear head."""
    shared = spark.sparkContext.broadcast((weights, bias))

    def make():
        w, b = shared.value

        def predict(input_ids: np.ndarray, attention_mask: np.ndarray) -> np.ndarray:
            features = input_ids % len(w)
            return np.stack([_added(w, f[m]) for f, m in zip(features, attention_mask.astype(bool), strict=True)]) + b

        return predict

    return make


def shipped(spark, folder: str, load: Callable[[str], Callable]) -> Callable:
    """U2 + S9: a model chosen by path, as a ``make_predict_fn`` (or ``make_pair_fn``).

    ``folder`` (on any store that Spark reads) goes to every executor by Spark's
    own file distribution; ``load(local folder)`` builds the model once per
    Python worker, which keeps it until another model comes. A folder of a
    local file system, which Spark ships file by file alone, goes as one
    archive. Two folders of one name on another store cannot be shipped by one
    session: give a version its own name.
    """
    path = urlparse(folder)
    name = folder.rstrip("/").rsplit("/", 1)[1]
    if path.scheme in ("", "file"):
        local = os.path.abspath(unquote(path.path) if path.scheme else folder)
        if not os.path.isdir(local):
            raise FileNotFoundError(f"there is no folder {folder}")
        name = f"{name}-{uuid.uuid4().hex[:12]}.zip"
        # executors fetch it when they first need it: it stays as long as the driver's process
        own = tempfile.mkdtemp(prefix="clausework-shipped-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.sparkContext.addArchive(shutil.make_archive(os.path.join(own, name.removesuffix(".zip")), "zip", local))
    else:
        spark.sparkContext.addFile(folder, recursive=True)

    def make() -> Callable:
        from pyspark import SparkFiles

        return load(SparkFiles.get(name))

    return make


def load_head(folder: str) -> Callable:
    """A ``load`` for a head table written as parquet."""
    import pyarrow.parquet as pq

    t = pq.read_table(folder, columns=["label_id", "feature", "weight"])
    label, feature, weight = (t[c].to_numpy() for c in ("label_id", "feature", "weight"))
    wide = np.zeros((int(feature.max(initial=-1)) + 2, int(label.max(initial=-1)) + 1))
    wide[feature + 1, label] = weight  # the bias, feature -1, comes first
    bias, weights = wide[0], wide[1:]

    def predict(input_ids: np.ndarray, attention_mask: np.ndarray) -> np.ndarray:
        features = input_ids % len(weights)
        return np.stack([_added(weights, f[m]) for f, m in zip(features, attention_mask.astype(bool), strict=True)]) + bias

    return predict


def _starts(n: int, windowing: str, max_length: int, step: int) -> range:
    """Where the windows of ``n`` tokens begin (``n`` without specials for overlap windows, with them for fixed ones)."""
    if windowing == "fixed":
        return range(0, n, step)
    cap = max_length - 2
    return range(0, step * max(0, -(-(n - cap) // step)) + 1, step)


def _windows(ids: np.ndarray, windowing: str, max_length: int, step: int, cls_id: int, sep_id: int) -> list[np.ndarray]:
    if windowing == "fixed":
        full = np.concatenate([[cls_id], ids, [sep_id]])
        return [full[s:s + max_length] for s in _starts(len(full), windowing, max_length, step)]
    return [np.concatenate([[cls_id], ids[s:s + max_length - 2], [sep_id]])
            for s in _starts(len(ids), windowing, max_length, step)]


def window_logits(ids: Column, make_predict_fn: Callable, *, windowing: str = "overlap", max_length: int = MAX_LENGTH,
                  overlap: int = PREDICT_OVERLAP, step: int = TRAIN_STEP, cls_id: int = CLS_ID, sep_id: int = SEP_ID,
                  pad_id: int = PAD_ID, batch_size: int = BATCH_SIZE,
                  finish: tuple[Callable, T.DataType] | None = None, make_encode: Callable | None = None) -> Column:
    """``array<array<double>>``, the logits of each window of a clause's token ids, in order.

    With ``finish``, a function of these arrays and its type, what it makes of a
    clause's logits is returned instead of them. With ``make_encode``, which
    returns ``encode(text as UTF-8) -> ids``, the column holds texts, whose ids
    are found here and do not leave the worker.

    ``make_predict_fn()`` returns ``predict(input_ids[n, L], attention_mask[n,
    L]) -> logits[n, labels]`` and is built once per Python worker. Windows of
    an Arrow batch are scored ``batch_size`` at a time, padded to the longest of
    their batch (T6). When a batch fails its windows are scored one by one; a
    clause with a window that still fails gets null. Null ids have no tokens.
    """
    if windowing not in ("overlap", "fixed"):
        raise ValueError("windowing is 'overlap' or 'fixed'")
    move = step if windowing == "fixed" else max_length - 2 - overlap
    if move < 1 or max_length < 3:
        raise ValueError("windows must move on: max_length - 2 > overlap, step > 0")
    identity = identity_of(make_predict_fn)
    encoder = None if make_encode is None else identity_of(make_encode)

    def score(predict, windows: list[np.ndarray]) -> list:
        width = max(map(len, windows))
        batch, mask = np.full((len(windows), width), pad_id, dtype=np.int64), np.zeros((len(windows), width), dtype=np.int64)
        for i, w in enumerate(windows):
            batch[i, :len(w)], mask[i, :len(w)] = w, 1
        try:
            return list(np.asarray(predict(batch, mask), dtype=np.float64).reshape(len(windows), -1))
        except Exception:
            return [None] if len(windows) == 1 else [x for w in windows for x in score(predict, [w])]

    def given(clauses: pa.Array) -> Iterator[np.ndarray]:
        values, ends = clauses.values.to_numpy(zero_copy_only=False), clauses.offsets.to_numpy()
        return (values[first:end] for first, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))

    kind = T.ArrayType(T.ArrayType(T.DoubleType())) if finish is None else finish[1]

    # Arrow arrays, so that a batch of token ids is not copied into Python objects
    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from pyspark.sql.pandas.types import to_arrow_type

        predict = built(f"model-{windowing}", identity, make_predict_fn)
        encode = None if make_encode is None else built("encode", encoder, make_encode)
        for clauses in batches:
            out, held = [[] for _ in range(len(clauses))], []
            for n, own in enumerate(given(clauses) if encode is None else encoded(clauses, encode)):
                own = np.zeros(0, dtype=np.int64) if own is None else own.astype(np.int64)
                held += [(n, w) for w in _windows(own, windowing, max_length, move, cls_id, sep_id)]
                while len(held) >= batch_size:
                    for (i, _), z in zip(held[:batch_size], score(predict, [w for _, w in held[:batch_size]]), strict=True):
                        out[i].append(z)
                    held = held[batch_size:]
            if held:
                for (i, _), z in zip(held, score(predict, [w for _, w in held]), strict=True):
                    out[i].append(z)
            done = [None if any(z is None for z in w) else w for w in out]
            yield pa.array(done if finish is None else [None if w is None else finish[0](w) for w in done], type=to_arrow_type(kind))

    return run(ids)


def sparse_decision(threshold: float = THRESHOLD) -> tuple[Callable, T.DataType]:
    """A1 + C8 + P6 as a ``finish``: the predicted label ids alone, so that any number of labels leaves the worker short."""
    def finish(logits: list[np.ndarray]) -> list[int]:
        with np.errstate(over="ignore"):
            total = np.zeros(len(logits[0]))
            for z in logits:
                total += 1.0 / (1.0 + np.exp(-z))
        p = total / len(logits)
        if not len(p):
            return []
        hits = np.flatnonzero(p >= threshold)
        return [int(i) for i in hits] if len(hits) else [int(p.argmax())]

    return finish, T.ArrayType(T.IntegerType())


def score_windows(windows: DataFrame, head: DataFrame, keys: tuple[str, ...] = ("row_id", "window"),
                  window_ids: str = "window_ids", head_rows: int | None = None, n_features: int = N_FEATURES) -> DataFrame:
    """I1 for a head of any size: ``(keys..., label_id, logit)`` for every window and label.

    A window's features are counted in its row; the head's shards meet blocks of
    windows (``sharded``), so that no row is made for a feature of a window. The
    bias is added at the end, to the sum of windows with equal keys.
    """
    from .head import counted
    from .sharded import ShardedModel

    rows = windows.select(*keys, F.monotonically_increasing_id().alias("win"), F.col(window_ids).alias("features"),
                          F.array().cast("array<int>").alias("labels"))
    x = stored(counted(rows.where(F.size("features") > 0), n_features), "window-counts")
    z = ShardedModel.of(head).sums(x, keys)
    sums = z.select(*keys, F.posexplode("z").alias("label_id", "z")).groupBy(*keys, "label_id").agg(F.sum("z").alias("z"))
    bias = bounded_broadcast(head.where(F.col("feature") == BIAS_FEATURE).select("label_id", F.col("weight").alias("bias")), rows=head_rows)
    return sums.join(bias, "label_id").select(*keys, "label_id", (F.col("z") + F.col("bias")).alias("logit"))


# --- plug-in pair model: the overlap scorer as a batch model ------------------

def overlap_pair_model():
    """``make_pair_fn`` for the stance plug-in surface that scores like the
    relational overlap scorer (entailment logit in column 0). Used to check
    the plug-in path end to end against the relational one; a real
    entailment model plugs in the same way."""
    import re
    from functools import lru_cache

    word = re.compile(r"[^ \t\n\r]+")
    last: list = [None, None, None]  # the pairs of a premise come one after another: its words are found once

    def split(hypothesis: str) -> tuple[int, frozenset]:
        found = word.findall(hypothesis.lower())
        return len(found), frozenset(found)

    # the hypotheses of an actor come back with every premise
    remembered = lru_cache(HYPOTHESES)(split)

    def of(premise: str) -> None:
        if last[0] != premise:
            last[:] = premise, None, None

    def among(premise: str) -> set:
        of(premise)
        if last[1] is None:
            # the empty text between two blanks is a word of no hypothesis
            last[1] = set(premise.lower().replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" "))
        return last[1]

    def places(premise: str) -> dict[str, int]:
        of(premise)
        if last[2] is None:
            found = word.findall(premise.lower())
            last[2] = dict(zip(reversed(found), range(len(found) - 1, -1, -1)))
        return last[2]

    def fn(premises, hypotheses, max_length):
        out = np.zeros((len(premises), 3))
        for k, (p, h) in enumerate(zip(premises, hypotheses, strict=True)):
            n, own = (remembered if len(h) <= HYPOTHESIS_CHARS else split)(h)
            room = None if max_length is None else max_length - 3 - n
            if not own or (room is not None and room < 0):
                raise ValueError("hypothesis does not fit beside the premise")
            if room is None:
                hits = len(own & among(p))
            else:
                first = places(p)
                hits = sum(1 for x in own if x in first and first[x] < room)
            out[k, 0] = hits / len(own)
        return out

    return fn
