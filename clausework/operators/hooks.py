"""Metrics given by the caller (U4, E3): mergeable states, added up per task and merged in a tree.

A metric is four functions: ``start()`` gives an empty state, ``add(state,
logits, truth)`` adds a clause (arrays of windows x labels), ``merge(a, b)``
joins two states and ``finish(state)`` gives the rows of the result. A state is
what one task holds and sends, so it must not grow with the rows; every merge
takes at most ``FAN`` states.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import THRESHOLD
from ._util import stored

# states that one merge takes
FAN = 16


class Metric(NamedTuple):
    """U4: ``schema`` is that of the rows that ``finish`` returns, as tuples."""

    start: Callable[[], Any]
    add: Callable[[Any, np.ndarray, np.ndarray], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], list[tuple]]
    schema: str


def measured(scored: DataFrame, metric: Metric, n_labels: int, logits: str = "logits", label_ids: str = "label_ids", fan: int = FAN) -> DataFrame:
    """``metric`` over rows that carry their windows' logits and their own label ids; null logits add nothing."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        state = metric.start()
        for b in batches:
            for z, own in zip(b["z"], b["own"], strict=True):
                if z is not None and len(z):
                    y = np.zeros((len(z), n_labels))
                    y[:, np.asarray([] if own is None else own, dtype=np.int64)] = 1.0
                    state = metric.add(state, np.stack([np.asarray(w, dtype=np.float64) for w in z]), y)
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "state": [pickle.dumps(state)]})

    def merged(states: pd.DataFrame) -> Any:
        total = metric.start()
        for s in states.sort_values("part")["state"]:
            total = metric.merge(total, pickle.loads(s))
        return total

    def joined(states: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [int(states["part"].min()) // fan], "state": [pickle.dumps(merged(states))]})

    def result(states: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(metric.finish(merged(states)), columns=[f.strip().split()[0] for f in metric.schema.split(",")])

    states = stored(scored.select(F.col(logits).alias("z"), F.col(label_ids).alias("own"))
                    .mapInPandas(partial, "part int, state binary"), "metric-states")
    left = states.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0] + 1
    # an input without a partition still has a result
    empty = states.sparkSession.createDataFrame([(0, bytearray(pickle.dumps(metric.start())))], "part int, state binary")
    states = states.unionByName(empty)
    while left > fan:
        states = states.groupBy(F.floor(F.col("part") / fan)).applyInPandas(joined, "part int, state binary")
        left = -(-left // fan)
    return states.groupBy().applyInPandas(result, metric.schema)


def label_counts(n_labels: int, finish: Callable[[np.ndarray], list[tuple]], schema: str, threshold: float = THRESHOLD) -> Metric:
    """A metric of the counts ``[tp, fp, fn, tn]`` per label."""
    def add(state: np.ndarray, z: np.ndarray, y: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            hit, true = 1.0 / (1.0 + np.exp(-z)) >= threshold, y == 1
        return state + np.stack([(hit & true).sum(axis=0), (hit & ~true).sum(axis=0), (~hit & true).sum(axis=0), (~hit & ~true).sum(axis=0)])

    return Metric(lambda: np.zeros((4, n_labels), dtype=np.int64), add, lambda a, b: a + b, finish, schema)


def label_f1(n_labels: int, threshold: float = THRESHOLD) -> Metric:
    """Precision, recall and F1 of every label; undefined ratios count 0."""
    def finish(counts: np.ndarray) -> list[tuple]:
        out = []
        for i, (tp, fp, fn, _) in enumerate(counts.T.tolist()):
            p, r = (tp / (tp + fp) if tp + fp else 0.0), (tp / (tp + fn) if tp + fn else 0.0)
            out.append((i, p, r, 2 * p * r / (p + r) if p + r else 0.0))
        return out

    return label_counts(n_labels, finish, "label_id int, precision double, recall double, f1 double", threshold)


def macro(n_labels: int, threshold: float = THRESHOLD) -> Metric:
    """E3 through the hook: accuracy and macro averages over the classes 0 and 1 that occur."""
    def finish(counts: np.ndarray) -> list[tuple]:
        tp, fp, fn, tn = (int(x) for x in counts.sum(axis=1))
        n = tp + fp + fn + tn
        classes = [(a, b, c) for a, b, c in ((tp, fp, fn), (tn, fn, fp)) if a + b + c]
        ratio = lambda a, b: a / b if b else 0.0
        each = [(ratio(a, a + b), ratio(a, a + c)) for a, b, c in classes]
        mean = lambda x: ratio(sum(x), len(classes))
        return [(ratio(tp + tn, n), mean([ratio(2 * p * r, p + r) for p, r in each]), mean([p for p, _ in each]), mean([r for _, r in each]))]

    return label_counts(n_labels, finish, "accuracy double, f1 double, precision double, recall double", threshold)
