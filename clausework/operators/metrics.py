"""Classification metrics over the flattened (window x label) cells.

The prediction/truth matrix is flattened into one binary problem, so the
"macro" average runs over the classes 0 and 1 that occur (in truth or in
prediction), not over labels. Undefined ratios count 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import THRESHOLD, sigmoid


def cells(scored: DataFrame, keep: tuple[str, ...] = ("row_id",), logits: str = "logits", label_ids: str = "label_ids") -> DataFrame:
    """``(keep..., window, label_id, logit, y)`` from rows that carry their windows' logits and their own label ids.

    The truth stands beside the logits, so flattening needs no join.
    """
    per_window = scored.select(*keep, label_ids, F.posexplode(logits).alias("window", "z"))
    flat = per_window.select(*keep, label_ids, "window", F.posexplode("z").alias("label_id", "logit"))
    return flat.select(*keep, "window", "label_id", "logit",
                       F.array_contains(label_ids, F.col("label_id")).cast("int").alias("y"))


def cell_counts(logits: Column, label_ids: Column, threshold: float = THRESHOLD) -> Column:
    """E1 + E2 + E4 beside the row: ``struct<tp, fp, fn, tn, loss>`` over all (window, label) cells of a clause.

    The truth is a set of label ids per clause, so the cells of a window are
    told apart by position; no row is made per cell.
    """
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("tp"), zero.alias("fp"), zero.alias("fn"), zero.alias("tn"), F.lit(0.0).alias("loss"))

    def cell(z: Column, i: Column) -> Column:
        p, y = sigmoid(z), F.array_contains(label_ids, i)
        return F.struct(((p >= F.lit(threshold)) & ~F.isnan(p)).alias("pred"), y.alias("y"),
                        (F.greatest(z, F.lit(0.0)) - z * y.cast("double") + F.log1p(F.exp(-F.abs(z)))).alias("loss"))

    def add(acc: Column, c: Column) -> Column:
        one = {"tp": c["pred"] & c["y"], "fp": c["pred"] & ~c["y"], "fn": ~c["pred"] & c["y"], "tn": ~c["pred"] & ~c["y"]}
        return F.struct(*[(acc[k] + v.cast("long")).alias(k) for k, v in one.items()], (acc["loss"] + c["loss"]).alias("loss"))

    return F.aggregate(logits, start, lambda acc, w: F.aggregate(F.transform(w, cell), acc, add))


def confusion_counts(scored: DataFrame, logits: str = "logits", label_ids: str = "label_ids", threshold: float = THRESHOLD) -> DataFrame:
    """E2 + E4: one row ``tp, fp, fn, tn, loss_sum`` of rows that carry their windows' logits and their own label ids."""
    per = scored.select(cell_counts(F.col(logits), F.col(label_ids), threshold).alias("c"))
    total = per.agg(*[F.coalesce(F.sum(f"c.{k}"), F.lit(0)).cast("long").alias(k) for k in ("tp", "fp", "fn", "tn")],
                    F.coalesce(F.sum("c.loss"), F.lit(0.0)).alias("loss_sum"))
    return total


def mean_loss(counts: DataFrame) -> DataFrame:
    """``(loss, n_cells)`` of ``confusion_counts``; null without a cell."""
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return counts.select(F.when(n > 0, F.col("loss_sum") / n).alias("loss"), n.alias("n_cells"))


def clause_cells(decided: DataFrame, n_labels: int, keep: tuple[str, ...] = ("row_id",), decided_ids: str = "decided_ids",
                 label_ids: str = "label_ids") -> DataFrame:
    """E1 at clause level: ``(keep..., label_id, y, pred)`` from rows with their decided and their own label ids."""
    if n_labels < 1:
        return decided.limit(0).select(*keep, F.lit(0).alias("label_id"), F.lit(0).alias("y"), F.lit(False).alias("pred"))
    flat = decided.select(*keep, decided_ids, label_ids, F.explode(F.sequence(F.lit(0), F.lit(n_labels - 1))).alias("label_id"))
    return flat.select(*keep, "label_id", F.array_contains(label_ids, F.col("label_id")).cast("int").alias("y"),
                       F.array_contains(decided_ids, F.col("label_id")).alias("pred"))


def confusion_from_pred(cells_df: DataFrame) -> DataFrame:
    """E2 for cells that carry a boolean ``pred`` (clause level)."""
    pred, y = F.col("pred"), F.col("y") == 1
    return cells_df.agg(
        F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))


def confusion(cells_df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row ``tp, fp, fn, tn`` (BIGINT) at p >= threshold."""
    p = sigmoid(F.col("logit"))
    pred = (p >= F.lit(threshold)) & ~F.isnan(p)
    y = F.col("y") == 1
    return cells_df.agg(
        F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def macro_metrics(conf: DataFrame) -> DataFrame:
    """Accuracy and macro precision / recall / F1 over the classes present."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    p1, p0 = _ratio(tp, tp + fp), _ratio(tn, tn + fn)
    r1, r0 = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    f1_1, f1_0 = _ratio(2 * p1 * r1, p1 + r1), _ratio(2 * p0 * r0, p0 + r0)
    has1 = ((tp + fn + fp) > 0).cast("double")
    has0 = ((tn + fp + fn) > 0).cast("double")
    n_cls = has1 + has0

    def macro(c1: Column, c0: Column) -> Column:
        return _ratio(c1 * has1 + c0 * has0, n_cls)

    return conf.select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        macro(f1_1, f1_0).alias("f1"),
        macro(p1, p0).alias("precision"),
        macro(r1, r0).alias("recall"))


def bce_loss(cells_df: DataFrame) -> DataFrame:
    """Mean binary cross-entropy with logits over all cells (stable form)."""
    z, y = F.col("logit"), F.col("y").cast("double")
    term = F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))
    return cells_df.agg(F.avg(term).alias("loss"), F.count(F.lit(1)).alias("n_cells"))
