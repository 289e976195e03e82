"""Pool window scores into label lists per clause.

p(clause, label) is the mean over the clause's windows of sigmoid(logit).
Labels with p >= threshold are predicted in id order; when none is, the
single argmax is (the smallest id wins ties; a NaN p never passes the
threshold and, as in numpy, the first NaN wins the argmax). A clause with a
failed window gets ``["Unknown"]``.

All of it is array expressions over the clause's own logits
(``window_logits``). The long forms (``pool``, ``decide``) serve heads too
large for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import THRESHOLD, UNKNOWN, sigmoid
from ._util import ROW, bounded_broadcast


def pooled(logits: Column, n_labels: int) -> Column:
    """A1: ``array<double>``, the mean over windows of each label's sigmoid; null stays null."""
    if n_labels < 1:
        return F.when(logits.isNotNull(), F.array().cast("array<double>"))

    def mean(k: Column) -> Column:
        total = F.aggregate(logits, F.lit(0.0), lambda acc, w: acc + sigmoid(F.get(w, k)))
        return total / F.size(logits)

    return F.when(logits.isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(n_labels - 1)), mean))


def decided_ids(probs: Column, threshold: float = THRESHOLD) -> Column:
    """C8 + A4 + P6: the predicted label ids (threshold, else the first maximum, NaN the greatest)."""
    hits = F.filter(F.transform(probs, lambda p, i: F.when((p >= F.lit(threshold)) & ~F.isnan(p), i)), lambda i: i.isNotNull())
    best = F.array((F.array_position(probs, F.array_max(probs)) - 1).cast("int"))
    return F.when(F.size(probs) == 0, F.array().cast("array<int>")).when(F.size(hits) > 0, hits).otherwise(best)


def _failed(on_error: str, key: Column | None) -> Column:
    return (F.array(F.lit(UNKNOWN)) if on_error == "unknown" else
            F.raise_error(F.concat(F.lit("scoring failed for clause "), F.lit("") if key is None else key.cast("string"))))


def decided(probs: Column, names: list[str], threshold: float = THRESHOLD, on_error: str = "unknown",
            key: Column | None = None) -> Column:
    """C8 + A4 + P6 + J2 + I3: the predicted labels, by name; ``["Unknown"]`` (or an error) where scoring failed."""
    if on_error not in ("unknown", "raise"):
        raise ValueError("on_error must be 'unknown' or 'raise'")
    table = F.lit(names) if names else F.array().cast("array<string>")
    return F.when(probs.isNull(), _failed(on_error, key)).otherwise(
        F.transform(decided_ids(probs, threshold), lambda i: F.get(table, i)))


def pool(logits: DataFrame, key: str = "row_id") -> DataFrame:
    """A1, long: ``(key, label_id, p)`` from ``(key, window, label_id, logit)``."""
    return logits.groupBy(key, "label_id").agg(F.avg(sigmoid(F.col("logit"))).alias("p"))


def named(rows: DataFrame, ids: DataFrame, vocab: DataFrame, vocab_rows: int | None = None, on_error: str = "unknown",
          key: Column | None = None, out: str = "predicted_actors") -> DataFrame:
    """J2 + I3, long: ``rows`` with the names of their label ids from ``ids`` (row number, label_ids), joined by label.

    Null ids are a failed clause.
    """
    if on_error not in ("unknown", "raise"):
        raise ValueError("on_error must be 'unknown' or 'raise'")
    each = ids.select(ROW, F.posexplode_outer("label_ids").alias("i", "label_id")).where(F.col("i").isNotNull())
    lists = (each.join(bounded_broadcast(vocab.select("label_id", "label"), rows=vocab_rows), "label_id")
             .groupBy(ROW).agg(F.array_sort(F.collect_list(F.struct("i", "label"))).alias("own")))
    done = rows.join(ids.select(ROW, F.col("label_ids").isNull().alias("failed")), ROW).join(lists, ROW, "left")
    names = F.coalesce(F.transform("own", lambda x: x["label"]), F.array().cast("array<string>"))
    return done.select(*[F.col(c) for c in rows.columns if c != ROW], F.when(F.col("failed"), _failed(on_error, key)).otherwise(names).alias(out))


def decide(probs: DataFrame, vocab: DataFrame, threshold: float = THRESHOLD, key: str = "row_id",
           out: str = "predicted_actors", vocab_rows: int | None = None) -> DataFrame:
    """C8 + A4 + P6 + J2, long: ``(key, out ARRAY<STRING>)`` from ``(key, label_id, p)``."""
    pv = probs.join(bounded_broadcast(vocab, rows=vocab_rows), "label_id", "left")
    hit = (F.col("p") >= F.lit(threshold)) & ~F.isnan("p")
    per = pv.groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(hit, F.struct("label_id", "label")))).alias("hits"),
        F.max(F.struct(F.col("p"), (-F.col("label_id")).alias("neg"), F.col("label"))).alias("best"))
    return per.select(key, F.when(F.size("hits") > 0, F.transform("hits", lambda h: h["label"]))
                      .otherwise(F.array(F.col("best")["label"])).alias(out))
