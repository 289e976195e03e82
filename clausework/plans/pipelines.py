"""End-to-end pipelines (U6): ``tag``, ``stance``, ``stance_file``, ``fit_tagger`` as keyword functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import (CLS_ID, MAX_LENGTH, N_FEATURES, PAD_ID, PREDICT_OVERLAP, SEP_ID, THRESHOLD, TRAIN_STEP, as_text)
from ..operators._util import ROW, numbered, stored
from ..operators import clean, labels as L, scoring, stance as stance_ops, tagging, windows
from ..operators.sampling import SEED, sample_exact
from ..sources import io

# labels whose names travel as a literal array; ids are looked up by position
MAX_NAMES = 100_000


def clause_ids(text, make_tokenizer: Callable | None = None):
    """Token ids of a text column by the default or a plug-in tokenizer."""
    return windows.word_token_ids(text) if make_tokenizer is None else windows.foreign_token_ids(text, make_tokenizer)


def clause_logits(clauses: DataFrame, head: DataFrame | None, *, key: str = "row_id", text: str = "clause", keep: tuple[str, ...] = (),
                  head_rows: int | None = None, make_predict_fn: Callable | None = None, make_tokenizer: Callable | None = None,
                  null_text: str | None = "nan", **window_options) -> DataFrame | None:
    """``(key, keep..., logits)`` with the logits of every window of a clause; None if the head is too large for it.

    The model is ``make_predict_fn`` or else the linear ``head``.
    """
    if make_predict_fn is None:
        arrays = scoring.head_arrays(head, head_rows)
        if arrays is None:
            return None
        make_predict_fn = scoring.linear_predict_fn(clauses.sparkSession, *arrays)
    col = F.col(text) if null_text is None else as_text(F.col(text), null_text)
    if make_tokenizer is None:
        # words and their ids are found where the windows are scored
        lower = F.lower(col)
        return clauses.select(key, *keep, scoring.window_logits(lower, make_predict_fn, make_encode=windows.make_word_ids, **window_options).alias("logits"))
    ids = clauses.select(key, *keep, clause_ids(col, make_tokenizer).alias("ids"))
    return ids.select(key, *keep, scoring.window_logits(F.col("ids"), make_predict_fn, **window_options).alias("logits"))


def tag(clauses: DataFrame, head: DataFrame | None, vocab: DataFrame, *, key: str = "row_id", text: str = "clause",
        threshold: float = THRESHOLD, null_text: str = "nan", sample_size: int | None = None, seed: int = SEED,
        max_length: int = MAX_LENGTH, overlap: int = PREDICT_OVERLAP, make_predict_fn: Callable | None = None,
        make_tokenizer: Callable | None = None, cls_id: int = CLS_ID, sep_id: int = SEP_ID, pad_id: int = PAD_ID,
        batch_size: int = scoring.BATCH_SIZE, head_rows: int | None = None, vocab_rows: int | None = None,
        n_features: int = N_FEATURES, on_error: str = "unknown", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(key, keep..., predicted_actors)`` for every clause (after an optional exact sample).

    One pass over the clauses: tokens, windows, logits, pooling and decision
    stay in the row. ``make_predict_fn`` and ``make_tokenizer`` (with its
    special ids) plug a real model in; without them the linear ``head`` scores
    hashed words. A head or vocabulary too large to travel is joined instead,
    with rows told apart by number, since keys may repeat; a model for such a
    vocabulary returns the predicted ids alone.
    """
    src = clauses.select(*dict.fromkeys((key, text, *keep)))
    if sample_size is not None:
        src = sample_exact(src, sample_size, seed, key)
    names = L.label_names(vocab, vocab_rows, MAX_NAMES)
    options = dict(max_length=max_length, overlap=overlap, cls_id=cls_id, sep_id=sep_id, pad_id=pad_id, batch_size=batch_size)
    scored = None if names is None else clause_logits(
        src, head, key=key, text=text, keep=keep, head_rows=head_rows, make_predict_fn=make_predict_fn, make_tokenizer=make_tokenizer,
        null_text=null_text, **options)
    if scored is not None:
        probs = scored.select(key, *keep, tagging.pooled(F.col("logits"), len(names)).alias("probs"))
        return probs.select(key, *keep, tagging.decided(F.col("probs"), names, threshold, on_error, F.col(key)).alias("predicted_actors"))
    rows = numbered(src, "tag-rows")
    ids = rows.select(ROW, clause_ids(as_text(F.col(text), null_text), make_tokenizer).alias("ids"))
    kept = rows.select(ROW, key, *keep)
    if make_predict_fn is not None:
        got = scoring.window_logits(F.col("ids"), make_predict_fn, finish=scoring.sparse_decision(threshold), **options)
        found = stored(ids.select(ROW, got.alias("label_ids")), "tag-ids")
        return tagging.named(kept, found, vocab, vocab_rows, on_error, F.col(key))
    wins = windows.overlap_windows(ids, "ids", max_length, overlap, keep=(ROW,), cls_id=cls_id, sep_id=sep_id)
    probs = tagging.pool(scoring.score_windows(wins, head, (ROW, "window"), head_rows=head_rows, n_features=n_features), ROW)
    done = kept.join(tagging.decide(probs, vocab, threshold, ROW, vocab_rows=vocab_rows), ROW, "left")
    # without a label there is no score
    return done.select(key, *keep, F.coalesce("predicted_actors", F.array().cast("array<string>")).alias("predicted_actors"))


def attach(rows: DataFrame, result: DataFrame, key: str = "row_id") -> DataFrame:
    """Put per-row results back beside their input rows (join on the key)."""
    return rows.join(result, key, "left")


def stance(df: DataFrame, **kwargs) -> DataFrame:
    """Z4 end to end (see ``operators.stance.stance``)."""
    return stance_ops.stance(df, **kwargs)


def stance_file(spark: SparkSession, input_path: str, output_path: str, schema: T.StructType, **options) -> dict:
    """The stance entry: read CSV, validate, fill, score, write CSV and a second copy; returns the report."""
    rows = clean.validate(io.read_csv(spark, input_path, schema))
    return io.save_with_backup(stance_ops.stance(clean.fill_missing(rows), **options), output_path)


def training_windows(rows: DataFrame, *, text: str = "clause", make_tokenizer: Callable | None = None, max_length: int = MAX_LENGTH,
                     step: int = TRAIN_STEP, cls_id: int = CLS_ID, sep_id: int = SEP_ID, keep: tuple[str, ...] = ("row_id", "label_ids")) -> DataFrame:
    """T2 + T4: ``(keep..., window, window_ids)``; the label ids travel with the row."""
    ids = rows.select(*keep, clause_ids(F.col(text), make_tokenizer).alias("ids"))
    return windows.fixed_step_windows(ids, "ids", max_length, step, keep=keep, cls_id=cls_id, sep_id=sep_id)


def fit_tables(clauses: DataFrame, *, key: str = "row_id", text: str = "clause", actors_text: str = "regularized_actors",
               old_head: DataFrame | None = None, old_vocab: DataFrame | None = None, warm_map: DataFrame | None = None,
               test_share: float = 0.2, seed: int = SEED, exact_split: bool = False, max_length: int = MAX_LENGTH, step: int = TRAIN_STEP,
               make_tokenizer: Callable | None = None, cls_id: int = CLS_ID, sep_id: int = SEP_ID, n_features: int = N_FEATURES) -> dict:
    """What a fit starts from: ``{"train", "test"}`` (window rows), ``"init"`` (first head), ``"vocab"``, ``"skipped"``.

    The vocabulary is built on all rows before the split, and the split comes
    before windowing, so no clause has windows on both sides.
    """
    from ..functions.lists import parse_list_strict
    from ..operators import head as H
    from ..operators.sampling import split_exact, split_hash

    rows = clauses.select(F.col(key).alias("row_id"), F.col(text).alias("clause"),
                          parse_list_strict(F.col(actors_text)).alias("actors"))
    vocab, n_labels = L.vocabulary_sized(rows, "actors")
    rows = L.with_label_ids(rows, vocab, vocab_rows=n_labels)
    train, test = (split_exact if exact_split else split_hash)(rows, test_share, seed, "row_id")

    def table(side: DataFrame) -> DataFrame:
        if make_tokenizer is None:
            return H.text_rows(side, n_features, max_length=max_length, step=step, cls_id=cls_id, sep_id=sep_id)
        wins = training_windows(side, make_tokenizer=make_tokenizer, max_length=max_length, step=step, cls_id=cls_id, sep_id=sep_id)
        return H.window_rows(wins, n_features)

    init = scoring.hash_head(vocab, n_features=n_features)
    skipped = None
    if old_head is not None:
        wm = warm_map if warm_map is not None else L.warm_map_table(rows.sparkSession)
        ov = old_vocab if old_vocab is not None else old_head.select("label_id", "label").distinct()
        pairs = L.warm_pairs(wm, vocab, ov)
        skipped = L.warm_skipped(wm, vocab, ov)
        init = L.warm_copy(init, old_head, pairs)
    return {"train": table(train), "test": table(test), "init": init, "vocab": vocab, "skipped": skipped}


def fit_tagger(clauses: DataFrame, *, epochs: int = 5, steps_per_epoch: int = 2, batches: int | None = None, accumulate: int = 1,
               lr: float = 0.05, weight_decay: float = 0.01, warmup_ratio: float = 0.1, eval_every: int | None = None, keep: int = 2,
               seed: int = SEED, fit: dict | None = None, **tables) -> dict:
    """Training end to end (3.1): strict parse -> vocabulary -> split -> fixed-step
    windows -> (warm-started) head -> fit -> hold-out metrics at window level.

    Returns ``{"head", "heads", "vocab", "epochs", "metrics", "skipped"}``.
    ``tables`` are the options of ``fit_tables``, ``fit`` further ones of
    ``head.fit`` (``batch_size``, ``loss``, ``state``, ...).
    """
    from ..operators import head as H

    t = fit_tables(clauses, seed=seed, **tables)
    head, table_of_epochs, heads = H.fit(
        t["train"], t["init"], evaluation=t["test"], epochs=epochs, steps_per_epoch=steps_per_epoch, batches=batches,
        accumulate=accumulate, lr=lr, weight_decay=weight_decay, warmup_ratio=warmup_ratio, eval_every=eval_every, keep=keep,
        **{"seed": seed, **(fit or {})})
    metrics = table_of_epochs.where("best").select("accuracy", "f1", "precision", "recall")
    return {"head": head, "heads": heads, "vocab": t["vocab"], "epochs": table_of_epochs, "metrics": metrics, "skipped": t["skipped"]}


__all__ = ["tag", "attach", "stance", "stance_file", "fit_tables", "fit_tagger", "clause_logits", "clause_ids", "training_windows"]
