"""Driver query registry: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (whole tables, whole texts) and
returns flat columns (lists joined with "|", doubles rounded to 6 places)
so the DuckDB oracle in ``oracle.py`` can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lists import parse_list, parse_list_strict, parse_list_tolerant
from ..functions.text import CUT_CHARS, N_FEATURES
from ..functions.text import tokens
from ..operators import balance, batches as B, clean, head as H, hooks, pairs, labels as L, metrics as M, sampling as P, scoring, stance as Z, tagging as G, windows as W
from ..session import scratch_path
from ..sources import io, tables
from . import pipelines

Query = Callable[[SparkSession, str], DataFrame]

SAMPLE_N = 300        # rows drawn by the exact-sample queries
FIRST_N = 100         # rows kept by the first-n query
MODEL_LENGTH = 64     # tokens of the model in the truncation query
FIT_EPOCHS, FIT_STEPS = 3, 2
BATCH_EPOCHS, BATCH_STEPS = 2, 3   # of the fit by batches
BATCH_SIZE = 64       # windows in a listed batch
PARTS = 8             # balanced partitions
POSITIVE = 2.0        # weight of a true label in the weighted loss
SHARD_CELLS = 1 << 14  # weights in a shard of the sharded fit


def _joined(c, sep: str = "|") -> F.Column:
    return F.array_join(c, sep)


def _r6(c) -> F.Column:
    return F.round(c, 6)


def _vocab(spark: SparkSession, sf: str):
    """The vocabulary of all gold labels and its size; no text is read."""
    return L.vocabulary_sized(tables.gold_actors(tables.table(spark, sf, "documents"), tables.table(spark, sf, "labels")), "actors")


def _vocab_head(spark: SparkSession, sf: str):
    """Vocabulary, its dense hash head, and the known row counts of both (for the size checks, without a count job)."""
    vocab, k = _vocab(spark, sf)
    return vocab, scoring.hash_head(vocab), {"vocab_rows": k, "head_rows": k * (N_FEATURES + 1)}


def _tags(df: DataFrame) -> DataFrame:
    return df.select("row_id", _joined("predicted_actors").alias("predicted_actors"))


# --- step 0: tagging ----------------------------------------------------------

def q_tag_documents(spark, sf):
    """Pooled multi-label tags for every document (linear head)."""
    vocab, head, sizes = _vocab_head(spark, sf)
    return _tags(pipelines.tag(tables.documents(spark, sf), head, vocab, **sizes))


def q_tag_joined(spark, sf):
    """I1 + A1 + J2 in long form: the path of a head too large to broadcast."""
    vocab, head, sizes = _vocab_head(spark, sf)
    ids = tables.documents(spark, sf).select("row_id", pipelines.clause_ids(F.coalesce("clause", F.lit("nan"))).alias("ids"))
    probs = G.pool(scoring.score_windows(W.overlap_windows(ids), head, head_rows=sizes["head_rows"]))
    return _tags(G.decide(probs, vocab, vocab_rows=sizes["vocab_rows"]))


def q_tag_sample(spark, sf):
    """P1 + I2: tag an exact seeded sample of the documents."""
    vocab, head, sizes = _vocab_head(spark, sf)
    return _tags(pipelines.tag(tables.documents(spark, sf), head, vocab, **sizes, sample_size=SAMPLE_N))


def q_tag_batch_udf(spark, sf):
    """U2 + U5: the same tags through the plug-in surface, the model read from its stored table."""
    vocab, head, sizes = _vocab_head(spark, sf)
    path = scratch_path(spark, "head")
    io.write_table(head, path)
    model = scoring.linear_predict_fn(spark, *scoring.head_arrays(io.read_table(spark, path), sizes["head_rows"]))
    return _tags(pipelines.tag(tables.documents(spark, sf), None, vocab, vocab_rows=sizes["vocab_rows"], make_predict_fn=model, batch_size=64))


def _by_tokens(spark, sf):
    weight = F.size(tokens(F.coalesce("clause", F.lit("nan"))))
    return balance.balanced(tables.documents(spark, sf), weight, PARTS), weight


def q_tag_balanced(spark, sf):
    """Tags from partitions of equal shares of tokens."""
    vocab, head, sizes = _vocab_head(spark, sf)
    return _tags(pipelines.tag(_by_tokens(spark, sf)[0], head, vocab, **sizes))


def q_balanced_loads(spark, sf):
    """Partitions of equal shares of tokens: rows, tokens, and whether the largest is within 1.2 of the mean."""
    rows, weight = _by_tokens(spark, sf)
    load = balance.loads(rows, weight)
    even = F.max("weight") * PARTS <= F.sum("weight") * 1.2
    return load.agg(F.count(F.lit(1)).cast("int").alias("parts"), F.sum("rows").alias("rows"), F.sum("weight").alias("tokens"), even.alias("even"))


def q_tag_by_path(spark, sf):
    """U2 + S9: tags by a model folder that Spark ships to the executors."""
    vocab, head, sizes = _vocab_head(spark, sf)
    folder = scratch_path(spark, "head-folder")
    io.write_table(head, folder)
    model = scoring.shipped(spark, folder, scoring.load_head)
    return _tags(pipelines.tag(tables.documents(spark, sf), None, vocab, vocab_rows=sizes["vocab_rows"], make_predict_fn=model))


def _length_tokenizer():
    """A tokenizer of another kind: a word's id comes from its length and first letter."""
    import re

    words = re.compile(r"[^ \t\n\r]+").findall
    return lambda texts: [[3 + (31 * len(w) + ord(w[0])) % 1000 for w in words(t)] for t in texts]


def q_tag_foreign_tokenizer(spark, sf):
    """T1 + U1 + T6: tags with a plug-in tokenizer and its own special ids."""
    vocab, head, sizes = _vocab_head(spark, sf)
    return _tags(pipelines.tag(tables.documents(spark, sf), head, vocab, **sizes, make_tokenizer=_length_tokenizer, cls_id=2001, sep_id=2002))


def _failing(make):
    """A model that cannot score windows whose first word has an id divisible by 7."""
    def build():
        predict = make()

        def fn(input_ids, attention_mask):
            if (input_ids[:, 1] % 7 == 0).any():
                raise RuntimeError("no score for such a window")
            return predict(input_ids, attention_mask)

        return fn

    return build


def q_tag_failed_rows(spark, sf):
    """Documents with a window that the model cannot score get ["Unknown"], the others their tags."""
    vocab, head, sizes = _vocab_head(spark, sf)
    model = _failing(scoring.linear_predict_fn(spark, *scoring.head_arrays(head, sizes["head_rows"])))
    return _tags(pipelines.tag(tables.documents(spark, sf), None, vocab, vocab_rows=sizes["vocab_rows"], make_predict_fn=model))


def q_tag_benchmark(spark, sf):
    """I2 on a second clause table: the short benchmark items, with the documents' labels and head."""
    vocab, head, sizes = _vocab_head(spark, sf)
    items = tables.table(spark, sf, "benchmark").select(F.col("item_id").alias("row_id"), F.col("text").alias("clause"))
    return _tags(pipelines.tag(items, head, vocab, **sizes))


def _turns(spark, sf):
    return tables.table(spark, sf, "conversations").select(F.struct("conv_id", "turn").alias("turn_key"), F.col("text").alias("clause"))


def q_tag_conversations(spark, sf):
    """I2 keyed by a composite key: conversation turns, key (conv_id, turn) as one struct column."""
    vocab, head, sizes = _vocab_head(spark, sf)
    res = pipelines.tag(_turns(spark, sf), head, vocab, **sizes, key="turn_key")
    return res.select("turn_key.conv_id", "turn_key.turn", _joined("predicted_actors").alias("predicted_actors"))


def _probs(spark, sf):
    """``(row_id, probs)`` of every document and the number of labels."""
    vocab, head, sizes = _vocab_head(spark, sf)
    scored = pipelines.clause_logits(tables.documents(spark, sf), head, head_rows=sizes["head_rows"])
    return scored.select("row_id", G.pooled(F.col("logits"), sizes["vocab_rows"]).alias("probs")), sizes["vocab_rows"], vocab


def q_tag_probs(spark, sf):
    """A1: pooled probability per (document, label)."""
    probs, _, _ = _probs(spark, sf)
    # the outer form keeps the planner from scoring every text a second time, in a filter on the array's size
    each = probs.select("row_id", F.posexplode_outer("probs").alias("label_id", "p")).where(F.col("label_id").isNotNull())
    return each.select("row_id", F.col("label_id").cast("int").alias("label_id"), _r6("p").alias("p"))


# --- step 1: cleaning, validation, parsing ----------------------------------

def q_clean_fill(spark, sf):
    """C1 + C2: nulls filled per column; the text also cast as pandas would ("nan")."""
    raw = tables.stance_input(spark, sf).withColumn("as_text", F.col("clause"))
    df = clean.text_column(clean.fill_missing(raw), "as_text", "nan")
    return df.select("row_id", F.length("clause").cast("bigint").alias("clause_chars"), "predicted_actors",
                     F.md5("as_text").alias("text_md5"))


def q_cut_text(spark, sf):
    """Premise cut to 2,000 characters + '...'."""
    df = clean.cut(tables.stance_input(spark, sf), "clause", out="cut")
    return df.select("row_id", F.length("cut").cast("bigint").alias("cut_chars"), F.md5("cut").alias("cut_md5"))


def q_profile(spark, sf):
    """V1 + V2 + V3: validated input, row and non-null counts in one pass."""
    df = clean.validate(tables.stance_input(spark, sf))
    return clean.profile(df)


def q_preview(spark, sf):
    """The first three rows with the clause cut to 100 characters."""
    return clean.preview(tables.stance_input(spark, sf)).select("row_id", "clause", "predicted_actors")


def q_parse_actors(spark, sf):
    """C3 + C4: list literals parsed (strict and tolerant agree on these)."""
    df = tables.stance_input(spark, sf)
    return df.select("row_id", _joined(parse_list_tolerant(F.col("predicted_actors"))).alias("actors"),
                     F.size(parse_list_strict(F.col("predicted_actors"))).alias("n_actors"))


def q_clean_edges(spark, sf):
    """C1 + C2 where there is something to fill: null clauses and null lists."""
    raw = tables.edge_clauses(spark, sf).withColumn("as_text", F.col("clause"))
    df = clean.text_column(clean.fill_missing(raw), "as_text", "nan")
    return df.select("row_id", F.length("clause").cast("bigint").alias("clause_chars"), "predicted_actors",
                     F.md5("as_text").alias("text_md5"))


def q_parse_edges(spark, sf):
    """C4 + T11: lists of every odd form, wrapped, stripped or given up on."""
    df = tables.edge_clauses(spark, sf)
    p = parse_list(F.col("predicted_actors"))
    return df.select("row_id", _joined(F.coalesce(p["items"], F.array().cast("array<string>"))).alias("actors"),
                     F.coalesce(p["status"], F.lit(-1)).alias("status"))


# --- step 2: sampling and split ----------------------------------------------

def q_sample_exact(spark, sf):
    """P1 + P2: exactly SAMPLE_N rows, seed 42, no replacement."""
    s = P.sample_exact(tables.table(spark, sf, "documents"), SAMPLE_N, key="doc_id")
    return s.select(F.col("doc_id").alias("row_id"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def q_first_n(spark, sf):
    """The first FIRST_N rows by key."""
    s = P.first_n(tables.table(spark, sf, "documents"), FIRST_N, key="doc_id")
    return s.select(F.col("doc_id").alias("row_id"), "lang")


def q_split_hash(spark, sf):
    """P4 (hash bucket): train/test side of every row."""
    docs = tables.table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"))
    train, test = P.split_hash(docs)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def q_split_exact(spark, sf):
    """P4 (exact): ceil(20 %) rows in test by the seeded order."""
    docs = tables.table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"))
    train, test = P.split_exact(docs)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def q_first_n_turns(spark, sf):
    """P3 on a composite key: the first FIRST_N turns by (conv_id, turn)."""
    return P.first_n(_turns(spark, sf), FIRST_N, "turn_key").select("turn_key.conv_id", "turn_key.turn", F.length("clause").cast("bigint").alias("chars"))


def q_split_turns(spark, sf):
    """P4 (exact) on a composite key, ordered by a hash of "conv_id/turn"."""
    turns = _turns(spark, sf).select(F.concat_ws("/", "turn_key.conv_id", "turn_key.turn").alias("row_id"))
    train, test = P.split_exact(turns)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


# --- step 3: labels and joins -------------------------------------------------

def _gold(spark, sf):
    return tables.gold_actors(tables.table(spark, sf, "documents"), tables.table(spark, sf, "labels")).select("row_id", "actors")


def q_label_vocab(spark, sf):
    """L1 + L4 + P5: sorted vocabulary with dense ids."""
    c = tables.clauses(spark, sf).select(parse_list_strict(F.col("actors_text")).alias("actors"))
    return L.labels_in_id_order(L.vocabulary(c, "actors"))


def q_multi_hot(spark, sf):
    """L2 + J1: sparse ids and the dense 0/1 vector per row."""
    vocab, k = _vocab(spark, sf)
    ids = L.multi_hot(L.with_label_ids(_gold(spark, sf), vocab, vocab_rows=k), k)
    return ids.select("row_id", _joined("label_ids").alias("label_ids"), _joined("labels", ",").alias("labels"))


def q_multi_hot_joined(spark, sf):
    """L2 + J1 by joins: the path of a vocabulary too large to travel with the rows."""
    vocab, k = _vocab(spark, sf)
    return L.label_ids(_gold(spark, sf), vocab, vocab_rows=k).select("row_id", _joined("label_ids").alias("label_ids"))


def q_label_wide(spark, sf):
    """L3 + J6: one 0/1 column per label beside the key, shown as one text in label order."""
    vocab, k = _vocab(spark, sf)
    names = L.label_names(vocab, k)
    wide = L.label_wide(_gold(spark, sf), names)
    return wide.select("row_id", F.concat_ws(",", *[F.concat(F.lit(f"{n}="), F.col(f"`{n}`")) for n in names]).alias("labels"))


def q_label_cells(spark, sf):
    """L3, long: a row per label that a document has."""
    return L.label_cells(_gold(spark, sf), _vocab(spark, sf)[0])


def _warm(spark, sf):
    new_vocab, _ = _vocab(spark, sf)
    docs = tables.table(spark, sf, "documents")
    old_vocab = L.vocabulary(docs.select(F.array("lang").alias("actors")), "actors")
    warm = tables.cooccurrence_warm_map(spark, sf)
    return new_vocab, old_vocab, warm


def q_warm_pairs(spark, sf):
    """M1 + J4: usable warm-start pairs (both ends exist)."""
    new_vocab, old_vocab, warm = _warm(spark, sf)
    return L.warm_pairs(warm, new_vocab, old_vocab)


def q_warm_skipped(spark, sf):
    """M2 + J5: names of the map that were dropped."""
    new_vocab, old_vocab, warm = _warm(spark, sf)
    return L.warm_skipped(warm, new_vocab, old_vocab)


def q_warm_copy(spark, sf):
    """M3: new head with mapped rows (weights and bias) copied from the old head."""
    new_vocab, old_vocab, warm = _warm(spark, sf)
    pairs = L.warm_pairs(warm, new_vocab, old_vocab)
    out = L.warm_copy(scoring.hash_head(new_vocab), scoring.hash_head(old_vocab, salt="old"), pairs)
    return out.select("label_id", "label", "feature", _r6("weight").alias("weight"))


# --- step 4: windows ---------------------------------------------------------

def _labelled(spark, sf):
    """``(row_id, clause, label_ids)`` of every document, vocabulary, head and sizes."""
    vocab, head, sizes = _vocab_head(spark, sf)
    c = tables.clauses(spark, sf).select("row_id", "clause", "actors")
    return L.with_label_ids(c, vocab, vocab_rows=sizes["vocab_rows"]).drop("actors"), vocab, head, sizes


def q_windows_fixed(spark, sf):
    """T1 + T2 + T3 + T4: training windows with padding, mask and the clause's label ids."""
    rows, _, _, _ = _labelled(spark, sf)
    wins = W.pad_windows(pipelines.training_windows(rows))
    return wins.select("row_id", F.col("window").cast("int").alias("window"), "n_tokens",
                       _joined("input_ids", " ").alias("input_ids"),
                       F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
                       _joined("label_ids").alias("label_ids"))


def q_windows_overlap(spark, sf):
    """T1 + T5 + T3: prediction windows with their own specials."""
    wins = W.pad_windows(W.overlap_windows(W.with_token_ids(tables.documents(spark, sf))))
    return wins.select("row_id", F.col("window").cast("int").alias("window"), "n_tokens",
                       _joined("input_ids", " ").alias("input_ids"))


# --- step 5: metrics -----------------------------------------------------------

def _eval_logits(spark, sf):
    rows, _, head, sizes = _labelled(spark, sf)
    return pipelines.clause_logits(rows, head, keep=("label_ids",), head_rows=sizes["head_rows"], null_text=None, windowing="fixed"), sizes["vocab_rows"]


def _eval_counts(spark, sf):
    return M.confusion_counts(_eval_logits(spark, sf)[0])


def q_confusion(spark, sf):
    """E1 + E2: confusion counts over all (window, label) cells."""
    return _eval_counts(spark, sf).drop("loss_sum")


def _rounded(m: DataFrame) -> DataFrame:
    return m.select(*[_r6(c).alias(c) for c in m.columns])


def q_macro_metrics(spark, sf):
    """Accuracy and macro precision / recall / F1 over cells."""
    return _rounded(M.macro_metrics(_eval_counts(spark, sf)))


def q_metrics_file(spark, sf):
    """The metrics written as JSON and read back."""
    path = scratch_path(spark, "metrics")
    m = M.macro_metrics(_eval_counts(spark, sf))
    io.write_json_row(m, path)
    return _rounded(spark.read.schema(m.schema).json(path))


def q_clause_metrics(spark, sf):
    """E1-E3 at clause level: pooled decisions (threshold, else argmax) against the gold labels."""
    rows, _, head, sizes = _labelled(spark, sf)
    scored = pipelines.clause_logits(rows, head, keep=("label_ids",), head_rows=sizes["head_rows"])
    done = scored.select("row_id", "label_ids", G.decided_ids(G.pooled(F.col("logits"), sizes["vocab_rows"])).alias("decided_ids"))
    return _rounded(M.macro_metrics(M.confusion_from_pred(M.clause_cells(done, sizes["vocab_rows"]))))


def q_bce_loss(spark, sf):
    """Mean binary cross-entropy with logits."""
    b = M.mean_loss(_eval_counts(spark, sf))
    return b.select(_r6("loss").alias("loss"), "n_cells")


def q_hooked_macro(spark, sf):
    """U4 + E3: the macro metrics as a caller's own metric, merged in a tree."""
    scored, k = _eval_logits(spark, sf)
    return _rounded(hooks.measured(scored, hooks.macro(k), k))


def q_label_f1(spark, sf):
    """U4: precision, recall and F1 of every label as a caller's own metric."""
    scored, k = _eval_logits(spark, sf)
    m = hooks.measured(scored, hooks.label_f1(k), k)
    return m.select("label_id", *[_r6(c).alias(c) for c in ("precision", "recall", "f1")])


# --- step 6: stance ------------------------------------------------------------

def _prepared(spark, sf):
    return Z.prepare(tables.stance_input(spark, sf))


def q_stance_templates(spark, sf):
    """J3 + T7 + Z1: every (clause, actor) pair over every template, rendered."""
    h = Z.hypotheses(_prepared(spark, sf))
    return h.select("row_id", F.col("pos").cast("int").alias("pos"), "stance", F.col("template_id").cast("int").alias("template_id"), "hypothesis")


def q_stance_templates_first(spark, sf):
    """The first version's templates, rendered."""
    h = Z.hypotheses(_prepared(spark, sf), Z.TEMPLATES_FIRST_VERSION)
    return h.select("row_id", F.col("pos").cast("int").alias("pos"), "stance", F.col("template_id").cast("int").alias("template_id"), "hypothesis")


def _scores_flat(sc: DataFrame) -> DataFrame:
    return sc.select("row_id", F.col("pos").cast("int").alias("pos"), "stance",
                     F.col("template_id").cast("int").alias("template_id"), _r6("score").alias("score"))


def q_pair_scores(spark, sf):
    """Entailment score of every scored (premise, hypothesis) pair, whole texts."""
    return _scores_flat(Z.template_scores(_prepared(spark, sf)))


def q_pair_scores_general(spark, sf):
    """The same scores by the scorer for templates of any shape."""
    return _scores_flat(Z.template_scores(_prepared(spark, sf), hoist=False))


def q_stance_pairs(spark, sf):
    """Z3 + A2 + P7 + A5 + C9: stance and mean scores per (clause, actor)."""
    s = Z.stance_pairs(_prepared(spark, sf))
    return s.select("row_id", F.col("pos").cast("int").alias("pos"), "actor", "stance",
                    *[_r6(c).alias(c) for c in ("positive", "negative", "neutral")])


def _lists_flat(df: DataFrame) -> DataFrame:
    return df.select("row_id", _joined("predicted_sentiments").alias("predicted_sentiments"),
                     _joined(F.transform("sentiment_scores", lambda s: F.format_string(
                         "%.6f/%.6f/%.6f", s["positive"], s["negative"], s["neutral"]))).alias("sentiment_scores"))


def q_stance_lists(spark, sf):
    """Z4 + A3: stance lists parallel to each clause's actor list, attached to the rows; whole texts."""
    return _lists_flat(Z.stance(tables.stance_input(spark, sf)))


def q_stance_first_version(spark, sf):
    """Z1 + Z4: stance with the first version's templates."""
    return _lists_flat(Z.stance(tables.stance_input(spark, sf), templates=Z.TEMPLATES_FIRST_VERSION))


def q_stance_cut(spark, sf):
    """C5 + Z4: stance of premises cut to 2,000 characters, the feature of the later version."""
    return _lists_flat(Z.stance(tables.stance_input(spark, sf), max_chars=CUT_CHARS))


def q_stance_truncated(spark, sf):
    """T8 + Z5 + Z4: premises truncated to a model's limit of 64 tokens beside the hypothesis."""
    return _lists_flat(Z.stance(tables.stance_input(spark, sf), max_length=512, model_max_length=MODEL_LENGTH))


def q_stance_edges(spark, sf):
    """C9 + Z6 + C4: stance where clauses and lists are null, empty, odd or unreadable."""
    return _lists_flat(Z.stance(tables.edge_clauses(spark, sf)))


def q_stance_pair_model(spark, sf):
    """Z2 (plug-in) + U2 + U5: stance lists through the batch entailment-model surface."""
    out = Z.stance(tables.stance_input(spark, sf), pair_model=scoring.overlap_pair_model, batch_size=64)
    return _lists_flat(out)


def q_stance_distinct(spark, sf):
    """Z2 + Z4: stance lists by a plug-in model that scores each different pair of the table once."""
    return _lists_flat(pairs.stance_distinct(tables.stance_input(spark, sf), scoring.overlap_pair_model, batch_size=64))


def q_distinct_pair_calls(spark, sf):
    """Different (premise, actor) pairs of the table, the places they stand in, and how often the model was given one."""
    found = pairs.distinct_scores(tables.stance_input(spark, sf), scoring.overlap_pair_model, batch_size=64)
    calls = F.aggregate("calls", F.lit(0).cast("long"), lambda a, c: a + c)
    return found.agg(F.count(F.lit(1)).alias("pairs"), F.coalesce(F.sum("rows"), F.lit(0)).alias("places"),
                     F.coalesce(F.sum(calls), F.lit(0)).alias("calls"))


def _weak_pair_model():
    """The overlap model with its entailment logit in column 2; it cannot score "unfavorable"."""
    import numpy as np

    fn = scoring.overlap_pair_model()

    def weak(premises, hypotheses, max_length):
        if any("unfavorable" in h for h in hypotheses):
            raise RuntimeError("no score for such a pair")
        return np.roll(fn(premises, hypotheses, max_length), 2, axis=1)

    return weak


def q_stance_failing_model(spark, sf):
    """Z6 + T10: pairs that the model cannot score count 0.0 in their stance's mean."""
    out = Z.stance(tables.stance_input(spark, sf), pair_model=_weak_pair_model, entail_idx=2)
    return _lists_flat(out)


def q_stance_tagged(spark, sf):
    """Both stages in one pass over the rows: tag every document, then the stance of each predicted actor."""
    vocab, head, sizes = _vocab_head(spark, sf)
    return _lists_flat(Z.stance(pipelines.tag(tables.documents(spark, sf), head, vocab, **sizes, keep=("clause",))))


# --- step 7: sinks -------------------------------------------------------------

def q_roundtrip(spark, sf):
    """U6 + S1-S5 + T12 + V1 + V2 + C1: the stance entry from a CSV file to a CSV file and its second copy, read from the copy."""
    import re

    from pyspark.sql import types as T
    source, path = scratch_path(spark, "stance-in"), scratch_path(spark, "stance-csv")
    rows = tables.stance_input(spark, sf)
    io.write_csv(rows, source)
    report = pipelines.stance_file(spark, source, path, rows.schema)
    if not re.fullmatch(re.escape(path) + r"_backup_\d{8}_\d{6}", report["backup"]):
        raise RuntimeError(f"unexpected name of the copy: {report['backup']}")
    schema = T.StructType([*rows.schema.fields, T.StructField("predicted_sentiments", T.StringType()),
                           T.StructField("sentiment_scores", T.StringType())])
    back = io.read_csv(spark, report["backup"], schema)
    sents = F.from_json("predicted_sentiments", "array<string>")
    return back.select("row_id", F.md5(F.coalesce("clause", F.lit(""))).alias("clause_md5"),
                       _joined(sents).alias("predicted_sentiments"))


def q_csv_types(spark, sf):
    """Documents and their labels written as CSV and read back without a schema: each column's type, values and sum."""
    rows = (tables.table(spark, sf, "documents").join(tables.table(spark, sf, "labels").dropDuplicates(["doc_id"]), "doc_id", "left")
            .select("doc_id", "text", "lang", F.length("text").alias("chars"), "quality", (F.col("doc_id") / 8).alias("eighth"),
                    (F.col("doc_id") % 2 == 0).alias("even"), F.lit(None).cast("string").alias("nothing")))
    path = scratch_path(spark, "typed-csv")
    io.write_csv(rows, path)
    back = io.read_csv(spark, path)
    out = []
    for name, kind in back.dtypes:
        number = F.col(name).cast("double") if kind in ("bigint", "double", "boolean") else F.length(name).cast("double")
        out.append(F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"), F.count(name).alias("n"), _r6(F.coalesce(F.sum(number), F.lit(0.0))).alias("total")))
    return back.agg(F.array(*out).alias("columns")).select(F.explode("columns").alias("c")).select("c.*")


def q_published(spark, sf):
    """S3 + S4: a table published twice, the second version read; a third that fails leaves it in place."""
    from pyspark.errors import PySparkException

    path, docs = scratch_path(spark, "published"), tables.table(spark, sf, "documents").select("doc_id", "text", F.array("lang", "source").alias("tags"))
    io.publish(docs.limit(1), path)
    io.publish(docs, path)
    try:
        io.publish(docs.withColumn("text", F.when(F.col("doc_id") >= 0, F.raise_error(F.lit("no text")))), path)
    except PySparkException:
        pass
    back = io.read_published(spark, path)
    return back.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), _joined("tags").alias("tags"))


def q_head_roundtrip(spark, sf):
    """S8 + S9: vocabulary and head written as parquet and read back."""
    vocab, head, _ = _vocab_head(spark, sf)
    vp, hp = scratch_path(spark, "vocab"), scratch_path(spark, "head")
    io.write_table(vocab, vp)
    io.write_table(head, hp)
    v, h = io.read_table(spark, vp), io.read_table(spark, hp)
    return h.join(v, ["label_id", "label"]).select("label_id", "label", "feature", _r6("weight").alias("weight"))


# --- step 8: fitting -----------------------------------------------------------

def _fitted(spark, sf):
    c = tables.clauses(spark, sf)
    return pipelines.fit_tagger(c.select("row_id", "clause", F.col("actors_text").alias("regularized_actors")),
                                epochs=FIT_EPOCHS, steps_per_epoch=FIT_STEPS)


def q_fit_head(spark, sf):
    """F1 + F2 + F3: fit a head on the 80 % side, evaluate each epoch on the 20 % side."""
    e = _fitted(spark, sf)["epochs"]
    return e.select("epoch", *[_r6(c).alias(c) for c in ("loss", "accuracy", "f1", "precision", "recall")], "best")


def q_best_epoch(spark, sf):
    """The best epochs of that fit, in order."""
    return H.best_epoch(_fitted(spark, sf)["epochs"]).select("epoch", F.col("rank").cast("int").alias("rank"))


def _fit_clauses(spark, sf):
    return tables.clauses(spark, sf).select("row_id", "clause", F.col("actors_text").alias("regularized_actors"))


def _epochs(e: DataFrame) -> DataFrame:
    return e.select("epoch", *[_r6(c).alias(c) for c in ("loss", "accuracy", "f1", "precision", "recall")], "best")


def q_fit_sharded(spark, sf):
    """the same fit with the weights in shards, never broadcast."""
    fit = {"max_cells": 0, "block_cells": SHARD_CELLS}
    return _epochs(pipelines.fit_tagger(_fit_clauses(spark, sf), epochs=FIT_EPOCHS, steps_per_epoch=FIT_STEPS, fit=fit)["epochs"])


def q_fit_weighted(spark, sf):
    """The same fit under a caller's loss, in which a true label counts twice."""
    fit = {"loss": H.weighted_bce(POSITIVE)}
    return _epochs(pipelines.fit_tagger(_fit_clauses(spark, sf), epochs=FIT_EPOCHS, steps_per_epoch=FIT_STEPS, fit=fit)["epochs"])


def q_fit_resumed(spark, sf):
    """P8 + S9: the same fit ended after its second epoch, then taken up from the stored state."""
    t, state = pipelines.fit_tables(_fit_clauses(spark, sf)), scratch_path(spark, "fit-state")
    options = dict(evaluation=t["test"], epochs=FIT_EPOCHS, steps_per_epoch=FIT_STEPS, state=state)
    H.fit(t["train"], t["init"], until=2, **options)
    return _epochs(H.fit(t["train"], t["init"], **options)[1])


def q_fit_batches(spark, sf):
    """F1 + F3: a fit by exact batches of a third of the windows, in another order every epoch."""
    t = pipelines.fit_tables(_fit_clauses(spark, sf))
    size = -(-t["train"].count() // BATCH_STEPS)
    return _epochs(H.fit(t["train"], t["init"], evaluation=t["test"], epochs=BATCH_EPOCHS, batch_size=size)[1])


def q_mini_batches(spark, sf):
    """the batch of every training window in two epochs."""
    train = pipelines.fit_tables(_fit_clauses(spark, sf))["train"]
    out = None
    for epoch in range(1, BATCH_EPOCHS + 1):
        rows = B.Order(train, B.SEED, epoch).numbered().select(
            F.lit(epoch).alias("epoch"), F.floor(F.col("number") / BATCH_SIZE).cast("bigint").alias("batch"),
            F.split("key", ":")[0].cast("bigint").alias("row_id"), F.split("key", ":")[1].cast("int").alias("window"))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_train_tag_stance(spark, sf):
    """The three stages end to end: fit a head on the documents' gold lists, tag every
    document with it, then the stance of each predicted actor."""
    fitted = _fitted(spark, sf)
    out = Z.stance(pipelines.tag(tables.documents(spark, sf), fitted["head"], fitted["vocab"], keep=("clause",)))
    return out.select("row_id", _joined("predicted_actors").alias("predicted_actors"), _joined("predicted_sentiments").alias("predicted_sentiments"))


QUERIES: dict[str, Query] = {
    "tag_documents": q_tag_documents,
    "tag_by_path": q_tag_by_path,
    "csv_types": q_csv_types,
    "published": q_published,
    "tag_balanced": q_tag_balanced,
    "balanced_loads": q_balanced_loads,
    "hooked_macro": q_hooked_macro,
    "label_f1": q_label_f1,
    "stance_distinct": q_stance_distinct,
    "distinct_pair_calls": q_distinct_pair_calls,
    "fit_sharded": q_fit_sharded,
    "fit_weighted": q_fit_weighted,
    "fit_resumed": q_fit_resumed,
    "fit_batches": q_fit_batches,
    "mini_batches": q_mini_batches,
    "tag_joined": q_tag_joined,
    "tag_sample": q_tag_sample,
    "tag_batch_udf": q_tag_batch_udf,
    "tag_foreign_tokenizer": q_tag_foreign_tokenizer,
    "tag_failed_rows": q_tag_failed_rows,
    "tag_benchmark": q_tag_benchmark,
    "tag_conversations": q_tag_conversations,
    "tag_probs": q_tag_probs,
    "clean_fill": q_clean_fill,
    "cut_text": q_cut_text,
    "profile": q_profile,
    "preview": q_preview,
    "parse_actors": q_parse_actors,
    "clean_edges": q_clean_edges,
    "parse_edges": q_parse_edges,
    "sample_exact": q_sample_exact,
    "first_n": q_first_n,
    "split_hash": q_split_hash,
    "split_exact": q_split_exact,
    "first_n_turns": q_first_n_turns,
    "split_turns": q_split_turns,
    "label_vocab": q_label_vocab,
    "multi_hot": q_multi_hot,
    "multi_hot_joined": q_multi_hot_joined,
    "label_wide": q_label_wide,
    "label_cells": q_label_cells,
    "warm_pairs": q_warm_pairs,
    "warm_skipped": q_warm_skipped,
    "warm_copy": q_warm_copy,
    "windows_fixed": q_windows_fixed,
    "windows_overlap": q_windows_overlap,
    "confusion": q_confusion,
    "macro_metrics": q_macro_metrics,
    "metrics_file": q_metrics_file,
    "clause_metrics": q_clause_metrics,
    "bce_loss": q_bce_loss,
    "stance_templates": q_stance_templates,
    "stance_templates_first": q_stance_templates_first,
    "pair_scores": q_pair_scores,
    "pair_scores_general": q_pair_scores_general,
    "stance_pairs": q_stance_pairs,
    "stance_lists": q_stance_lists,
    "stance_first_version": q_stance_first_version,
    "stance_cut": q_stance_cut,
    "stance_truncated": q_stance_truncated,
    "stance_edges": q_stance_edges,
    "stance_pair_model": q_stance_pair_model,
    "stance_failing_model": q_stance_failing_model,
    "stance_tagged": q_stance_tagged,
    "roundtrip": q_roundtrip,
    "head_roundtrip": q_head_roundtrip,
    "fit_head": q_fit_head,
    "best_epoch": q_best_epoch,
    "train_tag_stance": q_train_tag_stance,
}
