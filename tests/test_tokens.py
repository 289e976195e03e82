"""The default tokenizer in a Python worker gives the ids of the column expression, hashing a word once."""

from pyspark.sql import functions as F

from clausework.functions.text import token_ids
from clausework.operators import scoring, windows as W
from clausework.plans import pipelines

TEXTS = ["", None, " \t\n\r ", "The the THE", "a\x0bb\x0cc d", "Straße ÄÖ İI ΟΔΟΣ 日本　語", "x y z \x1cw", "w" * 200 + " " + "w" * 200, "\x0b \x0c", "nul\x00l ok",
         " ".join(f"w{i % 700}" for i in range(1500))]


def _texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "row_id long, clause string").repartition(2)


def test_the_same_ids(spark):
    both = _texts(spark).select("row_id", token_ids(F.col("clause")).alias("a")), _texts(spark).select("row_id", W.word_token_ids(F.col("clause")).alias("b"))
    rows = both[0].join(both[1], "row_id").collect()
    assert len(rows) == len(TEXTS) and all(r.a == r.b for r in rows)


def test_the_words_kept_are_bounded(monkeypatch):
    monkeypatch.setattr(W, "WORDS", 4)
    encode = W.make_word_ids()
    text = b" ".join(b"%d" % (i % 9) for i in range(90))
    assert encode(text).tolist() == [W.make_word_ids()(b"%d" % (i % 9))[0] for i in range(90)]


def test_a_word_is_hashed_once(monkeypatch):
    hashed = []
    real = W.hashlib.md5
    monkeypatch.setattr(W.hashlib, "md5", lambda w, **options: hashed.append(w) or real(w, **options))
    encode = W.make_word_ids()
    for _ in range(5):
        encode(b"one two one")
    assert hashed == [b"one", b"two"]


def test_logits_need_no_hash_in_the_plan(spark):
    """Tagging's words are found where they are scored: no expression hashes them, and the logits stay what they were."""
    vocab = spark.createDataFrame([(0, "A"), (1, "B")], "label_id int, label string")
    head = scoring.hash_head(vocab, n_features=64)
    got = pipelines.clause_logits(_texts(spark), head)
    assert "md5" not in got._jdf.queryExecution().optimizedPlan().toString()
    ids = _texts(spark).select("row_id", token_ids(F.coalesce("clause", F.lit("nan"))).alias("ids"))
    model = scoring.linear_predict_fn(spark, *scoring.head_arrays(head))
    want = ids.select("row_id", scoring.window_logits(F.col("ids"), model).alias("logits"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_a_window_does_not_build_its_text_again(spark):
    """The whole sequence is bound once, outside the function that cuts windows."""
    df = spark.createDataFrame([(1, list(range(3, 1200)))], "row_id long, ids array<int>")
    wins = W.fixed_step_windows(df)
    plan = wins._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat(") == 1
    full = [1, *range(3, 1200), 2]
    assert [r.window_ids for r in wins.orderBy("window").collect()] == [full[s:s + 512] for s in range(0, len(full), 256)]


def test_training_windows_of_texts_in_one_pass(spark, monkeypatch):
    """Texts give the window rows that their training windows give, and the fit's tables send no token to the JVM."""
    from clausework.operators import head as H

    rows = _texts(spark).withColumn("label_ids", F.when(F.col("row_id") % 2 == 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    shape = lambda x: sorted((r.key, r.part, r.features, r.counts, r.labels) for r in x.collect())
    ids = rows.select("row_id", "label_ids", token_ids(F.col("clause")).alias("ids"))
    want = H.window_rows(W.fixed_step_windows(ids, keep=("row_id", "label_ids")), 50)
    got = H.text_rows(rows, 50)
    assert shape(got) == shape(want) and got.schema == want.schema
    assert got.agg(F.countDistinct("win")).first()[0] == want.count()
    plans = []
    real = H.stored
    monkeypatch.setattr(H, "stored", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, name))
    pipelines.fit_tables(spark.createDataFrame([(i, "one two", "['A']") for i in range(20)], "row_id long, clause string, regularized_actors string"))
    assert len(plans) == 2 and not any("Generate" in p or "regexp_extract_all(lower" in p for p in plans)


def test_probabilities_score_a_text_once(spark, sf_small):
    """Unfolding the probabilities adds no second pass of the scorer."""
    from clausework.plans.queries import QUERIES

    plan = QUERIES["tag_probs"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_a_vocabulary_parses_a_list_once(spark, monkeypatch):
    """Finding the labels adds no filter that parses every list again."""
    from clausework.functions.lists import parse_list_strict
    from clausework.operators import labels as L

    rows = spark.createDataFrame([(1, "['B', 'A']"), (2, "[]"), (3, "['A']")], "row_id long, actors_text string")
    plans = []
    real = L.dense_ids_sized

    def seen(df, *a):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, *a)

    monkeypatch.setattr(L, "dense_ids_sized", seen)
    vocab, n = L.vocabulary_sized(rows.select("row_id", parse_list_strict(F.col("actors_text")).alias("actors")), "actors")
    assert n == 2 and [(r.label_id, r.label) for r in vocab.orderBy("label_id").collect()] == [(0, "A"), (1, "B")]
    assert "Filter" not in plans[0]
