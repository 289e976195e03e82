"""Stance rules: guards, ties, order, empty and repeated actors; hoisted == general scorer."""

import pytest
from pyspark.sql import functions as F

from clausework.operators import scoring, stance as Z
from clausework.sources import tables


def _lists(spark, rows, **kw):
    df = spark.createDataFrame(rows, "row_id long, clause string, predicted_actors string")
    out = Z.stance(df, **kw).orderBy("row_id").collect()
    return {r["row_id"]: (r["predicted_sentiments"], [tuple(s) for s in r["sentiment_scores"]]) for r in out}


def test_guards_and_shapes(spark):
    got = _lists(spark, [
        (1, "", "['A']"),                       # empty clause -> neutral, {0,0,1}
        (2, "text", "[]"),                      # no actor -> empty lists
        (3, "text", None),                      # null list -> "[]"
        (4, "x y", "['A', 'A']"),               # repeated actor: both positions kept
        (5, "x", "{[]:1}"),                     # unreadable -> clause "", ["Unknown"] -> neutral
        (6, None, "['A']"),                     # null clause -> "" -> neutral
        (7, "x", "''"),                         # one empty actor -> neutral
    ])
    assert got[1] == (["neutral"], [(0.0, 0.0, 1.0)])
    assert got[2] == ([], []) and got[3] == ([], [])
    assert len(got[4][0]) == 2
    assert got[5] == (["neutral"], [(0.0, 0.0, 1.0)])
    assert got[6] == (["neutral"], [(0.0, 0.0, 1.0)])
    assert got[7] == (["neutral"], [(0.0, 0.0, 1.0)])


def test_tie_goes_to_first_stance_and_order(spark):
    got = _lists(spark, [(1, "nothing in common", "['Zed']"),
                         (2, "comments about zed are unfavorable. the tone regarding zed is unsupportive. negative.",
                          "['Zed', 'Other']")])
    assert got[1][0] == ["positive"]            # all equal -> positive
    assert got[2][0][0] == "negative"
    assert len(got[2][0]) == 2


def test_custom_templates_negative_beats_equal_zeros(spark):
    templates = [("positive", "pos {actor}"), ("negative", "neg {actor}"), ("neutral", "neu {actor}")]
    got = _lists(spark, [(1, "neg", "['q']")], templates=templates)
    assert got[1][0] == ["negative"]


def test_hypothesis_longer_than_budget_scores_zero(spark):
    got = _lists(spark, [(1, "a b c", "['a b c']")], max_length=5)
    assert got[1] == (["positive"], [(0.0, 0.0, 0.0)])


def test_cut_at_2000_chars(spark):
    from clausework.functions.text import cut_text
    df = spark.createDataFrame([("a" * 2000,), ("a" * 2001,)], "t string")
    got = [r[0] for r in df.select(cut_text(F.col("t"))).collect()]
    assert got == ["a" * 2000, "a" * 2000 + "..."]


@pytest.mark.parametrize("max_length", [None, 40])
def test_hoisted_equals_general(spark, sf_small, max_length):
    p = Z.prepare(tables.stance_input(spark, sf_small))
    cols = ["row_id", "pos", "stance", "template_id", "score"]
    a = Z.template_scores(p, max_length=max_length, hoist=True).select(*cols)
    b = Z.template_scores(p, max_length=max_length, hoist=False).select(*cols)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_whole_texts_are_read(spark):
    """A word behind the 2,000th character and the 512th token counts, unless a limit is asked for."""
    text = "filler " * 3000 + "unfavorable. comments"
    df = spark.createDataFrame([(1, text, "['Zed']")], "row_id long, clause string, predicted_actors string")
    assert Z.stance(df).first()["predicted_sentiments"] == ["negative"]
    assert Z.stance(df, max_chars=2000).first()["predicted_sentiments"] == ["positive"]
    assert Z.stance(df, max_length=512).first()["predicted_sentiments"] == ["positive"]


def test_output_length_equals_actor_count(spark, sf_small):
    src = tables.stance_input(spark, sf_small)
    out = Z.stance(src)
    bad = out.where(F.size("predicted_sentiments") != F.size(F.from_json("predicted_actors", "array<string>")))
    assert bad.count() == 0


def test_limit_n_and_model_max_length(spark):
    rows = [(i, "comments about a are favorable.", "['a']") for i in range(5)]
    df = spark.createDataFrame(rows, "row_id long, clause string, predicted_actors string")
    out = Z.stance(df, limit_n=2).collect()
    assert sorted(r["row_id"] for r in out) == [0, 1]
    # a model limit of 5 tokens leaves no room for any hypothesis: every template fails -> 0.0
    r = Z.stance(df, model_max_length=5, limit_n=1).first()
    assert [tuple(s) for s in r["sentiment_scores"]] == [(0.0, 0.0, 0.0)]
    assert Z.effective_max_length(8192, 512) == 512 and Z.effective_max_length(None, 512) == 512


def test_lists_equal_pairs(spark, sf_small):
    src = tables.stance_input(spark, sf_small)
    lists = {r[0]: (r[1], [tuple(x) for x in r[2]]) for r in Z.stance(src, attach=False).collect()}
    pairs = {}
    for r in Z.stance_pairs(Z.prepare(src)).orderBy("row_id", "pos").collect():
        got = pairs.setdefault(r["row_id"], ([], []))
        got[0].append(r["stance"])
        got[1].append((r["positive"], r["negative"], r["neutral"]))
    assert {k: v for k, v in lists.items() if v[0]} == pairs and len(lists) == src.count()


def test_templates_table_and_first_version(spark):
    t = Z.templates_table(spark).orderBy("stance_rank", "template_id").collect()
    assert len(t) == 9 and [r["stance"] for r in t[::3]] == ["positive", "negative", "neutral"]
    # a curly apostrophe has no case, so the first version's templates are hoisted too; other letters are not
    assert Z.hoistable(Z.TEMPLATES_FIRST_VERSION) and not Z.hoistable([("a", "ÄB {actor}")]) and not Z.hoistable([("a", "x{actor}")])
    df = spark.createDataFrame([(1, "comments about zed are unfavorable.", "['Zed']")],
                               "row_id long, clause string, predicted_actors string")
    r = Z.stance(df, templates=Z.TEMPLATES_FIRST_VERSION).first()
    assert r["predicted_sentiments"] == ["negative"]


def test_actor_lists_as_arrays(spark):
    text = spark.createDataFrame([(1, "comments about zed are unfavorable.", "['Zed', 'Other']"), (2, "x", None)],
                                 "row_id long, clause string, predicted_actors string")
    arr = text.withColumn("predicted_actors", F.from_json("predicted_actors", "array<string>"))
    a = {r[0]: (r["predicted_sentiments"], r["sentiment_scores"]) for r in Z.stance(text).collect()}
    b = {r[0]: (r["predicted_sentiments"], r["sentiment_scores"]) for r in Z.stance(arr).collect()}
    assert a == b and a[2] == ([], [])


@pytest.mark.parametrize("hoist", [True, False])
@pytest.mark.parametrize("make", [Z.template_scores, Z.stance_pairs])
def test_plans_name_each_step_once(spark, sf_small, hoist, make):
    """A step's expression is not copied into every later one: the optimized plan stays short."""
    df = make(Z.prepare(tables.stance_input(spark, sf_small)), hoist=hoist, max_length=40)
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 20_000


def test_a_plug_in_model_reads_whole_premises(spark):
    """The words that decide stand behind more than 600 others."""
    filler = " ".join(f"w{i}" for i in range(700))
    rows = [(1, filler + " the tone regarding Rebels is supportive.", "['Rebels']"), (2, filler, "['Rebels']")]
    df = spark.createDataFrame(rows, "row_id long, clause string, predicted_actors string")
    want = {r.row_id: [tuple(s) for s in r.sentiment_scores] for r in Z.stance(df).collect()}
    got = {r.row_id: [tuple(s) for s in r.sentiment_scores] for r in Z.stance(df, pair_model=scoring.overlap_pair_model).collect()}
    assert got == want and got[1][0][0] > 0.3 and got[2][0] == (0.0, 0.0, 0.0)
    cut = Z.stance(df, pair_model=scoring.overlap_pair_model, max_length=512).where("row_id = 1").first().sentiment_scores
    assert tuple(cut[0]) == (0.0, 0.0, 0.0)
