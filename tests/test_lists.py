"""List-literal parsing: edge vectors and fast path == Python grammar."""

import ast

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clausework.functions.lists import FAILED, OK, WRAPPED, FALLBACK, is_fast_list, parse_list, parse_list_tolerant, write_list

CASES = [
    ("['a', 'b']", ["a", "b"], OK),
    (" ['a', 'b']", ["a", "b"], OK),
    ("['a',]", ["a"], OK),
    ("['a'] # c", ["a"], OK),
    ("[\"it's\", 'x']", ["it's", "x"], OK),
    ("['it\\'s']", ["it's"], OK),
    ("['a' 'b']", ["ab"], OK),
    ("[]", [], OK),
    ("[1, 2]", ["1", "2"], OK),
    ("('a','b')", ["('a', 'b')"], WRAPPED),
    ("5", ["5"], WRAPPED),
    ("None", ["None"], WRAPPED),
    ("''", [""], WRAPPED),
    ("a,b", ["a,b"], FALLBACK),
    ("[a]", ["a"], FALLBACK),
    ("[null]", ["null"], FALLBACK),
    ("[true]", ["true"], FALLBACK),
    ("", ["Unknown"], FALLBACK),
    ("['x\ny']", ["x\ny"], FALLBACK),
    ("{[]:1}", ["Unknown"], FAILED),
]


def test_edge_vectors(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(CASES)], "i int, t string")
    got = {r["i"]: r for r in df.select("i", parse_list(F.col("t")).alias("p")).collect()}
    for i, (text, items, status) in enumerate(CASES):
        assert got[i]["p"]["items"] == items, text
        assert got[i]["p"]["status"] == status, text


def test_null_is_empty_list(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(parse_list_tolerant(F.col("t")).alias("x")).first()["x"] == []


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\\'\"\n\r\x00"), max_size=8),
                max_size=5),
       st.sampled_from(["'", '"']), st.booleans())
def test_fast_path_equals_literal_grammar(spark, items, quote, trailing):
    text = "[" + ", ".join(f"{quote}{x}{quote}" for x in items if quote not in x) + ("," if trailing and items else "") + "]"
    expected = [str(v) for v in ast.literal_eval(text)]
    row = spark.createDataFrame([(text,)], "t string").select(
        parse_list(F.col("t")).alias("p"), is_fast_list(F.col("t")).alias("fast")).first()
    assert row["p"]["items"] == expected


def test_written_lists_read_back(spark):
    items = ["Cote d'Ivoire", "B", "a\\b", "line\nbreak", "\r", 'say "hi"', "", "[x]", "é😀", "\\'", "tab\there"]
    df = spark.createDataFrame([(1, items), (2, []), (3, None), (4, items[:1])], "i int, a array<string>")
    for r in df.select("i", "a", write_list(F.col("a")).alias("t"), parse_list_tolerant(write_list(F.col("a"))).alias("back")).collect():
        assert r["t"] is None if r["a"] is None else ast.literal_eval(r["t"]) == r["a"] == r["back"]
