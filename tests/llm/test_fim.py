"""Fill-in-the-middle: memoised chunks against plain line splitting, forms, round trips."""

import hashlib
import random
import re

import pytest

from clausework.llm import fim
from clausework.llm import queries as Q

LINES = re.compile(r"[^\n]*\n|[^\n]+")


def plain(doc_id, text, rate=100, spm=50, seed=7):
    """``(n, form, prefix_chars, middle_chars, output)`` by listing the lines."""
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    lines = LINES.findall(text)
    n = len(lines)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rnd = random.Random(4)
    shared = "".join(rnd.choices("abc é漢\n\n", k=3000))
    out = ["", None, "a", "\n", "\n\n", "a\n", "a\nb", "\r\na b\x0bc\n", "<P>", "x<M>\ny", "<S", "é\n" * 5, "a" * 30_000, "\n" * 9000,
           shared, "x" + shared, shared + shared, "漢" * 5000 + "\nz"]
    return out + ["".join(rnd.choices(["ab", "\n", "é", " ", "word\n"], k=rnd.randint(0, 60))) for _ in range(80)]


@pytest.mark.parametrize("rate, spm", [(100, 50), (40, 0), (0, 50), (100, 100)])
def test_equals_plain_splitting(spark, rate, spm):
    rows = [*enumerate(texts(), -3), (None, "no\nid"), (5, "the\nsame\nid")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = fim.fill_in_middle(df, rate=rate, spm_rate=spm)
    got = out.withColumn("again", fim.restored(out["output"], out["form"])).collect()
    want = {(i, *plain(i, t, rate, spm), t or "") for i, t in rows}
    assert {tuple(r) for r in got} == want and len(got) == len(rows)


def test_chunks_do_not_depend_on_what_is_remembered(monkeypatch):
    monkeypatch.setattr(fim, "SLICE", 700)
    small, large = fim.Chunks(100), fim.Chunks()
    for t in texts():
        b = (t or "").encode()
        ends = fim.chunk_ends(b)
        assert (ends == sorted(set(ends))) and (not b or ends[-1] == len(b))
        for first, second in ((0, 0), (7, 3), (10**9, 12345)):
            assert fim.cut_places(b, first, second, small) == fim.cut_places(b, first, second, large)


def test_shared_text_is_cut_alike():
    rnd = random.Random(1)
    body = bytes(rnd.choices(b"abcdefgh \n", k=40_000))
    cut = lambda b: {b[x:y] for x, y in zip([0, *fim.chunk_ends(b)], fim.chunk_ends(b))}
    one, other = cut(body), cut(b"something else before" + body)
    assert len(one & other) > 0.9 * len(one)


def test_query_equals_plain_splitting(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for i, t in docs:
        n, form, p, m, output = plain(i, t)
        want.add((i, n, form, p, m, sha(output), sha(t or "")))
    got = Q.QUERIES["op13_chunk_memo_fim"](spark, sf_small)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert {tuple(r) for r in got.collect()} == want


def test_empty_table_and_other_columns(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([("k", "a\nb", 1, "x", 2)], "key string, body string, n int, form string, h int")
    assert [tuple(r) for r in fim.fill_in_middle(df, "key", "body").collect()] == [("k", *plain("k", "a\nb"))]
