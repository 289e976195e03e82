"""Operators on pages, vectors and conversations: brute-force checks and defined cases."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clausework.llm import ann, chat, html_text, topk
from clausework.llm import queries as Q

NAN, INF = float("nan"), float("inf")


# pages

PAGES = {
    "": "",
    "plain &lt;text&gt; &amp here": "plain <text> & here",
    "<p>a<p>b &eacute;&#233;&nbsp;  c\n d<br>e": "a\nb éé c d e",
    "<script>if (a<b) {}</script><p>A</p><style>p{}": "A",
    "<html><body><article><p>Hello <b>wor": "Hello wor",
    "<p title=\"a>b\">hi</p><p data-x='\"'>there</p>": "hi\nthere",
    "<ul><li>one<li>two</ul><table><tr><td>c<td>d</table>": "one\ntwo\nc\nd",
    "<!-- <p>no</p> --><![CDATA[x]]><?php y ?><p>yes</p>": "yes",
    "1 < 2 and <3": "1 < 2 and <3",
    "<div><div><p>x<div>y</div>z</p></div></div>": "x\ny\nz",
}

ARTICLE = ["A title", "Long ago, in a land far away, there lived a king. He had, they say, three sons.", "Short.",
           "The eldest, who was strong, went west; the second, who was wise, went east. Nobody knows why."]


def page(before="", after="", inside="", wrap="article"):
    body = f"<h1>{ARTICLE[0]}</h1>{inside}" + "".join(f"<p>{p}</p>" for p in ARTICLE[1:])
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{before}<{wrap}>{body}</{wrap.split()[0]}>{after}</body></html>"


CLUTTER = [
    '<nav><ul><li><a href="/">Home</a></li><li><a href="/x">Things, and more</a></li></ul></nav>',
    '<header><h2>The Site</h2><p>Words, words, words. Always.</p></header>',
    '<div class="cookie-notice"><p>We, and our partners, use cookies. Do you agree? Please, say yes.</p></div>',
    '<div class="ad">Buy this, now. It is cheap, really, and good.</div>',
    '<aside><p>Other stories, older ones, and some that, frankly, nobody reads.</p></aside>',
    '<div id="sidebar"><p>Popular: this, that, and the other thing.</p></div>',
    '<form><p>Your name, please.</p><input name=a><button>Send</button><select><option>x<option>y</select></form>',
    '<section class="comments"><article class="comment"><p>I like it, really, I do. A lot, in fact, more than you think.</p></article></section>',
    '<footer>&copy; somebody &middot; all rights, of course, reserved.</footer>',
    '<noscript>Turn it on, please.</noscript><iframe src=x>no frames, sorry.</iframe><svg><text>pic</text></svg>',
    '<div role="dialog"><p>Sign up, today, for letters.</p></div><div style="display: none"><p>Hidden, from all.</p></div>',
]


@pytest.mark.parametrize("wrap", ["article", "main", 'div class="content"'])
@pytest.mark.parametrize("clutter", [*range(len(CLUTTER)), None])
def test_clutter_goes_and_the_article_stays(wrap, clutter):
    extra = "".join(CLUTTER) if clutter is None else CLUTTER[clutter]
    want = "\n".join(ARTICLE)
    assert html_text.main_text(page(before=extra, wrap=wrap)) == want
    assert html_text.main_text(page(after=extra, wrap=wrap)) == want


def test_a_list_of_links_without_any_name_goes():
    links = "<div><ul>" + "".join(f'<li><a href="/{i}">Some section {i}</a></li>' for i in range(12)) + "</ul></div>"
    assert html_text.main_text(page(before=links, after=links, wrap="div")) == "\n".join(ARTICLE)


TEASERS = "<div>" + "".join(f"<div><div>Teaser {i}</div><span>2 h ago</span></div>" for i in range(8)) + "</div>"
IMPRINT = "<div><div>Site 2020</div></div>"


@pytest.mark.parametrize("before, after", [(TEASERS, IMPRINT), (IMPRINT, TEASERS), (TEASERS, ""), ("", TEASERS)])
def test_scores_decide_where_no_tag_and_no_name_tells(monkeypatch, before, after):
    """Nameless containers of short, unpunctuated lines go by their paths' scores; with equal scores they stay."""
    source, want = page(before=before, after=after, wrap="div"), "\n".join(ARTICLE)
    assert html_text.main_text(source) == want
    monkeypatch.setattr(html_text, "_ratios", lambda blocks: {b.path: 1.0 for b in blocks})
    assert html_text.main_text(source) != want


def test_an_article_tag_is_one_signal_among_others(monkeypatch):
    """A teaser marked up as an article does not win over the text of the page."""
    teasers = "".join(f"<article><div>Teaser {i}</div></article>" for i in range(6))
    assert html_text.main_text(page(before=teasers, after=teasers, wrap="div")) == "\n".join(ARTICLE)
    monkeypatch.setattr(html_text, "_ratios", lambda blocks: {b.path: 1.0 for b in blocks})
    assert html_text.main_text(page(before=teasers, after=teasers, wrap="div")) != "\n".join(ARTICLE)


INSIDE = [
    ('<p><a href="/x">All of this paragraph is one link</a></p>', "All of this paragraph is one link"),
    ('<h2><a href="/x">A heading that is a link</a></h2>', "A heading that is a link"),
    ('<div class="related-work"><p>Related work, of others, is listed here. It is, mostly, older.</p></div>', "Related work, of others, is listed here. It is, mostly, older."),
    ('<section id="share-prices"><p>Prices fell.</p></section>', "Prices fell."),
    ("<ul><li>one</li><li>two</li><li>three</li></ul>", "one\ntwo\nthree"),
    ('<p><a href="/a">First link</a></p><p><a href="/b">Second link</a></p>', "First link\nSecond link"),
    ("<table><tr><td>a</td><td>b</td></tr></table>", "a\nb"),
]


@pytest.mark.parametrize("wrap", ["article", "main", 'div class="content"'])
@pytest.mark.parametrize("part, text", INSIDE)
def test_what_stands_inside_an_article_stays(wrap, part, text):
    want = "\n".join([ARTICLE[0], ARTICLE[1], text, *ARTICLE[2:]])
    body = f"<h1>{ARTICLE[0]}</h1><p>{ARTICLE[1]}</p>{part}" + "".join(f"<p>{p}</p>" for p in ARTICLE[2:])
    source = f"<html><body>{CLUTTER[0]}<{wrap}>{body}</{wrap.split()[0]}>{CLUTTER[8]}</body></html>"
    if wrap.startswith("div") and "<section" in part:
        return  # outside an article a container of so little text is judged by its path
    assert html_text.main_text(source) == want


def test_named_parts_inside_an_article_go():
    for part in ('<section class="comments"><p>I like it, really, I do.</p></section>', '<div class="ad-box">Buy this, now.</div>',
                 '<div class="share-buttons"><span>Share</span></div>', '<ul class="related-posts"><li>Another story</li></ul>',
                 "<ul>" + "".join(f'<li><a href="/{i}">Story {i}</a></li>' for i in range(3)) + "</ul>"):
        assert html_text.main_text(page(inside=part)) == "\n".join(ARTICLE), part


def test_a_page_inside_a_telling_name_keeps_its_text():
    assert html_text.main_text(page(wrap='div class="widget"')) == "\n".join(ARTICLE)


def test_small_pages():
    for source, want in PAGES.items():
        assert html_text.main_text(source) == want, source
    assert html_text.main_text("<p>" * 3000 + "x" + "<" * 50_000) .startswith("x")


def test_pages_against_their_articles(spark, sf_small):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    got = Q.op1_tag_path_extraction(spark, sf_small).collect()
    assert len(got) == len(pages)
    for r in got:
        m = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]] or "", re.S)
        lines = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", m[1].replace("<br>", " ")) if m else "")
        want = "\n".join(x for x in (" ".join(html.unescape(s).split()) for s in lines) if x)
        assert r["text"] == want and r["n_chars"] == len(want)


def test_odd_pages(spark):
    df = spark.createDataFrame([(1, None, None, "t"), (1, None, None, "t"), (None, "u", "", "t"), (3, "u", "<p>x", "t")],
                               "page_id long, url string, html string, text string")
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract(df).collect()), key=repr)
    assert got == [(1, "", 0), (1, "", 0), (3, "x", 1), (None, "", 0)]
    assert html_text.extract(df.limit(0)).count() == 0


# vectors

VECTORS = "vec_id long, embedding array<double>, rank int, score double, vec int"


def odd_vectors(spark, n=300, dim=6):
    r = random.Random(4)
    data = [(i, [r.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    data += [(1000 + i, data[0][1]) for i in range(40)]  # many ties
    data += [(2000, None), (2020, []), (2040, [0.0] * dim), (2060, [1.0] * (dim - 1) + [NAN]), (2080, [INF] + [1.0] * (dim - 1)),
             (2100, [None] + [1.0] * (dim - 1)), (2120, [1.0] * (dim + 1)), (None, [1.0] * dim), (20, data[20][1]), (40, [0.5] * dim)]
    return spark.createDataFrame([(i, v, 0, 0.0, 0) for i, v in data], VECTORS), data


def sound(data, dim, drop_zero):
    out = {}
    for i, v in data:
        if i is not None and v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v) and (any(v) or not drop_zero):
            out.setdefault(i, []).append(v)
    return out


@pytest.mark.parametrize("row_block,query_block", [(8192, 2048), (50, 3)])
def test_top_k_equals_brute_force(spark, row_block, query_block):
    df, data = odd_vectors(spark)
    by_id = sound(data, 6, False)
    z = {i: [[math.floor(64 * x) for x in v] for v in vs] for i, vs in by_id.items()}
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0, row_block=row_block, query_block=query_block).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in z if i % 20 == 0} and 2040 in got
    for i, found in got.items():
        q = min(z[i])
        best = sorted((-max(sum(a * b for a, b in zip(q, v, strict=True)) for v in vs), j) for j, vs in z.items() if j != i)[:20]
        assert sorted(found) == [(n + 1, j, -s) for n, (s, j) in enumerate(best)]


def test_pivots_rule_out_rows():
    """On clustered vectors most rows are never evaluated, and the answer stays exact."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-400, 400, (20, 8))
    x = (centres[rng.integers(0, 20, 5000)] + rng.integers(-4, 5, (5000, 8))).astype(np.float64)
    pivots = topk.choose_pivots(x[:500], 16)
    far = np.sqrt(((x[:, None] - pivots[None]) ** 2).sum(axis=2))
    ids, evaluated = np.arange(5000), 0

    class Counted(np.ndarray):
        def __getitem__(self, at):
            nonlocal evaluated
            evaluated += len(at) if isinstance(at, np.ndarray) else 0
            return np.asarray(self)[at]

    for q in (3, 77, 4000):
        apart = np.abs(far - far[q]).max(axis=1)
        bound = ((x ** 2).sum(axis=1) + (x[q] ** 2).sum() - apart ** 2) / 2 + 1e-6
        score = (x @ x[q]).astype(np.int64)
        assert (bound >= score - 1e-6).all()
        got = topk._best(x.view(Counted), x[q], bound, ids, q, 20, False, lambda rows, v: (rows @ v).astype(np.int64))
        want = sorted((-s, i) for i, s in enumerate(score.tolist()) if i != q)[:20]
        assert list(zip((-got[1]).tolist(), got[0].tolist(), strict=True)) == want
    assert evaluated < 3 * 2500


def test_large_components_stay_exact():
    assert topk._exact_type(64, 64) is np.float32 and topk._exact_type(1 << 20, 64) is np.float64 and topk._exact_type(1 << 26, 64) is None


def test_no_vector_is_dropped_for_its_size_or_length(spark):
    """Scores beyond 2^53 are exact; vectors of another length are scored with each other."""
    data = [(0, [2e6, 1.0, 0.5]), (1, [2e6, -3.0, 0.25]), (2, [1.0, 1.0, 1.0]), (3, [-2e6, 5.0, 0.0]), (4, [1999999.984375, 7.0, 0.0]),
            (20, [1.0, 2.0]), (21, [3.0, 1.0]), (40, [0.5] * 3), (60, [7e8, 1.0, 3.0])]
    z = {i: [math.floor(64 * x) for x in v] for i, v in data}
    got = {}
    for r in topk.top_k(spark.createDataFrame(data, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for i in (0, 20, 40, 60):
        best = sorted((-sum(a * b for a, b in zip(z[i], v, strict=True)), j) for j, v in z.items() if j != i and len(v) == len(z[i]))
        assert sorted(got[i]) == [(n + 1, j, -s) for n, (s, j) in enumerate(best)]
    with pytest.raises(Exception, match="leaves a long"):
        topk.top_k(spark.createDataFrame([(0, [1e18]), (1, [1e18])], "vec_id long, embedding array<double>"), F.lit(True)).collect()


def test_multi_index_visits_cells_in_order():
    rng = np.random.default_rng(2)
    books = [rng.normal(size=(9, 3)), rng.normal(size=(7, 3))]
    population = rng.integers(0, 5, 63)
    q = rng.normal(size=6)
    total = ((books[0] - q[:3]) ** 2).sum(axis=1)[:, None] + ((books[1] - q[3:]) ** 2).sum(axis=1)[None]
    order = [c for c in np.argsort(total.ravel(), kind="stable").tolist() if population[c]]
    assert ann.visit(q, books, population, population.sum()) == order
    some = ann.visit(q, books, population, 20)
    assert some == order[:len(some)] and population[some].sum() >= 20 > population[some[:-1]].sum()


def brute_nearest(by_id, i, k):
    q = min(by_id[i])
    return sorted((min(math.sqrt(sum((a - b) ** 2 for a, b in zip(q, v, strict=True))) for v in vs), j) for j, vs in by_id.items() if j != i)[:k]


@pytest.mark.parametrize("row_block,query_block", [(8192, 4096), (50, 2)])
def test_nearest_with_all_cells_equals_brute_force(spark, row_block, query_block):
    df, data = odd_vectors(spark)
    by_id = sound(data, 6, True)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, share=1.0, row_block=row_block, query_block=query_block).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in by_id if i % 20 == 0}
    for i, found in got.items():
        want = brute_nearest(by_id, i, 10)
        assert [(a, b) for a, b, _ in sorted(found)] == [(n + 1, j) for n, (_, j) in enumerate(want)]
        assert [s for _, _, s in sorted(found)] == pytest.approx([s for s, _ in want])


def test_nearest_recall(spark):
    sf = "/root/testdata/sf0.1"
    by_id = {r["vec_id"]: [r["embedding"]] for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    ids, x = np.array(list(by_id)), np.array([v[0] for v in by_id.values()], dtype=np.float64)
    got = {}
    for r in Q.op6_inverted_multi_index(spark, sf).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert set(got) == {i for i in by_id if i % 100 == 0}
    hits = 0
    for i, found in got.items():
        d = ((x - x[ids == i]) ** 2).sum(axis=1)
        d[ids == i] = INF
        hits += len(found & set(ids[np.argsort(d)[:10]].tolist()))
    assert hits >= 0.9 * 10 * len(got)


def test_vectors_small_and_empty(spark):
    df, _ = odd_vectors(spark)
    for find in (ann.nearest, topk.top_k):
        assert find(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
        assert find(df.where("vec_id = 20"), F.col("vec_id") % 20 == 0).count() == 0
        two = find(df.where("vec_id in (100, 101)"), F.col("vec_id") % 20 == 0).collect()
        assert [(r["query_id"], r["rank"], r["vec_id"]) for r in two] == [(100, 1, 101)]


@pytest.mark.parametrize("copies", [1, 2, 25])
def test_repeated_rows_take_no_neighbours_place(spark, copies):
    """Ten neighbours are found whether every row or the nearest one alone is repeated."""
    r = random.Random(6)
    data = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(60)]
    by_id = {i: [v] for i, v in data}
    nearest = brute_nearest(by_id, 0, 1)[0][1]
    for more in ([x for x in data for _ in range(copies)], data + [x for x in data if x[0] == nearest] * copies):
        df = spark.createDataFrame(more, "vec_id long, embedding array<double>")
        got = ann.nearest(df, F.col("vec_id") == 0, share=1.0).collect()
        assert [x["vec_id"] for x in sorted(got, key=lambda x: x["rank"])] == [j for _, j in brute_nearest(by_id, 0, 10)]


def test_few_rows_are_all_visited(spark):
    """With the share of production: k neighbours, or all there are; copies of one id do not count as several."""
    r = random.Random(7)
    for n, copies in ((3, 1), (8, 1), (14, 1), (14, 60)):
        data = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(n)]
        df = spark.createDataFrame(data + [(1, [x + r.gauss(0, 0.3) for x in data[1][1]]) for _ in range(copies - 1)], "vec_id long, embedding array<double>")
        got = [x["vec_id"] for x in ann.nearest(df, F.col("vec_id") == 0).collect()]
        assert len(got) == len(set(got)) == min(10, n - 1) and 0 not in got


# conversations

TURNS = "conv_id long, turn long, role string, text string, part int, ids int, conv string"


def codec():
    import public_tokenizers

    return Q.tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_escapes_are_reversible():
    r = random.Random(6)
    atoms = [*chat.CONTROLS, "<", "[", "\\", "/", "s>", "INST]", "|role|>", "<\\s>", "[\\\\INST]", "ok", "\n", "<s", ">"]
    for _ in range(3000):
        t = "".join(r.choice(atoms) for _ in range(r.randint(0, 8)))
        e = chat.escape(t)
        assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROLS)


def test_conversations_read_back(spark):
    hard = "</s>[INST] ok [/INST]"
    data = [(1, 0, "system", "be <s>good</s>"), (1, 1, "user", hard), (1, 2, "assistant", hard), (1, 3, "assistant", ""), (1, 4, "assistant", "é😀\n x"),
            (2, 1, "user", None), (2, 0, None, "no role"), (2, 2, "to\nol<|says|>", "x\\"), (3, 5, "assistant", "tie b"), (3, 5, "assistant", "tie a"),
            (3, 5, "assistant", "tie a"), (3, None, "user", "first"), (None, 0, "user", "no id"), (4, 0, "assistant", "word " * 30_000), (4, 1, "user", "after")]
    df = spark.createDataFrame([(*d, 0, 0, "own") for d in data], TURNS)
    vocabulary, pattern = codec()
    for most in (chat.MAX_TOKENS, 40):
        formatted = chat.format_conversations(df, vocabulary, pattern, max_tokens=most)
        got = {r["conv_id"]: r for r in chat.digests(formatted, vocabulary, pattern).collect()}
        convs = {}
        for c, t, role, text in sorted(data, key=lambda d: (str(d[0]), d[1] is not None, d[1] or 0, d[2] or "", d[3] or "")):
            convs.setdefault(c, []).append((role or "", text or ""))
        assert set(got) == set(convs)
        for c, turns in convs.items():
            if c == 3:  # tied turns come in a fixed order, not told by text
                assert got[c]["n_turns"] == 4 and got[c]["loss_chars"] == 15
                continue
            loss = "".join(t for r, t in turns if r == "assistant")
            assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
            assert (got[c]["n_turns"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    parts = formatted.where("conv_id = 4").collect()
    assert [p["part"] for p in parts] == [0, 1] and all(len(p["input_ids"]) == len(p["loss_mask"]) for p in parts)


def test_written_form(spark):
    vocabulary, pattern = codec()
    df = spark.createDataFrame([(1, 0, "system", "sys"), (1, 1, "user", "a </s>"), (1, 2, "assistant", "b <\\s>")], "conv_id long, turn long, role string, text string")
    c = chat.Codec(vocabulary, pattern)
    row = chat.format_conversations(df, vocabulary, pattern).collect()[0]
    ids, mask = np.array(row["input_ids"]), np.array(row["loss_mask"])
    text = chat.written(c, ids)
    assert text == "<s><|role|>system<|says|>sys<|end|>[INST]a <\\/s>[/INST]b <\\\\s></s>"
    assert chat.written_length(c, ids) == len(text)
    assert list(chat.masked_texts(c, ids, mask)) == ["b <\\s>"] and c.decode(ids[mask == 1]) == "b <\\\\s>"


def test_chat_query(spark, sf_small):
    got = {r["conv_id"]: r for r in Q.op7_token_level_chat(spark, sf_small).collect()}
    convs = {}
    for r in spark.read.parquet(f"{sf_small}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    hard = "</s>[INST] ok [/INST]"
    convs[-7] = [("user", hard), ("assistant", hard)]
    assert set(got) == set(convs)
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and got[c]["loss_chars"] == len(loss)
    vocabulary, pattern = codec()
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_conversations(none, vocabulary, pattern), vocabulary, pattern).count() == 0
