"""Main text of web pages by tag-path ratios.

A page is read once into text blocks, each with the path of tags from the root
to it (inline tags do not count; a class or id tells equal tags apart). For
every path the text length and the punctuation of its blocks are summed and
divided by their number. Both ratios are smoothed over neighbouring blocks,
fused into one score, and paths from a share of the page's mean score on are the
content. The content's holder is what these paths have in common, or the
``article`` or ``main`` element inside it that holds most of their score. Inside
the holder of an article all stays that no name speaks against; inside another
holder a container without any content path goes, what stands between the
content paths otherwise stays. Three or more blocks in a row that are links are
a list of links and go; a single one stays.

Elements that never hold an article (scripts, styles, menus, page headers and
footers, sidebars, forms) take no part. A class or id that says advert, notice,
comments and the like leaves a twentieth of a path's score, and the page's mean is
that of the other paths; the score decides, so a page that is all inside such a
name keeps its text.

Defined cases: null or empty html gives an empty text, as does a page without
text; markup may be cut off or unclosed anywhere; a text without tags is its
own content; very long pages are read whole, in time linear in their length;
of holders with equal scores the inner one counts, of equal ones side by side
the last; repeated rows are extracted once each; extra columns are ignored.
Pages are independent: one pass, no shuffle.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: kinds of elements
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
search section summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# elements that never hold an article's text
APART = frozenset("""nav footer aside form script style noscript template iframe svg canvas object button select textarea
dialog menu head title audio video map datalist search xmp""".split())
# roles, and words of a class or id, that say the same
APART_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
APART_WORDS = frozenset("""ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments
consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter
notice notices notification overlay pager pagination popup promo promotion recommended related replies reply respond share
sharing sidebar signup skip social sponsor sponsored subscribe subscription topbar toolbar widget""".split())
# words that mark an article's own head, kept though it is called a header
OWN_WORDS = frozenset("article body content entry post story".split())
# words that say nothing beside those: a name tells only if all its other words are of these
PLAIN_WORDS = frozenset("""area bar block body bottom box btn button center col column container content div false first group
head holder icon id inner item items js last layout left links list main message module outer page panel post posts region right
row section site slot small text title top true unit wrap wrapper zone""".split())
# elements that only group others
GROUPING = frozenset("article center details div main section".split())
# marks that running text has
MARKS = ".,;:!?…。，、；：！？؟،¿¡"
# an opened element closes these, if open above the nearest bound
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
BOUNDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
          "option": {"select", "datalist"}, "tbody": {"table"}, "tfoot": {"table"}}

# weights of a block's neighbours in the smoothing (a Gaussian of one block's deviation)
SMOOTH = [math.exp(-d * d / 2) for d in range(3)]
# a path is content if its score is at least this share of the page's mean, weighted by text
KEEP_SHARE = 0.4
# what is left of the score of a path whose name speaks against it
NAMED_SHARE = 0.05
# a block of which more than this share is link text is a link, and so many in a row are a list of links
LINK_SHARE = 0.6
LINK_RUN = 3

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/><]*+)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/"'<>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"'<>]+)""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Element:
    __slots__ = ("tag", "key", "parent", "apart", "by_name", "has_main", "links", "muted")

    def __init__(self, tag: str, key: str, parent: Element | None, apart: bool, by_name: bool):
        self.tag, self.key, self.parent = tag, key, parent
        # apart: by its tag or role; by_name: by a word of its class or id, unless an article lies inside
        self.apart, self.by_name, self.has_main = apart, by_name, False
        self.links = tag == "a" or bool(parent and parent.links)
        # an inline element set apart says nothing in the block around it
        self.muted = (tag not in BLOCK and (apart or by_name)) or bool(parent and parent.muted)

    def chain(self) -> list[Element]:
        """The element and all around it, the root first."""
        out, e = [], self
        while e:
            out.append(e)
            e = e.parent
        return out[::-1]


class Block:
    __slots__ = ("text", "at", "link_chars", "path", "chain", "named")

    def __init__(self, text: str, at: Element, link_chars: int):
        self.text, self.at, self.link_chars = text, at, link_chars


def _named(tag: str, attributes: str, inside_article: bool) -> tuple[str, bool, bool]:
    """The path key of an element, and whether its attributes set it apart (surely, by name)."""
    attrs = {}
    for m in _ATTR.finditer(attributes):
        attrs.setdefault((m[1] or m[5]).lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
    each = [{w.lower() for w in _WORD.findall(n)} for n in names]
    words = set().union(*each)
    hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")
    sure = hidden or attrs.get("role", "").lower() in APART_ROLES
    telling = any(w & APART_WORDS and all(x.isdigit() or x.rstrip("s") in PLAIN_WORDS for x in w - APART_WORDS - PLAIN_WORDS) for w in each)
    by_name = telling or ("header" in words and not inside_article and not words & OWN_WORDS)
    return f"{tag}.{names[0]}" if names else tag, sure, by_name


def read_blocks(page: str) -> list[Block]:
    """The page's text blocks in order, white space and character references settled."""
    root = Element("", "", None, False, False)
    stack, blocks, parts, link_chars = [root], [], [], 0

    def flush() -> None:
        nonlocal link_chars
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                at = stack[-1]
                while at.parent and at.tag not in BLOCK:
                    at = at.parent
                blocks.append(Block(text, at, link_chars))
            parts.clear()
            link_chars = 0

    def add(raw: str) -> None:
        nonlocal link_chars
        if raw and not stack[-1].muted:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if stack[-1].links:
                link_chars += len(text.strip())

    def pop_to(n: int) -> None:
        if any(e.tag in BLOCK for e in stack[n:]):
            flush()
        del stack[n:]

    at = 0
    while m := _TOKEN.search(page, at):
        add(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            for n in range(len(stack) - 1, 0, -1):
                if stack[n].tag == tag:
                    pop_to(n)
                    break
                if stack[n].tag in ("td", "th", "table") and tag not in BLOCK:
                    break
            continue
        if tag == "br":
            parts.append("\n")
            continue
        if tag in BLOCK:
            flush()
            for n in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[n].tag == "p":
                    pop_to(n)
                    break
                if stack[n].tag in ("td", "th", "table", "button"):
                    break
        if tag in CLOSES:
            for n in range(len(stack) - 1, 0, -1):
                if stack[n].tag in BOUNDS[tag]:
                    break
                if stack[n].tag in CLOSES[tag]:
                    pop_to(n)
        if tag in VOID:
            continue
        own = any(e.tag in ("article", "main") for e in stack)
        key, sure, by_name = _named(tag, m[3], own) if m[3].strip("/ \n\t") else (tag, False, False)
        if tag in ("html", "body"):
            by_name = False
        apart = tag in APART or sure or (tag == "header" and not own) or (tag == "header" and own and stack[-1].tag != "article")
        e = Element(tag, key, stack[-1], apart, by_name and tag != "main")
        if tag in ("article", "main") and not apart and not e.by_name:
            for outer in stack:
                outer.has_main = True
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else len(page)
            close = page.find(">", at)
            at = len(page) if close < 0 else close + 1
            continue
        stack.append(e)
    add(page[at:])
    flush()
    return blocks


def _ratios(blocks: list[Block]) -> dict[str, float]:
    """The fused, smoothed score of every path."""
    sums: dict[str, list[float]] = {}
    for b in blocks:
        s = sums.setdefault(b.path, [0, 0, 0])
        s[0] += len(b.text) - b.link_chars
        s[1] += sum(map(b.text.count, MARKS))
        s[2] += 1
    per_block = [(sums[b.path][0] / sums[b.path][2], sums[b.path][1] / sums[b.path][2]) for b in blocks]
    smooth: dict[str, list[float]] = {}
    for i, b in enumerate(blocks):
        text = marks = weight = 0.0
        for j in range(max(0, i - 2), min(len(blocks), i + 3)):
            w = SMOOTH[abs(i - j)]
            text, marks, weight = text + w * per_block[j][0], marks + w * per_block[j][1], weight + w
        s = smooth.setdefault(b.path, [0, 0, 0])
        s[0] += text / weight
        s[1] += marks / weight
        s[2] += 1
    # one mark is added so that a text without punctuation still scores by its length
    named = {b.path for b in blocks if b.named}
    return {p: math.sqrt(max(0.0, t / n) * (1 + m / n)) * (NAMED_SHARE if p in named else 1.0) for p, (t, m, n) in smooth.items()}


def _holder(core: list[Block], score: dict[str, float]) -> tuple[Element, bool]:
    """The element that holds the content, and whether it is an article."""
    weights: dict[Element, float] = {}
    total = 0.0
    for b in core:
        mass = score[b.path] * len(b.text)
        total += mass
        for e in b.chain:
            if e.tag in ("article", "main"):
                weights[e] = weights.get(e, 0.0) + mass
    top = max(weights.values(), default=0.0)
    if 2 * top >= total > 0:  # the innermost of the heaviest, if it holds most of what the outer one holds
        return [e for e in weights if 2 * weights[e] >= top][-1], True
    shared = core[0].chain
    for b in core[1:]:
        n = 0
        while n < min(len(shared), len(b.chain)) and shared[n] is b.chain[n]:
            n += 1
        shared = shared[:n]
    return shared[-1], False


def _without_link_lists(blocks: list[Block]) -> list[Block]:
    out: list[Block] = []
    run: list[Block] = []
    for b in [*blocks, None]:
        if b is not None and b.link_chars > LINK_SHARE * len(b.text):
            run.append(b)
            continue
        out += run if len(run) < LINK_RUN else []
        run = []
        out += [] if b is None else [b]
    return out


def content_blocks(page: str) -> list[Block]:
    """The blocks of the article."""
    blocks = []
    for b in read_blocks(page):
        b.chain = b.at.chain()
        if not any(e.apart for e in b.chain):
            b.named = any(e.by_name and not e.has_main for e in b.chain)
            b.path = "/".join(e.key for e in b.chain if e.tag in BLOCK)
            blocks.append(b)
    if not blocks:
        return []
    score = _ratios(blocks)
    judged = [b for b in blocks if not b.named] or blocks
    least = KEEP_SHARE * sum(score[b.path] * len(b.text) for b in judged) / sum(len(b.text) for b in judged)
    core = [b for b in blocks if score[b.path] >= least and b.link_chars <= LINK_SHARE * len(b.text)]
    if not core:
        return []
    holder, article = _holder(core, score)
    held = [b for b in blocks if holder in b.chain]
    if article:
        return _without_link_lists([b for b in held if not b.named or score[b.path] >= least])
    chosen, full = {id(b) for b in core}, {e for b in core for e in b.chain}
    first, last = held.index(core[0]), held.index(core[-1])

    def stays(i: int, b: Block) -> bool:
        if id(b) in chosen:
            return True
        # containers inside the holder are judged by their paths
        if b.named or any(e.tag in GROUPING and e not in full for e in b.chain):
            return False
        return first < i < last or (b.at.tag in HEADINGS and i < last)

    return _without_link_lists([b for i, b in enumerate(held) if stays(i, b)])


def main_text(page: str | None) -> str:
    """The article of one page: its blocks, one to a line."""
    return "\n".join(b.text for b in content_blocks(page)) if isinstance(page, str) else ""


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, ``text`` and ``n_chars`` of every row of ``pages``."""
    rows = pages.select(*[F.col(c) for c in keep], F.col(html_col).alias("html_"))

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([main_text(p) for p in b], dtype=object)

    out = rows.withColumn("text_", run(F.col("html_")))
    return out.select(*[F.col(c) for c in keep], F.col("text_").alias("text"), F.length("text_").cast("long").alias("n_chars"))
