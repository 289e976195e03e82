"""Stance per (clause, actor) from hypothesis templates.

A clause's actors are scored beside its row: every (premise, hypothesis) pair
of an actor and a template gets an entailment score, scores are averaged per
stance (a failed template counts 0.0), and the stance with the highest mean
wins, ties going to the earlier stance. The lists come out parallel to the
actor list. Nothing is fanned out, shuffled or joined back, whichever scorer
is used; ``template_scores`` and ``stance_pairs`` unfold the same scores.

Scorers: the default is relational, the share of the hypothesis's distinct
tokens found among the premise's tokens (with a ``max_length``, among those
that fit beside the hypothesis: only the premise is truncated); a plug-in
entailment model gets batches of pairs.

Whole texts are read by default; ``max_chars`` cuts the premise, ``max_length``
truncates it, for users who want the limits of a model.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lists import FAILED, parse_list
from ..functions.text import MAX_LENGTH, UNKNOWN, cut_text, render_template, tokens
from ._util import built, identity_of, let

# Stances in tie-break order, three hypothesis templates each,
# with one {actor} slot; the first version writes U+2019 for the apostrophe.
TEMPLATES = [
    ("positive", "The UNSC's overall stance towards {actor} is positive."),
    ("positive", "Comments about {actor} are favorable."),
    ("positive", "The tone regarding {actor} is supportive."),
    ("negative", "The UNSC's overall stance towards {actor} is negative."),
    ("negative", "Comments about {actor} are unfavorable."),
    ("negative", "The tone regarding {actor} is unsupportive."),
    ("neutral", "The UNSC's overall stance towards {actor} is neutral."),
    ("neutral", "Sentiment expressed about {actor} is moderate."),
    ("neutral", "The tone regarding {actor} is impartial."),
]
TEMPLATES_FIRST_VERSION = [(s, t.replace("UNSC's", "UNSC’s")) for s, t in TEMPLATES]
NEUTRAL = "neutral"            # stance of an unscored pair, scored {positive 0, negative 0, neutral 1}
ENTAIL_IDX = 0                 # position of the entailment logit in a model's output
BATCH_SIZE = 8                 # pairs in one call of a plug-in model
# ---------------------------------------------------------------------------

TEMPLATE_STRUCT = T.StructType([
    T.StructField("stance_rank", T.IntegerType()),
    T.StructField("stance", T.StringType()),
    T.StructField("template_id", T.IntegerType()),
    T.StructField("template", T.StringType()),
])


def template_rows(templates=TEMPLATES) -> list[tuple[int, str, int, str]]:
    """Z1 rows ``(stance_rank, stance, template_id, template)`` in order."""
    ranks: dict[str, int] = {}
    seen: dict[str, int] = {}
    rows = []
    for stance, text in templates:
        ranks.setdefault(stance, len(ranks))
        seen[stance] = seen.get(stance, -1) + 1
        rows.append((ranks[stance], stance, seen[stance], text))
    return rows


def stance_names(templates=TEMPLATES) -> list[str]:
    return list(dict.fromkeys(s for s, _ in templates))


def templates_table(spark, templates=TEMPLATES) -> DataFrame:
    """Z1 as a DataFrame (user-replaceable, any number of stances)."""
    return spark.createDataFrame(template_rows(templates), TEMPLATE_STRUCT)


def _template_array(templates) -> Column:
    return F.array(*[F.struct(F.lit(r).cast("int").alias("stance_rank"), F.lit(s).alias("stance"),
                              F.lit(i).cast("int").alias("template_id"), F.lit(t).alias("template"))
                     for r, s, i, t in template_rows(templates)])


def overlap_score(premise_tokens: Column, hypothesis: Column, max_length: int | None = None) -> Column:
    """Z2 + T8 (relational pair scorer): share of distinct hypothesis tokens found
    in the premise tokens (those that fit beside the hypothesis, if ``max_length`` is given); null when the
    hypothesis has no token or alone does not fit (the failed template then counts 0.0)."""
    def score(h: Column) -> Column:
        room = None if max_length is None else F.lit(max_length - 3) - h["n"]
        found = F.size(F.filter(h["own"], lambda t: _fits(F.array_position(premise_tokens, t), room)))
        ok = F.size(h["own"]) > 0
        return F.when(ok if room is None else ok & (room >= 0), found.cast("double") / F.size(h["own"]))

    words = let(tokens(F.lower(hypothesis)), lambda t: F.struct(F.size(t).alias("n"), F.array_distinct(t).alias("own")))
    return let(words, score)


def _fits(position: Column, room: Column | None) -> Column:
    """Whether a 1-based position (0: none) lies within the room."""
    return position > 0 if room is None else (position > 0) & (position <= room)


def effective_max_length(model_max_length: int | None, max_length: int = MAX_LENGTH) -> int:
    """The smaller of the model's own limit (when known) and the requested length."""
    return max_length if model_max_length is None else min(int(model_max_length), int(max_length))


def _prepared(clause: str, actors: str, max_chars: int | None, actors_type=None) -> Column:
    """``struct<premise, actors>`` of a row."""
    text = F.coalesce(F.col(clause).cast("string"), F.lit(""))
    none = F.array().cast("array<string>")

    def pair(premise: Column, items: Column) -> Column:
        return F.struct((premise if max_chars is None else cut_text(premise, max_chars)).alias("premise"), items.alias("actors"))

    if isinstance(actors_type, T.ArrayType):
        # already a list (e.g. the tagger's output): no parsing, items as text
        return pair(text, F.coalesce(F.col(actors).cast("array<string>"), none))
    return let(parse_list(F.coalesce(F.col(actors), F.lit("[]"))), lambda p: pair(
        F.when(p["status"] == F.lit(FAILED), F.lit("")).otherwise(text),
        F.when(p["status"] == F.lit(FAILED), F.array(F.lit(UNKNOWN))).otherwise(F.coalesce(p["items"], none))))


def prepare(df: DataFrame, key: str = "row_id", clause: str = "clause", actors: str = "predicted_actors",
            max_chars: int | None = None) -> DataFrame:
    """C1 + C4 (+ C5): ``(key, premise, actors)``; an unreadable row becomes ("", ["Unknown"]).

    The actor column may hold list literals as text or be an array already.
    """
    row = _prepared(clause, actors, max_chars, df.schema[actors].dataType)
    return df.select(key, row.alias("__row")).select(key, "__row.premise", "__row.actors")


_SLOT = "{actor}"
_WORD = re.compile(r"[^ \t\n\r]+")


def hoistable(templates=TEMPLATES) -> bool:
    """True when every template has the slot once, as a whitespace-delimited
    token, and lower-cases alike in Python and Spark (ASCII or caseless)."""
    for _, t in templates:
        if t.count(_SLOT) != 1 or _WORD.findall(t).count(_SLOT) != 1:
            return False
        if any(not c.isascii() and c.lower() != c.upper() for c in t):
            return False
    return True


def _template_words(templates):
    """Union of the templates' own words, and per template (word indexes, words, token count)."""
    vocab: list[str] = []
    per = []
    for _, t in templates:
        words = [w for w in _WORD.findall(t.lower()) if w != _SLOT]
        distinct = list(dict.fromkeys(words))
        vocab += [w for w in distinct if w not in vocab]
        per.append(([vocab.index(w) for w in distinct], distinct, len(words)))
    return vocab, per


def _not_among(words: list[str]) -> Callable[[Column], Column]:
    return lambda y: ~F.array_contains(F.lit(words), y["tok"]) if words else F.lit(True)


def _within(room: Column | None) -> Callable[[Column], Column]:
    return lambda y: _fits(y["p"], room)


def _hoisted(premise_tokens: Column, actors: Column, templates, max_length: int | None) -> Column:
    """``array<array<double>>``: scores per actor and template.

    The values of ``overlap_score`` on each rendered hypothesis: its tokens are
    the template's own words plus the actor's tokens (the slot is a whole
    token). A template word's first position in the premise is found once per
    clause and an actor token's once per actor; each template's score is then a
    fixed expression over those positions.
    """
    vocab, per = _template_words(templates)

    def score(x: Column, at: Column, idx: list[int], words: list[str], n_words: int) -> Column:
        room = None if max_length is None else F.lit(max_length - 3 - n_words) - x["n"]

        def share(extra: Column) -> Column:
            hits = F.size(F.filter(extra, _within(room)))
            for j in idx:
                hits = hits + _fits(F.get(at, F.lit(j)), room).cast("int")
            size = F.lit(len(words)) + F.size(extra)
            return F.when(size > 0 if room is None else (size > 0) & (room >= 0), hits.cast("double") / size)

        # a token of both counts once
        return let(F.filter(x["at"], _not_among(words)), share)

    def own(a: Column) -> Column:
        return let(tokens(F.lower(a)), lambda w: F.struct(F.size(w).alias("n"), F.transform(
            F.array_distinct(w), lambda t: F.struct(t.alias("tok"), F.array_position(premise_tokens, t).alias("p"))).alias("at")))

    positions = F.transform(F.lit(vocab), lambda w: F.array_position(premise_tokens, w)) if vocab else F.array().cast("array<bigint>")
    return let(positions, lambda at: F.transform(actors, lambda a: let(own(a), lambda x: F.array(*[score(x, at, *t) for t in per]))))


def _general(premise_tokens: Column, actors: Column, templates, max_length: int | None) -> Column:
    """The same scores for templates of any shape: every hypothesis is rendered."""
    return F.transform(actors, lambda a: F.array(*[overlap_score(premise_tokens, render_template(F.lit(t), a), max_length) for _, t in templates]))


def model_scores(premise: Column, actors: Column, make_pair_fn: Callable, templates=TEMPLATES, max_length: int | None = None,
                 entail_idx: int = ENTAIL_IDX, batch_size: int = BATCH_SIZE) -> Column:
    """Z2 by a plug-in entailment model (T10, U5, Z6): ``array<array<double>>``, scores per actor and template.

    ``make_pair_fn()`` returns ``fn(premises, hypotheses, max_length) ->
    logits[n, classes]`` and is built once per Python worker; the entailment
    logit is column ``entail_idx``. One call gets at most ``batch_size`` pairs,
    each different pair of an Arrow batch once; a premise travels to Python once
    per clause. If a call fails its pairs are tried one by one, and a pair that
    still fails has a null score. Empty premises and actors are not scored.
    """
    identity = identity_of(make_pair_fn)
    texts = [t for _, t in templates]

    def score(fn, pairs: list[tuple[str, str]]) -> list[float | None]:
        try:
            got = np.asarray(fn([p for p, _ in pairs], [h for _, h in pairs], max_length), dtype=float)
            return [float(v) for v in got.reshape(len(pairs), -1)[:, entail_idx]]
        except Exception:
            return [None] if len(pairs) == 1 else [v for p in pairs for v in score(fn, [p])]

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        fn = built("pair-model", identity, make_pair_fn)
        for premises, lists in batches:
            rows = [[[(p, t.replace(_SLOT, a)) for t in texts] if p and a else None for a in (() if own is None else own)]
                    for p, own in zip(premises, lists, strict=True)]
            pairs = list(dict.fromkeys(x for row in rows for own in row if own for x in own))
            known: dict = {}
            for at in range(0, len(pairs), batch_size):
                some = pairs[at:at + batch_size]
                known.update(zip(some, score(fn, some), strict=True))
            yield pd.Series([[[None] * len(texts) if own is None else [known[x] for x in own] for own in row] for row in rows], dtype=object)

    return run(premise, actors)


def scored(df: DataFrame, keep: list[str], row: Column, templates=TEMPLATES, max_length: int | None = None,
           hoist: bool | None = None, pair_model: Callable | None = None, entail_idx: int = ENTAIL_IDX,
           batch_size: int = BATCH_SIZE) -> DataFrame:
    """``keep... + __pairs``: per actor ``(actor, guard, scores array<double>)``, scores in template order.

    ``row`` is a ``struct<premise, actors>``; ``guard`` marks pairs that are
    not scored: an empty premise or actor (C9).
    """
    def pairs(r: Column, scores: Column) -> Column:
        return F.zip_with(r["actors"], scores, lambda a, s: F.struct(
            a.alias("actor"), ((F.length(r["premise"]) == 0) | a.isNull() | (F.length(a) == 0)).alias("guard"), s.alias("scores")))

    if pair_model is not None:
        src = df.select(*keep, row.alias("__row"))
        got = model_scores(F.col("__row.premise"), F.col("__row.actors"), pair_model, templates, max_length, entail_idx, batch_size)
        return src.select(*keep, "__row", got.alias("__s")).select(*keep, pairs(F.col("__row"), F.col("__s")).alias("__pairs"))
    use = hoistable(templates) if hoist is None else hoist
    if use and not hoistable(templates):
        raise ValueError("these templates need the general scorer")
    scorer = _hoisted if use else _general
    return df.select(*keep, let(row, lambda r: let(tokens(F.lower(r["premise"])), lambda p: pairs(
        r, scorer(p, r["actors"], templates, max_length)))).alias("__pairs"))


def _decided(pair: Column, templates) -> Column:
    """Z3 + A2 + P7 + A5 + C9: ``(stance, scores struct)`` of one scored pair.

    Each stance's mean adds its templates' scores in template order (a failed
    one counts 0.0), so that equal means stay equal.
    """
    names = stance_names(templates)
    means = {}
    for s in names:
        total = None
        for i, (own, _) in enumerate(templates):
            if own == s:
                v = F.coalesce(F.get(pair["scores"], F.lit(i)), F.lit(0.0))
                total = v if total is None else total + v
        means[s] = total / F.lit(float(sum(own == s for own, _ in templates)))
    ranked = [F.struct(means[s].alias("mean"), F.lit(-i).alias("first"), F.lit(s).alias("name")) for i, s in enumerate(names)]
    best = F.greatest(*ranked)["name"] if len(names) > 1 else F.lit(names[0])
    return F.struct(
        F.when(pair["guard"], F.lit(NEUTRAL)).otherwise(best).alias("stance"),
        F.struct(*[F.when(pair["guard"], F.lit(1.0 if s == NEUTRAL else 0.0)).otherwise(means[s]).alias(s) for s in names]).alias("scores"))


def _each(df: DataFrame, keep: list[str], array: str, out: str) -> DataFrame:
    """``keep... + pos, out``, a row per item; the outer form keeps the planner from computing the array again in a filter."""
    return df.select(*keep, F.posexplode_outer(array).alias("pos", out)).where(F.col("pos").isNotNull())


def hypotheses(prepared: DataFrame, templates=TEMPLATES, key: str = "row_id") -> DataFrame:
    """J3 + T7: ``(key, pos, actor, stance, template_id, hypothesis)``, every actor with every template."""
    pairs = _each(prepared, [key], "actors", "actor")
    fan = pairs.select(key, "pos", "actor", F.explode(_template_array(templates)).alias("t"))
    return fan.select(key, "pos", "actor", "t.stance", "t.template_id",
                      render_template(F.col("t.template"), F.col("actor")).alias("hypothesis"))


def template_scores(prepared: DataFrame, templates=TEMPLATES, max_length: int | None = None, key: str = "row_id", **scorer) -> DataFrame:
    """Z2 + T8: ``(key, pos, actor, stance, template_id, score)`` of the scored pairs; null score = failed template."""
    rows = scored(prepared, [key], F.struct("premise", "actors"), templates, max_length, **scorer)
    pairs = _each(rows, [key], "__pairs", "x").where(~F.col("x.guard"))
    long = pairs.select(key, "pos", "x.actor", F.posexplode("x.scores").alias("i", "score"))
    t = F.get(_template_array(templates), F.col("i"))
    return long.select(key, "pos", "actor", t["stance"].alias("stance"), t["template_id"].alias("template_id"), "score")


def stance_pairs(prepared: DataFrame, templates=TEMPLATES, max_length: int | None = None, key: str = "row_id", **scorer) -> DataFrame:
    """Long result ``(key, pos, actor, stance, <one score column per stance>)``."""
    rows = scored(prepared, [key], F.struct("premise", "actors"), templates, max_length, **scorer)
    pairs = _each(rows, [key], "__pairs", "x").select(key, "pos", "x.actor", _decided(F.col("x"), templates).alias("d"))
    return pairs.select(key, "pos", "actor", "d.stance", *[F.col(f"d.scores.{s}").alias(s) for s in stance_names(templates)])


def stance(df: DataFrame, templates=TEMPLATES, max_length: int | None = None, max_chars: int | None = None,
           key: str = "row_id", clause: str = "clause", actors: str = "predicted_actors",
           attach: bool = True, pair_model: Callable | None = None, model_max_length: int | None = None,
           limit_n: int | None = None, entail_idx: int = ENTAIL_IDX, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Z4 end to end: the input rows plus ``predicted_sentiments`` and ``sentiment_scores``.

    One projection over each row, whatever the scorer: no exchange and no join,
    on a batch as on a stream. Without ``attach`` only the key and the lists
    are returned. Premises are whole, for a plug-in model too (it gets
    ``max_length`` None), unless ``max_length`` or ``model_max_length`` limits
    them (Z5: the smaller of the model's limit and the requested length, 512 if
    none was); ``limit_n`` keeps the first n clauses by key, applied before any
    work (P3).
    """
    if model_max_length is not None:
        max_length = effective_max_length(model_max_length, MAX_LENGTH if max_length is None else max_length)
    if limit_n is not None:
        from .sampling import first_n
        df = first_n(df, limit_n, key)
    row = _prepared(clause, actors, max_chars, df.schema[actors].dataType)
    keep = list(df.columns) if attach else [key]
    rows = scored(df, keep, row, templates, max_length, pair_model=pair_model, entail_idx=entail_idx, batch_size=batch_size)
    rows = rows.select(*keep, F.transform("__pairs", lambda x: _decided(x, templates)).alias("__r"))
    return rows.select(*keep, F.transform("__r", lambda r: r["stance"]).alias("predicted_sentiments"),
                       F.transform("__r", lambda r: r["scores"]).alias("sentiment_scores"))
