"""DuckDB SQL equal to each registered query (tables are pre-registered views)."""

from __future__ import annotations

import math

from ..functions.text import N_FEATURES
from ..operators.clean import NA_VALUES
from ..operators.labels import WARM_MAP
from ..operators.stance import TEMPLATES_FIRST_VERSION, template_rows
from .queries import (BATCH_EPOCHS, BATCH_SIZE, BATCH_STEPS, FIRST_N, FIT_EPOCHS, FIT_STEPS, MODEL_LENGTH, PARTS, POSITIVE,
                      SAMPLE_N)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


TOKEN_RE = "'[^ \\t\\n\\r]+'"

GOLD = """
gold AS (
  SELECT d.doc_id AS row_id, d.text AS clause,
         list_concat(list_concat(list_filter([d.lang, d.source], lambda x: x IS NOT NULL),
                     CASE WHEN l.quality = 1 THEN ['quality'] ELSE []::VARCHAR[] END),
                     CASE WHEN l.toxic = 1 THEN ['toxic'] ELSE []::VARCHAR[] END) AS actors
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
clauses AS (
  SELECT row_id, clause, actors,
         CASE WHEN len(actors) = 0 THEN '[]'
              WHEN row_id % 3 = 0 THEN '[''' || array_to_string(actors, ''', ''') || ''']'
              WHEN row_id % 3 = 1 THEN '["' || array_to_string(actors, '", "') || '"]'
              ELSE '[ ''' || array_to_string(actors, ''',''') || ''', ]' END AS actors_text
  FROM gold
),
labels_all AS (SELECT DISTINCT unnest(actors) AS label FROM gold),
vocab AS (SELECT (row_number() OVER (ORDER BY label) - 1)::INTEGER AS label_id, label FROM labels_all)
"""


def head_cte(name: str = "head", vocab: str = "vocab", salt: str = "init") -> str:
    return f"""
{name} AS (
  SELECT v.label_id, v.label, f.feature::INTEGER AS feature,
         ((('0x' || substr(md5({_q(salt)} || ':' || v.label || ':' || f.feature::VARCHAR), 1, 8))::BIGINT::DOUBLE
            / 4294967296.0::DOUBLE) - 0.5::DOUBLE) * 0.1::DOUBLE AS weight
  FROM {vocab} v CROSS JOIN range(-1, {N_FEATURES}) f(feature)
)
"""


HEAD = head_cte()


def token_ids_sql(text: str) -> str:
    return (f"list_transform(regexp_extract_all({text}, {TOKEN_RE}), "
            f"lambda w: (3 + (('0x' || substr(md5(lower(w)), 1, 8))::BIGINT % 65533))::INTEGER)")


def parse_sql(text: str) -> str:
    """Items of a plainly quoted list literal (the generated spellings)."""
    return (f"list_transform(regexp_extract_all({text}, '(''[^'']*''|\"[^\"]*\")', 1), "
            f"lambda x: substr(x, 2, length(x) - 2))")


def overlap_windows_cte(src: str, text: str, ids=token_ids_sql, cls: int = 1, sep: int = 2) -> str:
    return f"""
ids AS (SELECT row_id, {ids(text)} AS ids FROM {src}),
nwin AS (SELECT row_id, ids,
                CASE WHEN len(ids) <= 510 THEN 1 ELSE 1 + ceil((len(ids) - 510) / 254.0)::BIGINT END AS cnt
         FROM ids),
wins AS (
  SELECT row_id, w::INTEGER AS "window",
         list_concat(list_concat([{cls}], ids[w * 254 + 1 : w * 254 + 510]), [{sep}]) AS window_ids
  FROM (SELECT row_id, ids, unnest(range(0, cnt)) AS w FROM nwin)
)
"""


def fixed_windows_cte(src: str, text: str) -> str:
    return f"""
ids AS (SELECT row_id, list_concat(list_concat([1], {token_ids_sql(text)}), [2]) AS full_ids FROM {src}),
wins AS (
  SELECT row_id, w::INTEGER AS "window", full_ids[w * 256 + 1 : w * 256 + 512] AS window_ids
  FROM (SELECT row_id, full_ids, unnest(range(0, ceil(len(full_ids) / 256.0)::BIGINT)) AS w FROM ids)
)
"""


LOGITS = f"""
feats AS (SELECT row_id, "window", unnest(list_concat([-1], list_transform(window_ids, lambda x: x % {N_FEATURES}))) AS feature
          FROM wins),
logits AS (SELECT f.row_id, f."window", h.label_id, sum(h.weight) AS logit
           FROM feats f JOIN head h ON f.feature = h.feature GROUP BY f.row_id, f."window", h.label_id)
"""

DECIDE = """
probs AS (SELECT row_id, label_id, avg(1.0 / (1.0 + exp(-logit))) AS p FROM logits GROUP BY row_id, label_id),
pv AS (SELECT p.row_id, p.label_id, p.p, v.label FROM probs p JOIN vocab v ON p.label_id = v.label_id),
decided AS (
  SELECT row_id,
         coalesce(string_agg(label, '|' ORDER BY label_id) FILTER (WHERE p >= 0.5 AND NOT isnan(p)),
                  first(label ORDER BY p DESC, label_id ASC)) AS predicted_actors
  FROM pv GROUP BY row_id
)
"""

TRUTH = """
truth AS (SELECT DISTINCT e.row_id, v.label_id
          FROM (SELECT row_id, unnest(actors) AS label FROM gold) e JOIN vocab v ON e.label = v.label)
"""

CELLS = """
cells AS (SELECT l.row_id, l."window", l.label_id, l.logit, CASE WHEN t.row_id IS NULL THEN 0 ELSE 1 END AS y
          FROM logits l LEFT JOIN truth t ON l.row_id = t.row_id AND l.label_id = t.label_id),
conf AS (SELECT count(*) FILTER (WHERE pred AND y = 1) AS tp, count(*) FILTER (WHERE pred AND y = 0) AS fp,
                count(*) FILTER (WHERE NOT pred AND y = 1) AS fn, count(*) FILTER (WHERE NOT pred AND y = 0) AS tn
         FROM (SELECT y, (1.0 / (1.0 + exp(-logit))) >= 0.5 AS pred FROM cells))
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def templates_cte(rows) -> str:
    return f"templates AS (SELECT * FROM {_values(rows, ['stance_rank', 'stance', 'template_id', 'template'])})"


TEMPLATES = templates_cte(template_rows())
FIRST_VERSION = templates_cte(template_rows(TEMPLATES_FIRST_VERSION))


def _slot_sql() -> tuple[str, str]:
    rows = template_rows()
    names = list(dict.fromkeys(st for _, st, _, _ in rows))
    slot_cols = ",\n".join(
        f"         max(coalesce(score, 0.0)) FILTER (WHERE stance = {_q(st)} AND template_id = {i}) AS s_{st}_{i}"
        for _, st, i, _ in rows)
    mean_cols = ",\n".join(
        "         (" + " + ".join(f"coalesce(s_{st}_{i}, 0.0)" for _, st2, i, _ in rows if st2 == st)
        + f") / {sum(1 for r in rows if r[1] == st)}.0 AS {st}" for st in names)
    return slot_cols, mean_cols


def stance_ctes(prep: str, max_length: int | None = None, fails: str = "FALSE") -> str:
    """From ``{prep}(row_id, premise, actors)`` to ``pairs_out`` and ``lists``; ``fails`` marks pairs without a score."""
    slot_cols, mean_cols = _slot_sql()
    room = "2147483647" if max_length is None else f"({max_length - 3} - len(htoks))"
    return f"""
pairs AS (
  SELECT row_id, premise, regexp_extract_all(lower(premise), {TOKEN_RE}) AS ptoks,
         unnest(actors) AS actor, unnest(range(0, len(actors)))::INTEGER AS pos
  FROM {prep}
),
fan AS (
  SELECT p.row_id, p.pos, p.actor, p.ptoks, length(p.premise) = 0 OR length(p.actor) = 0 AS guard,
         t.stance, t.template_id, t.template, regexp_extract_all(lower(replace(t.template, '{{actor}}', p.actor)), {TOKEN_RE}) AS htoks
  FROM pairs p CROSS JOIN templates t
),
scored AS (
  SELECT row_id, pos, actor, guard, stance, template_id,
         CASE WHEN {fails} OR {room} < 0 OR len(list_distinct(htoks)) = 0 THEN NULL
              ELSE len(list_filter(list_distinct(htoks),
                        lambda h: coalesce(list_position(ptoks, h), 0) > 0
                              AND coalesce(list_position(ptoks, h), 0) <= {room}))::DOUBLE
                   / len(list_distinct(htoks)) END AS score
  FROM fan
),
slots AS (
  SELECT row_id, pos, actor, bool_or(guard) AS guard,
{slot_cols}
  FROM scored GROUP BY row_id, pos, actor
),
means AS (
  SELECT row_id, pos, actor, guard,
{mean_cols}
  FROM slots
),
pairs_out AS (
  SELECT row_id, pos, actor,
         CASE WHEN guard THEN 'neutral'
              WHEN positive >= negative AND positive >= neutral THEN 'positive'
              WHEN negative >= neutral THEN 'negative' ELSE 'neutral' END AS stance,
         CASE WHEN guard THEN 0.0 ELSE positive END AS positive,
         CASE WHEN guard THEN 0.0 ELSE negative END AS negative,
         CASE WHEN guard THEN 1.0 ELSE neutral END AS neutral
  FROM means
),
lists AS (
  SELECT r.row_id,
         coalesce(string_agg(o.stance, '|' ORDER BY o.pos), '') AS predicted_sentiments,
         coalesce(string_agg(printf('%.6f/%.6f/%.6f', o.positive, o.negative, o.neutral), '|' ORDER BY o.pos), '')
           AS sentiment_scores
  FROM {prep} r LEFT JOIN pairs_out o ON r.row_id = o.row_id
  GROUP BY r.row_id
)
"""


PREP = "prep AS (SELECT row_id, {premise} AS premise, {actors} AS actors FROM {src})"
WHOLE = "coalesce(clause, '')"
CUT = "CASE WHEN length(coalesce(clause, '')) > 2000 THEN substr(clause, 1, 2000) || '...' ELSE coalesce(clause, '') END"

EDGES = """
edges AS (
  SELECT doc_id AS row_id, doc_id % 11 AS form, coalesce(lang, 'x') AS lang, coalesce(source, 'y') AS source,
         CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END AS clause,
         CASE doc_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN '[' || coalesce(lang, 'x') || ']'
           WHEN 3 THEN '(''x'', ''' || coalesce(source, 'y') || ''')' WHEN 4 THEN '[''it\\''s'', "' || coalesce(source, 'y') || '"]'
           WHEN 5 THEN '['''']' WHEN 6 THEN '{[]:1}' WHEN 7 THEN '' WHEN 8 THEN coalesce(source, 'y') || ', ' || coalesce(lang, 'x')
           WHEN 9 THEN '[''' || coalesce(source, 'y') || ''' ''' || coalesce(lang, 'x') || ''']' ELSE '5' END AS predicted_actors
  FROM documents),
edge_lists AS (
  SELECT *, CASE form WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN [] WHEN 2 THEN [lang] WHEN 3 THEN ['(''x'', ''' || source || ''')']
              WHEN 4 THEN ['it''s', source] WHEN 5 THEN [''] WHEN 6 THEN ['Unknown'] WHEN 7 THEN ['Unknown']
              WHEN 8 THEN [source || ', ' || lang] WHEN 9 THEN [source || lang] ELSE ['5'] END AS items,
         CASE WHEN form = 0 THEN -1 WHEN form IN (1, 4, 5, 9) THEN 0 WHEN form IN (3, 10) THEN 1 WHEN form IN (2, 7, 8) THEN 2 ELSE 3 END AS status
  FROM edges)
"""

WARM = f"""
fixed AS (SELECT * FROM {_values(WARM_MAP, ['new_label', 'old_label'])}),
cnt AS (SELECT source, lang, count(*) AS n FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL
        GROUP BY source, lang),
top AS (SELECT source AS new_label, lang AS old_label
        FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang ASC) AS rk FROM cnt)
        WHERE rk = 1),
warm AS (SELECT * FROM fixed UNION ALL SELECT * FROM top),
old_labels AS (SELECT DISTINCT lang AS label FROM documents WHERE lang IS NOT NULL),
old_vocab AS (SELECT (row_number() OVER (ORDER BY label) - 1)::INTEGER AS label_id, label FROM old_labels),
pairs AS (SELECT new_label, old_label FROM warm
          WHERE new_label IN (SELECT label FROM vocab) AND old_label IN (SELECT label FROM old_vocab))
"""

MULTI_HOT_IDS = """
ex AS (SELECT row_id, unnest(actors) AS label FROM gold),
ids0 AS (SELECT ex.row_id, list_sort(list(DISTINCT v.label_id)) AS label_ids
         FROM ex JOIN vocab v ON ex.label = v.label GROUP BY ex.row_id),
idsl AS (SELECT g.row_id, coalesce(i.label_ids, []::INTEGER[]) AS label_ids
         FROM gold g LEFT JOIN ids0 i ON g.row_id = i.row_id)
"""


def _macro(conf: str = "conf", extra: str = "") -> str:
    tp, fp, fn, tn = "tp::DOUBLE", "fp::DOUBLE", "fn::DOUBLE", "tn::DOUBLE"

    def ratio(a, b):
        return f"(CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) ELSE 0.0 END)"

    p1, p0 = ratio(tp, f"{tp} + {fp}"), ratio(tn, f"{tn} + {fn}")
    r1, r0 = ratio(tp, f"{tp} + {fn}"), ratio(tn, f"{tn} + {fp}")
    f1_1 = ratio(f"2 * {p1} * {r1}", f"{p1} + {r1}")
    f1_0 = ratio(f"2 * {p0} * {r0}", f"{p0} + {r0}")
    has1 = f"(CASE WHEN {tp} + {fn} + {fp} > 0 THEN 1.0 ELSE 0.0 END)"
    has0 = f"(CASE WHEN {tn} + {fp} + {fn} > 0 THEN 1.0 ELSE 0.0 END)"

    def macro(a, b):
        return ratio(f"{a} * {has1} + {b} * {has0}", f"{has1} + {has0}")

    return (f"SELECT {extra}round({ratio(f'{tp} + {tn}', f'{tp} + {fp} + {fn} + {tn}')}, 6) AS accuracy, "
            f"round({macro(f1_1, f1_0)}, 6) AS f1, round({macro(p1, p0)}, 6) AS precision, "
            f"round({macro(r1, r0)}, 6) AS recall FROM {conf}")


ORDER_KEY = "('0x' || substr(md5('42:' || {k}::VARCHAR), 1, 15))::BIGINT"
UNIT = "(('0x' || substr(md5('42:' || {k}::VARCHAR), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE)"


SLOPE = "1.0 / (1.0 + exp(-z)) - y"
VALUE = "greatest(z, 0.0) - z * y + ln(1 + exp(-abs(z)))"
# a true label counts POSITIVE times
_SOFT = "(greatest(z, 0.0) + ln(1 + exp(-abs(z))))"
WEIGHTED_SLOPE = f"(1.0 / (1.0 + exp(-z))) * ({POSITIVE} * y + 1.0 - y) - {POSITIVE} * y"
WEIGHTED_VALUE = f"{POSITIVE} * y * ({_SOFT} - z) + (1.0 - y) * {_SOFT}"


def order_cte(epoch: int, size: str) -> str:
    """``order{epoch}(row_id, window, batch)``: the training windows in the epoch's order, in batches of ``size``."""
    key = "row_id::VARCHAR || ':' || \"window\"::VARCHAR"
    return f"""
order{epoch} AS MATERIALIZED (SELECT row_id, "window", (row_number() OVER (ORDER BY {ORDER_KEY.replace("42:", f"42:{epoch}:").format(k="(" + key + ")")}, {key}) - 1) // {size} AS batch
  FROM wins JOIN sides USING (row_id) WHERE NOT held)"""


def fit_ctes(epochs: int, steps: int, lr: float = 0.05, decay: float = 0.01, warmup: float = 0.1, slope: str = SLOPE,
             value: str = VALUE, batches: bool = False) -> str:
    """The fit unrolled: heads ``w0 .. wN``, ``epoch_table``, ``ranked`` and the best epoch's head as ``head``.

    With ``batches`` an epoch's steps take its batches in turn instead of all windows.
    """
    total = epochs * steps
    warm = math.ceil(total * warmup)
    out = [f"""
sides AS (SELECT DISTINCT row_id, {UNIT.format(k='row_id')} < 0.2 AS held FROM wins),
counts AS MATERIALIZED (SELECT u.row_id, u."window", u.feature, count(*)::DOUBLE AS x, any_value(s.held) AS held
  FROM (SELECT row_id, "window", unnest(list_transform(window_ids, lambda t: t % {N_FEATURES})) AS feature FROM wins) u
  JOIN sides s ON u.row_id = s.row_id GROUP BY u.row_id, u."window", u.feature),
n_train AS (SELECT count(*)::DOUBLE AS n FROM wins JOIN sides USING (row_id) WHERE NOT held),
w0 AS MATERIALIZED (SELECT * FROM first_head)"""]

    def logits(name: str, w: str, held: str) -> str:
        return f"""
{name} AS MATERIALIZED (SELECT z.row_id, z."window", z.label_id, z.z + b.weight AS z, CASE WHEN t.row_id IS NULL THEN 0.0 ELSE 1.0 END AS y
  FROM (SELECT c.row_id, c."window", w.label_id, sum(c.x * w.weight) AS z FROM counts c JOIN {w} w ON c.feature = w.feature
        WHERE {held} GROUP BY c.row_id, c."window", w.label_id) z
  JOIN {w} b ON b.feature = -1 AND b.label_id = z.label_id
  LEFT JOIN truth t ON z.row_id = t.row_id AND z.label_id = t.label_id)"""

    for i in range(total):
        rate = lr * (i + 1) / warm if warm and i < warm else lr * max(0.0, (total - i) / max(1, total - warm))
        taken, count = "NOT c.held", "n_train n"
        if batches:
            e, k = i // steps + 1, i % steps
            taken = f'EXISTS (SELECT 1 FROM order{e} o WHERE o.batch = {k} AND o.row_id = c.row_id AND o."window" = c."window")'
            count = f"(SELECT count(*)::DOUBLE AS n FROM order{e} WHERE batch = {k}) n"
            out += [order_cte(e, f"(SELECT ceil(n / {steps}.0)::BIGINT FROM n_train)")] if k == 0 else []
        out += [logits(f"z{i}", f"w{i}", taken), f"""
r{i} AS MATERIALIZED (SELECT row_id, "window", label_id, {slope} AS r FROM z{i}),
g{i} AS MATERIALIZED (SELECT r.label_id, c.feature, sum(c.x * r.r) AS g FROM counts c JOIN r{i} r ON c.row_id = r.row_id AND c."window" = r."window"
  GROUP BY r.label_id, c.feature UNION ALL SELECT label_id, -1, sum(r) FROM r{i} GROUP BY label_id),
w{i + 1} AS MATERIALIZED (SELECT w.label_id, w.label, w.feature,
  w.weight - {rate!r}::DOUBLE * (coalesce(g.g, 0.0) / n.n + CASE WHEN w.feature = -1 THEN 0.0 ELSE {decay!r}::DOUBLE * w.weight END) AS weight
  FROM w{i} w LEFT JOIN g{i} g ON w.label_id = g.label_id AND w.feature = g.feature, {count})"""]
    for e in range(1, epochs + 1):
        out += [logits(f"e{e}", f"w{e * steps}", "c.held"), f"""
conf{e} AS (SELECT count(*) FILTER (WHERE pred AND y = 1) AS tp, count(*) FILTER (WHERE pred AND y = 0) AS fp,
                   count(*) FILTER (WHERE NOT pred AND y = 1) AS fn, count(*) FILTER (WHERE NOT pred AND y = 0) AS tn
            FROM (SELECT y, 1.0 / (1.0 + exp(-z)) >= 0.5 AS pred FROM e{e})),
loss{e} AS (SELECT round(avg({value}), 6) AS loss FROM e{e}),
m{e} AS ({_macro(f"conf{e}, loss{e}", f"{e} AS epoch, loss, ")})"""]
    tables = " UNION ALL ".join(f"SELECT * FROM m{e}" for e in range(1, epochs + 1))
    heads = " UNION ALL ".join(f"SELECT label_id, label, feature, weight FROM w{e * steps} WHERE (SELECT epoch FROM ranked WHERE rank = 1) = {e}"
                               for e in range(1, epochs + 1))
    out += [f"epoch_table AS ({tables})", "ranked AS (SELECT *, row_number() OVER (ORDER BY f1 DESC, epoch) AS rank FROM epoch_table)",
            f"head AS ({heads})"]
    return ",\n".join(x.strip() for x in out)


TAG_DOCUMENTS = _with(GOLD, HEAD, overlap_windows_cte("gold", "coalesce(clause, 'nan')"), LOGITS, DECIDE) + \
    "\nSELECT row_id, predicted_actors FROM decided"


def length_ids_sql(text: str) -> str:
    return f"list_transform(regexp_extract_all({text}, {TOKEN_RE}), lambda w: (3 + (31 * length(w) + unicode(w)) % 1000)::INTEGER)"


def _fit(*ctes: str) -> str:
    return _with(GOLD, head_cte("first_head"), fixed_windows_cte("gold", "clause"), TRUTH, *ctes)


_EPOCHS = "\nSELECT epoch, loss, accuracy, f1, precision, recall, epoch = (SELECT epoch FROM ranked WHERE rank = 1) AS best FROM epoch_table"
_STANCE_PREP = PREP.format(premise=WHOLE, actors=parse_sql("actors_text"), src="clauses")
_LISTS = "\nSELECT row_id, predicted_sentiments, sentiment_scores FROM lists"
_FIT = _fit(fit_ctes(FIT_EPOCHS, FIT_STEPS))
# the tagging windows beside the training windows of a fit
_TAG_WINDOWS = (overlap_windows_cte("gold", "coalesce(clause, 'nan')").replace("\nids AS", "\ntag_ids AS").replace("FROM ids)", "FROM tag_ids)")
                .replace("wins AS (\n", "tag_wins AS (\n"))


def _stance(templates: str = TEMPLATES, prep: str = _STANCE_PREP, **options) -> str:
    return _with(GOLD, templates, prep, stance_ctes("prep", **options)) + _LISTS


ORACLE: dict[str, str] = {
    "tag_documents": TAG_DOCUMENTS,
    "tag_batch_udf": TAG_DOCUMENTS,
    "tag_joined": TAG_DOCUMENTS,
    "tag_foreign_tokenizer": _with(GOLD, HEAD, overlap_windows_cte("gold", "coalesce(clause, 'nan')", length_ids_sql, 2001, 2002), LOGITS, DECIDE)
    + "\nSELECT row_id, predicted_actors FROM decided",
    "tag_failed_rows": _with(GOLD, HEAD, overlap_windows_cte("gold", "coalesce(clause, 'nan')"), LOGITS, DECIDE,
                             "bad AS (SELECT DISTINCT row_id FROM wins WHERE window_ids[2] % 7 = 0)") + """
SELECT d.row_id, CASE WHEN b.row_id IS NULL THEN d.predicted_actors ELSE 'Unknown' END AS predicted_actors
FROM decided d LEFT JOIN bad b ON d.row_id = b.row_id""",
    "tag_sample": _with(
        GOLD, HEAD,
        f"sampled AS (SELECT * FROM gold ORDER BY {ORDER_KEY.format(k='row_id')}, row_id LIMIT {SAMPLE_N})",
        overlap_windows_cte("sampled", "coalesce(clause, 'nan')"), LOGITS, DECIDE)
    + "\nSELECT row_id, predicted_actors FROM decided",
    "tag_benchmark": _with(
        GOLD, HEAD, "items AS (SELECT item_id AS row_id, text AS clause FROM benchmark)",
        overlap_windows_cte("items", "coalesce(clause, 'nan')"), LOGITS, DECIDE)
    + "\nSELECT row_id, predicted_actors FROM decided",
    "tag_conversations": _with(
        GOLD, HEAD, "turns AS (SELECT {'conv_id': conv_id, 'turn': turn} AS row_id, text AS clause FROM conversations)",
        overlap_windows_cte("turns", "coalesce(clause, 'nan')"), LOGITS, DECIDE)
    + "\nSELECT row_id.conv_id AS conv_id, row_id.turn AS turn, predicted_actors FROM decided",
    "tag_probs": _with(GOLD, HEAD, overlap_windows_cte("gold", "coalesce(clause, 'nan')"), LOGITS, DECIDE)
    + "\nSELECT row_id, label_id, round(p, 6) AS p FROM probs",
    "clean_fill": _with(GOLD) + """
SELECT row_id, length(coalesce(clause, ''))::BIGINT AS clause_chars, coalesce(actors_text, '[]') AS predicted_actors,
       md5(coalesce(clause, 'nan')) AS text_md5 FROM clauses""",
    "clean_edges": _with(EDGES) + """
SELECT row_id, length(coalesce(clause, ''))::BIGINT AS clause_chars, coalesce(predicted_actors, '[]') AS predicted_actors,
       md5(coalesce(clause, 'nan')) AS text_md5 FROM edges""",
    "parse_edges": _with(EDGES) + """
SELECT row_id, array_to_string(items, '|') AS actors, status::INTEGER AS status FROM edge_lists""",
    "cut_text": _with(GOLD) + """
SELECT row_id, length(cut)::BIGINT AS cut_chars, md5(cut) AS cut_md5
FROM (SELECT row_id, CASE WHEN length(clause) > 2000 THEN substr(clause, 1, 2000) || '...' ELSE clause END AS cut
      FROM clauses)""",
    "profile": _with(GOLD) + """
SELECT count(*) AS n_rows, count(clause) AS n_clause, count(actors_text) AS n_predicted_actors FROM clauses""",
    "preview": _with(GOLD) + """
SELECT row_id, CASE WHEN length(clause) > 100 THEN substr(clause, 1, 100) || '...' ELSE clause END AS clause,
       actors_text AS predicted_actors
FROM clauses ORDER BY row_id LIMIT 3""",
    "parse_actors": _with(GOLD) + f"""
SELECT row_id, array_to_string(p, '|') AS actors, len(p)::INTEGER AS n_actors
FROM (SELECT row_id, {parse_sql('actors_text')} AS p FROM clauses)""",
    "sample_exact": f"""
SELECT doc_id AS row_id, md5(coalesce(text, '')) AS text_md5 FROM documents
ORDER BY {ORDER_KEY.format(k='doc_id')}, doc_id LIMIT {SAMPLE_N}""",
    "first_n": f"SELECT doc_id AS row_id, lang FROM documents ORDER BY doc_id LIMIT {FIRST_N}",
    "first_n_turns": f"""
SELECT conv_id, turn, length(text)::BIGINT AS chars FROM conversations ORDER BY conv_id, turn LIMIT {FIRST_N}""",
    "split_turns": f"""
SELECT row_id, CASE WHEN rn <= ceil(0.2::DOUBLE * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT row_id, row_number() OVER (ORDER BY {ORDER_KEY.format(k='row_id')}, row_id) AS rn, count(*) OVER () AS n
      FROM (SELECT conv_id::VARCHAR || '/' || turn::VARCHAR AS row_id FROM conversations))""",
    "split_hash": f"""
SELECT doc_id AS row_id, CASE WHEN {UNIT.format(k='doc_id')} < 0.2 THEN 'test' ELSE 'train' END AS split
FROM documents""",
    "split_exact": f"""
SELECT row_id, CASE WHEN rn <= ceil(0.2::DOUBLE * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT doc_id AS row_id, row_number() OVER (ORDER BY {ORDER_KEY.format(k='doc_id')}, doc_id) AS rn,
             count(*) OVER () AS n FROM documents)""",
    "label_vocab": _with(GOLD) + "\nSELECT label_id, label FROM vocab",
    "multi_hot": _with(GOLD, MULTI_HOT_IDS) + """
SELECT i.row_id, array_to_string(i.label_ids, '|') AS label_ids,
       (SELECT string_agg(CASE WHEN list_contains(i.label_ids, v.label_id) THEN '1' ELSE '0' END, ','
                          ORDER BY v.label_id) FROM vocab v) AS labels
FROM idsl i""",
    "multi_hot_joined": _with(GOLD, MULTI_HOT_IDS) + "\nSELECT row_id, array_to_string(label_ids, '|') AS label_ids FROM idsl",
    "label_wide": _with(GOLD) + """
SELECT g.row_id, (SELECT string_agg(v.label || '=' || list_contains(g.actors, v.label)::INTEGER::VARCHAR, ',' ORDER BY v.label_id)
                  FROM vocab v) AS labels
FROM gold g""",
    "label_cells": _with(GOLD) + "\nSELECT DISTINCT row_id, unnest(actors) AS label, 1 AS hit FROM gold",
    "warm_pairs": _with(GOLD, WARM) + "\nSELECT new_label, old_label FROM pairs",
    "warm_skipped": _with(GOLD, WARM)
    + "\nSELECT DISTINCT new_label FROM warm WHERE new_label NOT IN (SELECT new_label FROM pairs)",
    "warm_copy": _with(GOLD, WARM, HEAD, head_cte("old_head", "old_vocab", "old")) + """
SELECT n.label_id, n.label, n.feature, round(coalesce(o.weight, n.weight), 6) AS weight
FROM head n LEFT JOIN pairs p ON n.label = p.new_label
LEFT JOIN old_head o ON o.label = p.old_label AND o.feature = n.feature""",
    "windows_fixed": _with(GOLD, MULTI_HOT_IDS, fixed_windows_cte("gold", "clause")) + """
SELECT w.row_id, w."window", len(w.window_ids)::INTEGER AS n_tokens,
       array_to_string(list_resize(w.window_ids, 512, 0), ' ') AS input_ids,
       len(w.window_ids)::INTEGER AS mask_sum, array_to_string(i.label_ids, '|') AS label_ids
FROM wins w JOIN idsl i ON w.row_id = i.row_id""",
    "windows_overlap": _with(GOLD, overlap_windows_cte("gold", "clause")) + """
SELECT row_id, "window", len(window_ids)::INTEGER AS n_tokens,
       array_to_string(list_resize(window_ids, 512, 0), ' ') AS input_ids
FROM wins""",
    "confusion": _with(GOLD, HEAD, fixed_windows_cte("gold", "clause"), LOGITS, TRUTH, CELLS)
    + "\nSELECT tp, fp, fn, tn FROM conf",
    "macro_metrics": _with(GOLD, HEAD, fixed_windows_cte("gold", "clause"), LOGITS, TRUTH, CELLS) + "\n" + _macro(),
    "clause_metrics": _with(
        GOLD, HEAD, overlap_windows_cte("gold", "coalesce(clause, 'nan')"), LOGITS, DECIDE, TRUTH, """
dec_ids AS (SELECT row_id,
                   coalesce(list(label_id ORDER BY label_id) FILTER (WHERE p >= 0.5 AND NOT isnan(p)),
                            [first(label_id ORDER BY p DESC, label_id ASC)]) AS ids
            FROM probs GROUP BY row_id),
conf AS (SELECT count(*) FILTER (WHERE pred AND y = 1) AS tp, count(*) FILTER (WHERE pred AND y = 0) AS fp,
                count(*) FILTER (WHERE NOT pred AND y = 1) AS fn, count(*) FILTER (WHERE NOT pred AND y = 0) AS tn
         FROM (SELECT CASE WHEN t.row_id IS NULL THEN 0 ELSE 1 END AS y, list_contains(d.ids, p.label_id) AS pred
               FROM probs p JOIN dec_ids d ON p.row_id = d.row_id
               LEFT JOIN truth t ON p.row_id = t.row_id AND p.label_id = t.label_id))
""") + "\n" + _macro(),
    "metrics_file": _with(GOLD, HEAD, fixed_windows_cte("gold", "clause"), LOGITS, TRUTH, CELLS) + "\n" + _macro(),
    "bce_loss": _with(GOLD, HEAD, fixed_windows_cte("gold", "clause"), LOGITS, TRUTH, CELLS) + """
SELECT round(avg(greatest(logit, 0.0) - logit * y + ln(1 + exp(-abs(logit)))), 6) AS loss, count(*) AS n_cells
FROM cells""",
    "stance_templates": _with(GOLD, TEMPLATES, _STANCE_PREP) + """
SELECT p.row_id, p.pos, t.stance, t.template_id, replace(t.template, '{actor}', p.actor) AS hypothesis
FROM (SELECT row_id, unnest(actors) AS actor, unnest(range(0, len(actors)))::INTEGER AS pos FROM prep) p
CROSS JOIN templates t""",
    "stance_templates_first": _with(GOLD, FIRST_VERSION, _STANCE_PREP) + """
SELECT p.row_id, p.pos, t.stance, t.template_id, replace(t.template, '{actor}', p.actor) AS hypothesis
FROM (SELECT row_id, unnest(actors) AS actor, unnest(range(0, len(actors)))::INTEGER AS pos FROM prep) p
CROSS JOIN templates t""",
    "pair_scores": _with(GOLD, TEMPLATES, _STANCE_PREP, stance_ctes("prep"))
    + "\nSELECT row_id, pos, stance, template_id, round(score, 6) AS score FROM scored WHERE NOT guard",
    "pair_scores_general": _with(GOLD, TEMPLATES, _STANCE_PREP, stance_ctes("prep"))
    + "\nSELECT row_id, pos, stance, template_id, round(score, 6) AS score FROM scored WHERE NOT guard",
    "stance_pairs": _with(GOLD, TEMPLATES, _STANCE_PREP, stance_ctes("prep")) + """
SELECT row_id, pos, actor, stance, round(positive, 6) AS positive, round(negative, 6) AS negative,
       round(neutral, 6) AS neutral FROM pairs_out""",
    "stance_lists": _stance(),
    "stance_first_version": _stance(FIRST_VERSION),
    "stance_cut": _stance(prep=PREP.format(premise=CUT, actors=parse_sql("actors_text"), src="clauses")),
    "stance_truncated": _stance(max_length=MODEL_LENGTH),
    "stance_edges": _with(EDGES, TEMPLATES, PREP.format(premise="CASE WHEN status = 3 THEN '' ELSE coalesce(clause, '') END", actors="items", src="edge_lists"),
                          stance_ctes("prep")) + _LISTS,
    "stance_pair_model": _stance(),
    "stance_failing_model": _stance(fails="contains(template, 'unfavorable')"),
    "stance_tagged": _with(GOLD, HEAD, overlap_windows_cte("gold", "coalesce(clause, 'nan')"), LOGITS, DECIDE,
                           TEMPLATES,
                           "src AS (SELECT g.row_id, g.clause, string_split(d.predicted_actors, '|') AS actors "
                           "FROM gold g JOIN decided d ON g.row_id = d.row_id)",
                           PREP.format(premise=WHOLE, actors="actors", src="src"), stance_ctes("prep"))
    + "\nSELECT row_id, predicted_sentiments, sentiment_scores FROM lists",
    "roundtrip": _with(GOLD, TEMPLATES, _STANCE_PREP, stance_ctes("prep")) + """
SELECT c.row_id, md5(coalesce(c.clause, '')) AS clause_md5, l.predicted_sentiments
FROM clauses c JOIN lists l ON c.row_id = l.row_id""",
    "head_roundtrip": _with(GOLD, HEAD) + "\nSELECT label_id, label, feature, round(weight, 6) AS weight FROM head",
    "fit_head": _FIT + _EPOCHS,
    "fit_sharded": _FIT + _EPOCHS,
    "fit_resumed": _FIT + _EPOCHS,
    "fit_weighted": _fit(fit_ctes(FIT_EPOCHS, FIT_STEPS, slope=WEIGHTED_SLOPE, value=WEIGHTED_VALUE)) + _EPOCHS,
    "fit_batches": _fit(fit_ctes(BATCH_EPOCHS, BATCH_STEPS, batches=True)) + _EPOCHS,
    "mini_batches": _with(GOLD, fixed_windows_cte("gold", "clause"),
                          f"sides AS (SELECT DISTINCT row_id, {UNIT.format(k='row_id')} < 0.2 AS held FROM wins)",
                          *[order_cte(e, str(BATCH_SIZE)) for e in range(1, BATCH_EPOCHS + 1)]) + "\n" + " UNION ALL ".join(
        f'SELECT {e} AS epoch, batch, row_id, "window" FROM order{e}' for e in range(1, BATCH_EPOCHS + 1)),
    "tag_balanced": TAG_DOCUMENTS,
    "tag_by_path": TAG_DOCUMENTS,
    "csv_types": f"""
WITH d AS (SELECT d.doc_id, nullif(CASE WHEN d.text IN ({", ".join(_q(v) for v in NA_VALUES)}) THEN NULL ELSE d.text END, '') AS text,
                  CASE WHEN d.lang IN ({", ".join(_q(v) for v in NA_VALUES)}) THEN NULL ELSE d.lang END AS lang, length(d.text) AS chars,
                  (SELECT any_value(l.quality) FROM labels l WHERE l.doc_id = d.doc_id) AS quality FROM documents d)
SELECT 'doc_id' AS name, 'bigint' AS type, count(doc_id) AS n, round(sum(doc_id)::DOUBLE, 6) AS total FROM d
UNION ALL SELECT 'text', 'string', count(text), round(sum(length(text))::DOUBLE, 6) FROM d
UNION ALL SELECT 'lang', 'string', count(lang), round(sum(length(lang))::DOUBLE, 6) FROM d
UNION ALL SELECT 'chars', CASE WHEN count(chars) = count(*) THEN 'bigint' ELSE 'double' END, count(chars), round(sum(chars)::DOUBLE, 6) FROM d
UNION ALL SELECT 'quality', CASE WHEN count(quality) = count(*) THEN 'bigint' ELSE 'double' END, count(quality), round(coalesce(sum(quality), 0)::DOUBLE, 6) FROM d
UNION ALL SELECT 'eighth', 'double', count(*), round(sum(doc_id / 8.0)::DOUBLE, 6) FROM d
UNION ALL SELECT 'even', 'boolean', count(*), count(*) FILTER (WHERE doc_id % 2 = 0)::DOUBLE FROM d
UNION ALL SELECT 'nothing', 'double', 0, 0.0""",
    "published": """
SELECT doc_id, md5(coalesce(text, '')) AS text_md5, array_to_string(list_filter([lang, source], lambda x: x IS NOT NULL), '|') AS tags FROM documents""",
    "balanced_loads": f"""
SELECT {PARTS} AS parts, count(*) AS rows, sum(len(regexp_extract_all(coalesce(text, 'nan'), {TOKEN_RE})))::BIGINT AS tokens, TRUE AS even
FROM documents""",
    "hooked_macro": _with(GOLD, HEAD, fixed_windows_cte("gold", "clause"), LOGITS, TRUTH, CELLS) + "\n" + _macro(),
    "label_f1": _with(GOLD, HEAD, fixed_windows_cte("gold", "clause"), LOGITS, TRUTH, CELLS, """
per AS (SELECT label_id, count(*) FILTER (WHERE pred AND y = 1) AS tp, count(*) FILTER (WHERE pred AND y = 0) AS fp,
               count(*) FILTER (WHERE NOT pred AND y = 1) AS fn
        FROM (SELECT label_id, y, (1.0 / (1.0 + exp(-logit))) >= 0.5 AS pred FROM cells) GROUP BY label_id),
pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0 END AS p,
              CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0 END AS r FROM per)""") + """
SELECT label_id, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1 FROM pr""",
    "stance_distinct": _stance(),
    "distinct_pair_calls": _with(GOLD, _STANCE_PREP, """
each AS (SELECT premise, unnest(actors) AS actor FROM prep),
kept AS (SELECT premise, actor, count(*) AS n FROM each WHERE length(premise) > 0 AND length(actor) > 0 GROUP BY premise, actor)""") + """
SELECT count(*) AS pairs, coalesce(sum(n), 0)::BIGINT AS places, (9 * count(*))::BIGINT AS calls FROM kept""",
    "best_epoch": _FIT + "\nSELECT epoch, rank::INTEGER AS rank FROM ranked WHERE rank <= 2",
    "train_tag_stance": _with(
        GOLD, head_cte("first_head"), fixed_windows_cte("gold", "clause"), TRUTH, fit_ctes(FIT_EPOCHS, FIT_STEPS),
        _TAG_WINDOWS, LOGITS.replace("FROM wins)", "FROM tag_wins)"), DECIDE, TEMPLATES,
        "src AS (SELECT g.row_id, g.clause, string_split(d.predicted_actors, '|') AS actors FROM gold g JOIN decided d ON g.row_id = d.row_id)",
        PREP.format(premise=WHOLE, actors="actors", src="src"), stance_ctes("prep")) + """
SELECT l.row_id, d.predicted_actors, l.predicted_sentiments FROM lists l JOIN decided d ON l.row_id = d.row_id""",
}
