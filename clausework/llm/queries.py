"""One driver query per operator, over its whole table with production parameters, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import ann, chat, fim, hard_negatives, html_text, language_id, mixing, packing, sharding, simhash, substring_dedup, suffix_dedup, topk

# shards of the placement query
SHARDS = [f"shard-{i:03d}" for i in range(64)]


def tokenizer_path(name: str) -> str:
    """Where the installed package keeps a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_tag_path_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per repeated paragraph or passage: ``(doc_id, start, end, n_words, cluster, members, keep_doc_id, kept)``."""
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents")).drop("row_hash", "para")


def op3_marginalised_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every document; held-out documents are not learned from."""
    docs = table(spark, sf_dir, "documents")
    out = language_id.held_out("doc_id")
    model = language_id.fit(docs.where(~out), tokenizer_path("piece_bpe_32k.model"))
    return language_id.identify(docs.select("doc_id", out.alias("held_out"), "text"), model).drop("text")


def op4_simhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every document: links at 2 or fewer of 64 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_permutation_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, slot, shard)`` of every document on 64 shards."""
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


def op6_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: 10 nearest of every row whose id is divisible by 100."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_token_level_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, formatted and read back, and of conversation -7, whose texts hold control strings."""
    import public_tokenizers

    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    vocabulary, pattern = tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return chat.digests(chat.format_conversations(turns, vocabulary, pattern), vocabulary, pattern)


def op8_pivot_table_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: 20 highest inner products of every row whose id is divisible by 20."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, source)`` of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of all documents' pieces."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op11_bounded_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every document."""
    found = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op12_one_bit_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of every row whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 50 == 0)


def op13_chunk_memo_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)`` of every document."""
    out = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tag_path_extraction": op1_tag_path_extraction,
    "op2_paragraph_minhash": op2_paragraph_minhash,
    "op3_marginalised_language_id": op3_marginalised_language_id,
    "op4_simhash_multi_index": op4_simhash_multi_index,
    "op5_permutation_sharding": op5_permutation_sharding,
    "op6_inverted_multi_index": op6_inverted_multi_index,
    "op7_token_level_chat": op7_token_level_chat,
    "op8_pivot_table_top_k": op8_pivot_table_top_k,
    "op9_source_mix": op9_source_mix,
    "op10_best_two_fit_packing": op10_best_two_fit_packing,
    "op11_bounded_bwt_dedup": op11_bounded_bwt_dedup,
    "op12_one_bit_hard_negatives": op12_one_bit_hard_negatives,
    "op13_chunk_memo_fim": op13_chunk_memo_fim,
}

ORACLE: dict[str, str] = {
    "op8_pivot_table_top_k": r"""
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, r.vec_id AS vec_id, CAST(list_dot_product(q.vec, r.vec) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id
  WHERE q.vec_id % 20 = 0),
t AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM t WHERE rank <= 20""",
    "op9_source_mix": r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS lim FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
             sum(source_size) OVER () AS total FROM s),
r AS (SELECT *,
        coalesce(sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lims_before,
        sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left
      FROM w),
c AS (SELECT *, lim * weights_left <= weight * (total - lims_before) AS limited FROM r),
g AS (SELECT *, total - coalesce(sum(CASE WHEN limited THEN lim END) OVER (), 0) AS rest,
             sum(CASE WHEN NOT limited THEN weight END) OVER () AS rest_weight FROM c),
t AS (SELECT source, source_size,
             CASE WHEN limited THEN CAST(lim AS DOUBLE) ELSE CAST(weight * rest AS DOUBLE) / CAST(rest_weight AS DOUBLE) END AS target
      FROM g),
b AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM t),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM b),
p AS (SELECT d.doc_id, d.source, d.size, e.source_size, e.target, e.epochs, e.budget - e.epochs * e.source_size AS over_,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, source, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, over_ - ahead)) AS BIGINT) AS taken
FROM p""",
    "op11_bounded_bwt_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS id, hex(encode(coalesce(text, ''))) AS x FROM documents),
y AS (SELECT r, id, k0, substr(x, 2 * k0 + 1, 2 * (128 + 49)) AS part
      FROM (SELECT r, id, x, unnest(range(0, len(x) // 2 - 49, 128)) AS k0 FROM d WHERE len(x) >= 100)),
w AS (SELECT r, id, k0, part, unnest(range(0, len(part) // 2 - 49)) AS j FROM y),
g AS (SELECT r, k0 + j AS k, id, min(id) OVER (PARTITION BY substr(part, 2 * j + 1, 100)) AS low FROM w),
e AS (SELECT r, k, CASE WHEN k - lag(k) OVER (PARTITION BY r ORDER BY k) <= 50 THEN 0 ELSE 1 END AS new FROM g WHERE low < id),
i AS (SELECT r, k, sum(new) OVER (PARTITION BY r ORDER BY k) AS run FROM e),
s AS (SELECT r, min(k) AS a, max(k) + 50 AS b FROM i GROUP BY r, run),
t AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM s GROUP BY r),
u AS (
  SELECT d.*, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
         list_concat([0], coalesce(t.b, [])) AS keep_from, list_concat(coalesce(t.a, []), [len(d.x) // 2]) AS keep_to
  FROM d LEFT JOIN t ON d.r = t.r)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
       sha256(unhex(array_to_string(list_transform(range(1, len(keep_to) + 1),
              lambda j: substr(x, 2 * keep_from[j] + 1, 2 * (keep_to[j] - keep_from[j]))), ''))) AS kept_sha256
FROM u""",
    "op12_one_bit_hard_negatives": r"""
WITH r AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, CAST(list_dot_product(a.vec, b.vec) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same)
  WHERE place <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
  WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
    "op13_chunk_memo_fim": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
l AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d),
c AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM l),
x AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM x""",
}
