"""Repeated passages: paragraph MinHash, banding, exact Jaccard, components; verbatim runs of words.

A paragraph is a line of at least ``min_words`` words; a line of over
``max_words`` is one too, and is also cut where a word's hash is the smallest
around it, so that a passage is cut alike wherever it stands. Paragraphs of the same words are one
text. Different texts whose word-shingle sets have a Jaccard similarity of at
least ``similarity`` are linked; of every component the first paragraph (by
document id, then position) stays and the others are to go. Lines over
``max_words`` give way to whole lines only, and pieces of one that goes take no
part, so that nothing goes for a place that goes itself.

Candidates come from MinHash bands, as many as give the wanted recall at the
threshold (``tune_bands``). Only band values that different texts share are
followed up. Their texts are compared by exact Jaccard in blocks: buckets with
the same members are compared once, a large bucket is cut into blocks whose
pairs are compared in separate tasks, and a block reports a spanning forest of
its links, not all pairs. The work is linear in copies and, within one bucket,
quadratic only in different near copies.

What the paragraphs leave (``repeated_passages``) is searched for verbatim runs
of ``PASSAGE_WORDS`` words and more that different documents share, wherever
they stand: inside a line, across line ends, in short lines. Of every
``PASSAGE_WORDS - GRAM_WORDS + 1`` runs of ``GRAM_WORDS`` words in a row the one
of the smallest hash is a gram; so every passage holds a gram whole, the same
one at each of its places. Around grams that two documents have, all windows of
``PASSAGE_WORDS`` words are counted by the hash of their words. Windows that
follow each other and are shared by the same documents are one passage, its
exact common span; it stays in the first document. The work is linear in the
words of the corpus and of what is repeated; no pair is compared. A window that
reaches into a paragraph that goes takes no part, and what only one document
repeats is no passage.

Defined cases: a null or empty text has no paragraph; shorter paragraphs are
left alone; rows repeated whole (same id and text) count as one document and
are edited alike; null ids come last in order; an empty table gives an empty
result; extra columns are ignored or, in ``without_repeats``, kept; a line of
over half a million characters is first cut at white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators._util import bounded_broadcast
from ._common import give_back, stored
from .components import connected_components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RECALL = 0.998
ROWS_PER_BAND = 4
MIN_WORDS = 20
MAX_WORDS = 200
# what a paragraph is: a line in one piece, a piece of a line, a line that is also there in pieces
LINE, PIECE, CUT_LINE = 0, 1, 2
# words on either side among which a cut of a long line has the smallest hash
CUT_RADIUS = 24
# a piece without such a place is cut after this many words
LONGEST_PIECE = 512
# different texts of a bucket that are compared in one block
BLOCK = 512
# words of the shortest verbatim passage, and of the grams that it is found by
PASSAGE_WORDS = 50
GRAM_WORDS = 20
# bytes hashed at once, and characters after which a line is cut
CHUNK = 1 << 19

# rows with a few spans each that are broadcast at most, some 20 MB; more are joined by a shuffle
BROADCAST_ROWS = 100_000

# odd multipliers of the hashes, from the digits of the golden ratio and its kin
BYTE_STEP = 0x9E3779B97F4A7C15
WORD_STEP = 0xC2B2AE3D27D4EB4F
WHOLE_STEP = 0x165667B19E3779F9


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS_PER_BAND) -> int:
    """The fewest bands of ``rows`` values that bring two texts of that similarity together with that probability."""
    bands = 1
    while 1 - (1 - similarity ** rows) ** bands < recall:
        bands += 1
    return bands


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(step: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``step ** i`` and its inverse modulo 2^64, for i up to ``n``."""
    up, down = np.full(n + 1, step, dtype=np.uint64), np.full(n + 1, pow(step, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int) -> np.ndarray:
    """A hash of each run ``values[start:end]`` that depends on nothing else."""
    up, down = _powers(step, len(values))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values * up[:-1], dtype=np.uint64)])
    return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hash_words(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the lines, in lower case, and where each line's words begin (and the last end)."""
    data = np.frombuffer("\n".join(lines).lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    letters = _mix(np.arange(1, 257, dtype=np.uint64))[data]
    words = _range_hashes(letters, starts, ends, BYTE_STEP)
    breaks = np.flatnonzero(data == 10)
    return words, np.concatenate([[0], np.searchsorted(starts, breaks), [len(starts)]]).astype(np.int64)


def _cuts(words: np.ndarray) -> list[int]:
    """Where the words of a long line are cut: at local minima of their hashes, and never later than ``LONGEST_PIECE``."""
    n, r = len(words), CUT_RADIUS
    padded = np.concatenate([np.zeros(r, dtype=np.uint64), words, np.zeros(r, dtype=np.uint64)])
    around = np.lib.stride_tricks.sliding_window_view(padded, 2 * r + 1)
    low = around.min(axis=1)
    places = np.flatnonzero((low == words) & ((around == low[:, None]).sum(axis=1) == 1))
    out = [0]
    for p in [*places.tolist(), n]:
        while p - out[-1] > LONGEST_PIECE:
            out.append(out[-1] + LONGEST_PIECE)
        if p > out[-1]:
            out.append(p)
    return out


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """A hash for every run of ``size`` words; position i is the run that begins there."""
    n = max(0, len(words) - size + 1)
    acc = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        acc = acc * np.uint64(WORD_STEP) + words[i:i + n]
    return _mix(acc)


def band_keys(shingles: np.ndarray, starts: np.ndarray, lengths: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """``(paragraph, band)`` keys: hashes of ``rows`` minima of differently mixed shingle hashes."""
    at = np.arange(lengths.sum()) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
    values = (shingles[at] >> np.uint64(32)).astype(np.uint32)
    offsets = np.cumsum(lengths) - lengths
    seeds = _mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64)).astype(np.uint32).reshape(2, -1)
    keys = np.empty((len(starts), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(starts), b + 1, dtype=np.uint64)
        for r in range(b * rows, (b + 1) * rows):
            low = np.minimum.reduceat(values * (seeds[0][r] | np.uint32(1)) + seeds[1][r], offsets)
            key = _mix(key * np.uint64(WORD_STEP) + low)
        keys[:, b] = key
    return keys


def _segments(line: str) -> Iterator[tuple[int, str]]:
    """The line, or parts of a very long one, with where they begin."""
    at = 0
    while len(line) - at > CHUNK:
        cut = max((line.rfind(c, at, at + CHUNK) for c in " \t"), default=-1)
        cut = cut if cut > at else at + CHUNK
        yield at, line[at:cut]
        at = cut
    yield at, line[at:]


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
               max_words: int = MAX_WORDS, shingle: int = SHINGLE_WORDS, bands: int | None = None,
               rows: int = ROWS_PER_BAND) -> DataFrame:
    """``(row_hash, doc_id, para, start, end, n_words, kind, h, bands array<long>)`` of every paragraph.

    ``start`` and ``end`` are code-point offsets in the text, ``h`` a hash of
    the words. Only the first paragraph of the same words in a batch carries
    ``bands``; they are null on its copies.
    """
    if min_words < shingle:
        raise ValueError("a paragraph must have a shingle's words at least")
    n_bands = tune_bands(rows=rows) if bands is None else bands
    def flush(held: list, seen: set) -> pa.RecordBatch:
        """The paragraphs of the held lines ``(row_hash, doc_id, line number, offset, line)``."""
        words, begin = hash_words([h[4] for h in held])
        counts = np.diff(begin)
        owner, first, last, what = [], [], [], []
        for i in np.flatnonzero(counts >= min_words).tolist():
            if counts[i] <= max_words:
                cuts = [0, int(counts[i])]
            else:
                cuts = _cuts(words[begin[i]:begin[i + 1]])
            units = [(a, b, PIECE if len(cuts) > 2 else LINE) for a, b in zip(cuts, cuts[1:], strict=False)]
            if len(cuts) > 2:
                units.append((0, int(counts[i]), CUT_LINE))
            for a, b, kind in units:
                if b - a >= min_words:
                    owner.append(i)
                    what.append(kind)
                    first.append(int(begin[i]) + a)
                    last.append(int(begin[i]) + b)
        if not owner:
            return pa.RecordBatch.from_pylist([], kinds)
        f, l_ = np.array(first), np.array(last)
        h = _range_hashes(words, f, l_, WHOLE_STEP)
        new = np.zeros(len(h), dtype=bool)
        for i, x in enumerate(h.tolist()):
            if x not in seen:
                seen.add(x)
                new[i] = True
        keys = iter(())
        if new.any():
            keys = iter(band_keys(shingle_hashes(words, shingle), f[new], (l_ - f)[new] - shingle + 1, n_bands, rows).view(np.int64))
        out = []
        spans: tuple[int, list] = (-1, [])
        for i, a, b, kind, x, is_new in zip(owner, first, last, what, h.view(np.int64).tolist(), new, strict=True):
            row_hash, doc_id, number, offset, line = held[i]
            start, end = 0, len(line)
            if b - a < counts[i]:
                if spans[0] != i:
                    spans = (i, [m.span() for m in _word(line)])
                start, end = spans[1][a - begin[i]][0], spans[1][b - begin[i] - 1][1]
            out.append((row_hash, doc_id, number, offset + start, offset + end, b - a, kind, x, next(keys) if is_new else None))
        return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)

    kinds = pa.schema([("row_hash", pa.int64()), ("doc_id", pa.int64()), ("para", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                       ("n_words", pa.int32()), ("kind", pa.int32()), ("h", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shortest = 2 * min_words - 1
        for batch in batches:
            held, size, seen = [], 0, set()
            for row_hash, doc_id, value in zip(batch["row_hash"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"], strict=True):
                text, offset = value.as_py() or "", 0  # one text at a time leaves Arrow's buffer
                if len(text) < shortest:
                    continue
                for number, line in enumerate(text.split("\n")):
                    if len(line) >= shortest:
                        for at, part in _segments(line):
                            held.append((row_hash, doc_id, number, offset + at, part))
                            size += len(part)
                            if size >= CHUNK:
                                yield flush(held, seen)
                                held, size = [], 0
                    offset += len(line) + 1
            if held:
                yield flush(held, seen)
        give_back()

    import re

    _word = re.compile(r"[^\x20\x09-\x0D]+").finditer
    return keyed(docs, id_col, text_col).mapInArrow(
        run, "row_hash long, doc_id long, para int, start long, end long, n_words int, kind int, h long, bands array<long>")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(row_hash, doc_id, text)``: a row's key is a hash of its id and text."""
    return docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_hash"),
                       F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def links(docs: DataFrame, paras: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          shingle: int = SHINGLE_WORDS, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: verified links between different paragraph texts, as hashes; a forest of each block's."""
    keys = paras.where("bands IS NOT NULL").select("h", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high").select("key")
    members = stored(keys.join(shared, "key").distinct(), "bucket-members")
    # buckets with the same members are one
    sets = (members.groupBy("key").agg(F.count("h").alias("n"), F.bit_xor("h").alias("x"), F.min("h").alias("low"), F.max("h").alias("high"))
            .groupBy("n", "x", "low", "high").agg(F.min("key").alias("key")).select("key", "n"))
    members = stored(members.join(sets, "key"), "bucket-sets")
    texts = stored(_texts(docs, paras, members.select("h").distinct(), id_col, text_col), "bucket-texts")
    # a member goes to every pair of blocks that its own block is part of
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    dealt = (members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64(F.lit("deal"), F.col("h")), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "h"))
    together = dealt.join(texts, "h").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "h")
    return together.mapInPandas(lambda batches: _compare(batches, shingle, similarity), "a long, b long")


def _texts(docs: DataFrame, paras: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(h, text)`` of the wanted paragraph hashes, read from one document that has each."""
    one = (paras.where("bands IS NOT NULL").join(wanted, "h", "left_semi")
           .groupBy("h").agg(F.min(F.struct("row_hash", "start", "end")).alias("at")))
    per_row = one.groupBy(F.col("at.row_hash").alias("row_hash")).agg(F.collect_set(F.struct("h", "at.start", "at.end")).alias("spans"))
    per_row = stored(per_row, "bucket-spans")
    rows = keyed(docs, id_col, text_col).select("row_hash", "text").join(bounded_broadcast(per_row, BROADCAST_ROWS), "row_hash")
    s = rows.select("text", F.explode("spans").alias("s"))
    text = F.expr("substring(text, CAST(s.start AS INT) + 1, CAST(s.end - s.start AS INT))")
    return s.select("s.h", text.alias("text")).dropDuplicates(["h"])


def _compare(batches: Iterator[pd.DataFrame], shingle: int, similarity: float) -> Iterator[pd.DataFrame]:
    """Links within each (key, i, j) group of ordered rows; one group is held at a time."""
    group, hs, texts, found = None, [], [], []
    for b in batches:
        for key, i, j, h, text in zip(b["key"], b["i"], b["j"], b["h"], b["text"], strict=True):
            if (key, i, j) != group:
                found += forest(hs, texts, shingle, similarity)
                group, hs, texts = (key, i, j), [], []
            hs.append(h)
            texts.append(text)
        yield pd.DataFrame(found, columns=["a", "b"]).astype("int64")
        found = []
    yield pd.DataFrame(forest(hs, texts, shingle, similarity), columns=["a", "b"]).astype("int64")


def forest(hs: list[int], texts: list[str], shingle: int, similarity: float) -> list[tuple[int, int]]:
    """A spanning forest of the links among the texts: exact Jaccard of their shingle sets."""
    if len(hs) < 2:
        return []
    words, begin = hash_words([" ".join(t.split("\n")) for t in texts])
    sets = [np.unique(shingle_hashes(words[a:b], shingle)) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    sizes = np.array([len(s) for s in sets])
    if len(hs) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(hs[0], hs[1])] if both >= similarity * (sizes.sum() - both) else []
    # shared shingles of all pairs, from a 0/1 matrix over the shingles that occur
    vocabulary, column = np.unique(np.concatenate(sets), return_inverse=True)
    common = np.zeros((len(hs), len(hs)), dtype=np.float32)
    line = np.repeat(np.arange(len(hs)), sizes)
    step = max(1, (1 << 22) // len(hs))
    order = np.argsort(column, kind="stable")
    line, column = line[order], column[order]
    for at in range(0, len(vocabulary), step):
        lo, hi = np.searchsorted(column, [at, at + step])
        m = np.zeros((len(hs), min(step, len(vocabulary) - at)), dtype=np.float32)
        m[line[lo:hi], column[lo:hi] - at] = 1
        common += m @ m.T
    linked = common >= similarity * (sizes[:, None] + sizes[None] - common) - 1e-6
    out, left = [], set(range(len(hs)))
    while left:
        todo = [left.pop()]
        while todo and left:
            x = todo.pop()
            near = [y for y in np.flatnonzero(linked[x]).tolist() if y in left]
            left.difference_update(near)
            todo += near
            out += [(hs[x], hs[y]) for y in near]
    return out


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                        max_words: int = MAX_WORDS, shingle: int = SHINGLE_WORDS, similarity: float = SIMILARITY,
                        block: int = BLOCK) -> DataFrame:
    """Every paragraph that is repeated, near copies included.

    ``(row_hash, doc_id, para, start, end, n_words, cluster, members,
    keep_doc_id, kept)``: ``cluster`` names the component, ``keep_doc_id`` is
    the document whose paragraph stays, and ``kept`` marks that paragraph.
    """
    paras = stored(paragraphs(docs, id_col, text_col, min_words, max_words, shingle, tune_bands(similarity)), "paragraphs")
    groups = connected_components(links(docs, paras, id_col, text_col, shingle, similarity, block), "a", "b")
    copies = paras.groupBy("h").count().where("count > 1").select("h")
    named = (copies.join(groups.withColumnRenamed("node", "h"), "h", "full_outer")
             .select("h", F.coalesce("component", "h").alias("cluster")))
    found = stored(paras.drop("bands").join(named, "h"), "repeats")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash", "para", "start")

    def firsts(units: DataFrame) -> DataFrame:
        """``(cluster, keeper, members)`` of the clusters with several places."""
        return (units.groupBy("cluster").agg(F.min(place).alias("keeper"), F.max(place).alias("last"), F.count(F.lit(1)).alias("members"))
                .where(F.col("keeper") != F.col("last")).drop("last"))

    # whole lines, where a cut line is among them
    clusters = bounded_broadcast(stored(found.where(F.col("kind") == CUT_LINE).select("cluster").distinct(), "line-clusters"), BROADCAST_ROWS)
    lines = stored(found.where(F.col("kind") != PIECE).join(clusters, "cluster", "left_semi"), "whole-lines")
    lines = stored(lines.join(firsts(lines), "cluster").withColumn("kept", place == F.col("keeper")), "repeated-lines")
    gone = lines.where(~F.col("kept")).select(*[F.col(c).alias(f"gone_{c}") for c in ("row_hash", "para", "start", "end")]).distinct()
    gone = bounded_broadcast(stored(gone, "gone-lines"), BROADCAST_ROWS)
    inside = ((F.col("row_hash") == F.col("gone_row_hash")) & (F.col("para") == F.col("gone_para"))
              & (F.col("start") >= F.col("gone_start")) & (F.col("end") <= F.col("gone_end")))
    # the other lines, and pieces of lines that stay
    units = found.where(F.col("kind") != CUT_LINE).join(gone, inside, "left_anti")
    found = units.join(firsts(units), "cluster").withColumn("kept", place == F.col("keeper"))
    columns = ["row_hash", "doc_id", "para", "start", "end", "n_words", "cluster", "members", F.col("keeper.doc_id").alias("keep_doc_id"), "kept"]
    # a line in one piece that stays among the whole lines is listed with the pieces it meets, if any
    met = units.join(lines.where(F.col("kept") & (F.col("kind") == LINE)).select("cluster").distinct(), "cluster", "left_semi")
    alone = F.col("kept") & (F.col("kind") == LINE)
    lines = lines.where(~alone).unionByName(lines.where(alone).join(firsts(met).select("cluster"), "cluster", "left_anti"))
    return found.select(*columns).unionByName(lines.select(*columns))


def _gone_spans(found: DataFrame, name: str) -> DataFrame:
    """``(gone_hash, gone array<struct<start, end>>)``: per row, the spans that are not kept; broadcast if few."""
    spans = (found.where(~F.col("kept")).groupBy(F.col("row_hash").alias("gone_hash"))
             .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("gone")))
    return bounded_broadcast(stored(spans, name), BROADCAST_ROWS)


def _left_over(text: str, gone: list | None) -> tuple[list[int], list[str]]:
    """The parts of the text between the spans that go, and where they begin."""
    offsets, parts, at = [], [], 0
    for g in [*(gone or []), {"start": len(text), "end": len(text)}]:
        if g["start"] > at:
            offsets.append(at)
            parts.append(text[at:g["start"]].replace("\n", " "))
        at = max(at, g["end"])
    return offsets, parts


def gram_places(words: np.ndarray, size: int = GRAM_WORDS, passage: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Where grams begin, and their hashes: any run of ``passage`` words holds one whole, chosen by these words alone."""
    if len(words) < passage:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    hashes = shingle_hashes(words, size)
    around = np.lib.stride_tricks.sliding_window_view(hashes, passage - size + 1)
    places = np.unique(around.argmin(axis=1) + np.arange(len(around)))
    return places, hashes[places]


def _grams(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(key, row_hash, at)``: the grams of what the spans leave; ``at`` counts the row's words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shortest = 2 * PASSAGE_WORDS - 1
        for batch in batches:
            for row_hash, value, spans in zip(batch["row_hash"].to_pylist(), batch["text"], batch["gone"], strict=True):
                text = value.as_py() or ""  # one text at a time leaves Arrow's buffer
                if len(text) < shortest:
                    continue
                words, begin = hash_words(_left_over(text, spans.as_py())[1])
                found = [(a + at, h) for a, b in zip(begin[:-1], begin[1:], strict=True) for at, h in [gram_places(words[a:b])]]
                at, h = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, dtype=np.int64),) * 2
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(h), row_hash)), pa.array(at.astype(np.int32))],
                                                 names=["key", "row_hash", "at"])
        give_back()

    rows = keyed(docs, id_col, text_col).join(gone, F.col("row_hash") == F.col("gone_hash"), "left")
    return rows.select("row_hash", "text", "gone").mapInArrow(run, "key long, row_hash long, at int")


def _windows(docs: DataFrame, gone: DataFrame, grams: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(h, row_hash, doc_id, at, start, end)`` of every window of ``PASSAGE_WORDS`` words around the given grams."""
    kinds = pa.schema([("h", pa.int64()), ("row_hash", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32()),
                       ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch["row_hash"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"], batch["gone"], batch["places"])
            for row_hash, doc_id, value, spans, held in zip(*columns, strict=True):
                offsets, parts = _left_over(value.as_py(), spans.as_py())
                words, begin = hash_words(parts)
                places = np.array(held.as_py(), dtype=np.int64)
                part = np.searchsorted(begin, places, side="right") - 1
                first = np.maximum(begin[part], places + GRAM_WORDS - PASSAGE_WORDS)
                last = np.minimum(begin[part + 1] - PASSAGE_WORDS, places)
                at = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)]))
                h = _range_hashes(words, at, at + PASSAGE_WORDS, WHOLE_STEP)
                edges = np.array([(o + m.start(), o + m.end()) for o, p in zip(offsets, parts, strict=True) for m in _word(p)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(np.full(len(at), row_hash)), pa.array([doc_id] * len(at), pa.int64()),
                     pa.array(at.astype(np.int32)), pa.array(edges[at, 0]), pa.array(edges[at + PASSAGE_WORDS - 1, 1])], schema=kinds)
        give_back()

    import re

    _word = re.compile(r"[^\x20\x09-\x0D]+").finditer
    per_row = grams.groupBy(F.col("row_hash").alias("held_hash")).agg(F.sort_array(F.collect_set("at")).alias("places"))
    per_row = bounded_broadcast(stored(per_row, "gram-rows"), BROADCAST_ROWS)
    rows = (keyed(docs, id_col, text_col).join(per_row, F.col("row_hash") == F.col("held_hash"))
            .join(gone, F.col("row_hash") == F.col("gone_hash"), "left"))
    return rows.select("row_hash", "doc_id", "text", "gone", "places").mapInArrow(
        run, "h long, row_hash long, doc_id long, at int, start long, end long")


def verbatim_passages(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every verbatim passage in what the spans of ``gone`` leave, with the columns of ``repeated_paragraphs``.

    ``cluster`` is the hash of the passage's first window; ``para`` is null, as
    a passage may run over several lines. Rows repeated whole are listed once.
    """
    grams = stored(_grams(docs, gone, id_col, text_col), "grams")
    shared = stored(grams.groupBy("key").agg(F.min("row_hash").alias("low"), F.max("row_hash").alias("high"))
                    .where("low <> high").select("key"), "shared-grams")
    held = grams.join(bounded_broadcast(shared, BROADCAST_ROWS), "key", "left_semi")
    windows = stored(_windows(docs, gone, held, id_col, text_col).distinct(), "windows")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash", "at")
    counts = (windows.groupBy("h").agg(F.min(place).alias("keeper"), F.count(F.lit(1)).alias("members"),
                                       F.bit_xor(F.xxhash64("row_hash")).alias("rows"), F.min("row_hash").alias("low"),
                                       F.max("row_hash").alias("high")).where("low <> high").drop("low", "high"))
    found = (windows.join(bounded_broadcast(stored(counts, "window-counts"), BROADCAST_ROWS), "h")
             .withColumn("kept", F.col("row_hash") == F.col("keeper.row_hash")))
    before = Window.partitionBy("row_hash").orderBy("at")
    follows = F.col("at") == F.lag("at").over(before) + 1
    for c in ("keeper.row_hash", "members", "rows"):
        follows = follows & (F.col(c) == F.lag(c).over(before))
    found = (found.withColumn("new", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
             .withColumn("run", F.sum("new").over(before)))
    runs = found.groupBy("row_hash", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n"),
        F.min(F.struct("at", "doc_id", "h", "members", "keeper", "kept")).alias("first"))
    return runs.select("row_hash", "first.doc_id", F.lit(None).cast("int").alias("para"), "start", "end",
                       (F.col("n") + PASSAGE_WORDS - 1).cast("int").alias("n_words"), F.col("first.h").alias("cluster"), "first.members",
                       F.col("first.keeper.doc_id").alias("keep_doc_id"), "first.kept")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``repeated_paragraphs``, and the verbatim passages in what stays of the texts without those that go."""
    found = stored(repeated_paragraphs(docs, id_col, text_col, **options), "repeated-paragraphs")
    return found.unionByName(verbatim_passages(docs, _gone_spans(found, "paragraph-spans"), id_col, text_col))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without its repeated paragraphs and passages (all but the kept one of each cluster), columns kept.

    A line that goes takes its line break with it; ``n_chars`` is counted anew.
    Documents of which no word is left go.
    """
    spans = _gone_spans(repeated_passages(docs, id_col, text_col, **options), "repeat-spans")

    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, gone in batches:
            # one text at a time leaves Arrow's buffer
            yield pa.array((_without(t.as_py(), g.as_py()) for t, g in zip(texts, gone, strict=True)), pa.string(), size=len(texts))
        give_back()

    # else the plan cuts once for the filter and once for the column
    cut = cut.asNondeterministic()

    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("own_hash"))
    rows = rows.join(spans, F.col("own_hash") == F.col("gone_hash"), "left")
    untouched = rows.where(F.col("gone").isNull()).select("row.*")
    edited = rows.where(F.col("gone").isNotNull()).withColumn(
        "edited", cut(F.col(f"row.{text_col}"), F.transform("gone", lambda s: F.array(s["start"], s["end"]))))
    edited = edited.where(F.col("edited").rlike(r"[^\x20\x09-\x0D]"))
    new = {text_col: F.col("edited"), "n_chars": F.length("edited").cast("long")}
    return untouched.unionByName(edited.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]))


def _without(text: str, spans: list) -> str:
    """The text without the spans; a line left blank by that goes with its line break."""
    parts, at, start, end = [], 0, 0, 0
    for start, end in _merged(spans):
        parts.append(text[at:start])
        at = end
        if text[at:at + 1] == "\n" and (start == 0 or text[start - 1] == "\n"):
            at += 1
    left = "".join([*parts, text[at:]])
    # the last line takes the break before it
    return left[:-1] if at == end == len(text) and left.endswith("\n") and text[start - 1] == "\n" else left


def _merged(spans: list) -> list[tuple[int, int]]:
    """The ordered spans, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for start, end in spans:
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((int(start), int(end)))
    return out
