"""Hard negatives: rows of another label whose score with an anchor lies in a band below its positives' scores.

Vectors are integers (components scaled and floored) and scores are inner
products. An anchor's positives are the best rows of its own label; for each
positive the best rows of other labels within the band are returned.

One-bit codes. Vectors are rotated by a fixed random rotation; a row's code has
the signs of its rotated components, and beside it the row keeps its alignment
``a``, the inner product with the unit code vector. What is left of the row is
rotated again and gets a code of its own, and so on for ``CODES`` codes, each of
which leaves about 0.6 of the length; the length of the last residual is kept
too. An anchor is rotated alike and its components are rounded to a few bits, so
that its product ``b`` with a code vector is a sum of popcounts of bit planes,
up to the rounding, whose largest effect is known. The last residual stands at
right angles to the last code vector, so it adds at most the product of its
length and that of the anchor's part beside that vector (Cauchy-Schwarz):
``sum a b +- sqrt(|q|^2 - b_last^2) |residual|`` holds the score for certain. Rows
whose interval cannot be among the best, or misses every band, are left out; the
others are scored in integers. The codes decide only what is scored.

Anchors meet rows in blocks dealt by a hash of the ids: no label or value makes
a block large, and no pair of rows becomes a row of a table.

Defined cases: rows with a null id, a null label, a null or empty vector or a
null or non-finite component take no part; vectors of different lengths have no
score; a row is never its own positive or negative; ties go to the smaller id;
of rows repeated under one id the smallest (label, vector) is the anchor, and
each id is found once for a positive; anchors without positives or negatives
give no row; components of any size are scored exactly, and a score that is no
long is refused; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import best_per_query, block_join, stored
from .exact import inner_products

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOWEST, HIGHEST = 50, 95      # per cent of the positive's score
CODES = 7                     # one-bit codes of a row, each of what those before leave
BITS = 8                      # of an anchor's rounded component, its sign included
ROW_BLOCK, ANCHOR_BLOCK = 8192, 1024
TOGETHER = 8                  # anchors estimated at once
SEED = 5
FOUND = "query_id long, vec_id long, score long"
BAND = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def rotations(length: int, codes: int = CODES, seed: int = SEED) -> list[np.ndarray]:
    """Fixed random rotations, one per code; the signs make the factorisations unique."""
    g, out = np.random.default_rng(seed), []
    for _ in range(codes):
        q, r = np.linalg.qr(g.standard_normal((length, length)))
        out.append(q * np.where(np.diag(r) < 0, -1.0, 1.0))
    return out


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words."""
    packed = np.packbits(bits, axis=1)
    out = np.zeros((len(bits), -(-packed.shape[1] // 8) * 8), dtype=np.uint8)
    out[:, :packed.shape[1]] = packed
    return out.view(np.uint64)


def encode(vectors: np.ndarray, turns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(code words [rows, codes, words], alignments [rows, codes], length of the residual)`` of rows."""
    left, root = vectors, np.sqrt(vectors.shape[1])
    words, along = [], []
    for turn in turns:
        left = left @ turn
        up = left >= 0
        a = np.abs(left).sum(axis=1) / root
        left -= np.where(up, 1.0, -1.0) * (a / root)[:, None]
        words.append(_words(up))
        along.append(a)
    return np.stack(words, axis=1), np.stack(along, axis=1), np.sqrt((left ** 2).sum(axis=1))


def intervals(anchors: np.ndarray, codes: np.ndarray, along: np.ndarray, residual: np.ndarray, turns: list[np.ndarray],
              bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of every anchor's score with every row, ``[anchors, rows]``."""
    n, length = anchors.shape
    top, root, turned = (1 << (bits - 1)) - 1, np.sqrt(length), anchors
    q2 = (anchors ** 2).sum(axis=1, keepdims=True)
    middle, doubt, b = np.zeros((n, len(codes))), np.zeros((n, len(codes))), np.empty((n, len(codes)))
    word, ones = np.empty((n, len(codes)), dtype=np.uint64), np.empty((n, len(codes)), dtype=np.uint8)
    # the weighted popcounts of a code in the shortest type that holds them
    kind = np.uint16 if length << bits < 1 << 16 else np.uint32
    counted, shifted = np.empty((n, len(codes)), dtype=kind), np.empty((n, len(codes)), dtype=kind)
    for c, turn in enumerate(turns):
        turned = turned @ turn
        step = np.maximum(np.abs(turned).max(axis=1, keepdims=True) / top, np.finfo(float).tiny)
        level = np.rint(turned / step).astype(np.int64)
        error = np.abs(turned - step * level).sum(axis=1, keepdims=True) / root
        columns = np.ascontiguousarray(codes[:, c].T)
        counted[:] = 0
        for p in range(bits):
            plane = _words(((level + top) >> p & 1).astype(bool))
            for w, column in enumerate(columns):
                np.bitwise_and(plane[:, w, None], column[None], out=word)
                np.bitwise_count(word, out=ones)
                np.left_shift(ones, kind(p), out=shifted, dtype=kind)
                np.add(counted, shifted, out=counted)
        np.subtract(counted, float(top) * np.bitwise_count(columns).sum(axis=0, dtype=np.int64)[None], out=b)
        b *= 2 * step / root
        b -= level.sum(axis=1, keepdims=True) * (step / root)
        # the rounding of the anchor's components, and that of the sums themselves
        doubt += along[:, c][None] * (error + 1e-9 * np.sqrt(q2))
        middle += along[:, c][None] * b
    # what of the anchor is not along the last code vector, at most
    np.abs(b, out=b)
    b -= error
    np.maximum(b, 0.0, out=b)
    b *= b
    np.subtract(q2, b, out=b)
    np.maximum(b, 0.0, out=b)
    np.sqrt(b, out=b)
    b *= residual[None]
    # the last terms cover rounding, so that no row is left out by it
    b += doubt
    b += 1e-9 * np.sqrt(q2) * residual[None] + 1e-6
    return middle - b, middle + b


def prepared(table: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """``(vec_id, label, vec, code, along, residual)`` of the rows that take part."""
    number = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), number.alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0) & F.coalesce(sound, F.lit(False))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turns: dict[int, list[np.ndarray]] = {}
        for b in batches:
            lengths = b["vec"].map(len).to_numpy()
            for n in np.unique(lengths):
                some = b[lengths == n]
                if n not in turns:
                    turns[n] = rotations(int(n))
                x = np.floor(scale * np.stack(some["vec"].to_numpy()))
                code, along, residual = encode(x, turns[n])
                yield pd.DataFrame({"vec_id": some["vec_id"].to_numpy(), "label": some["label"].to_numpy(), "vec": list(x),
                                    "code": [c.tobytes() for c in code], "along": list(along), "residual": residual})

    return rows.mapInPandas(run, "vec_id long, label long, vec array<double>, code binary, along array<double>, residual double")


class _Block:
    """Rows of one length: codes, vectors, ids in order."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("vec_id", kind="stable")
        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        whole = np.stack(rows["vec"].to_numpy())
        self.largest, self.length = float(np.abs(whole).max()), whole.shape[1]
        # the shortest floats in which products of the block's own size are exact
        self.vectors = whole.astype(np.float32) if self.largest ** 2 * self.length < 1 << 24 else whole
        self.codes = np.stack([np.frombuffer(c, dtype=np.uint64) for c in rows["code"]])
        self.along, self.residual = np.stack(rows["along"].to_numpy()), rows["residual"].to_numpy()
        self.codes = self.codes.reshape(len(rows), self.along.shape[1], -1)
        self.new = np.concatenate([[True], self.ids[1:] != self.ids[:-1]])
        self.repeated = not self.new.all()

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        top = self.largest * float(np.abs(anchor).max()) * self.length
        if top < 1 << 24 and self.vectors.dtype == np.float32:
            return (self.vectors[rows] @ anchor.astype(np.float32)).astype(np.int64)
        if top < 1 << 53:
            return (self.vectors[rows].astype(np.float64) @ anchor).astype(np.int64)
        return inner_products(self.vectors[rows].astype(np.float64), anchor)

    def kth(self, values: np.ndarray, allowed: np.ndarray, k: int) -> float:
        """The ``k``-th largest of the allowed rows' values, counting an id once; -inf if there are fewer."""
        values = np.where(allowed, values, -np.inf)
        if self.repeated:
            values = np.maximum.reduceat(values, np.flatnonzero(self.new))
        return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Positions (in ``rows``) of the best ``k``, ties to the smaller id, an id once."""
        order = np.lexsort((self.ids[rows], -scores))
        if self.repeated:
            order = order[np.sort(np.unique(self.ids[rows][order], return_index=True)[1])]
        return order[:k]


def _by_length(q: pd.DataFrame, r: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray, _Block]]:
    """Some anchors at a time with their bounds on the rows of their length."""
    lengths_q, lengths_r = q["vec"].map(len).to_numpy(), r["vec"].map(len).to_numpy()
    for n in np.intersect1d(lengths_q, lengths_r):
        block, turns = _Block(r[lengths_r == n]), rotations(int(n))
        asked = q[lengths_q == n]
        for at in range(0, len(asked), TOGETHER):
            some = asked.iloc[at:at + TOGETHER]
            vectors = np.stack(some["vec"].to_numpy())
            low, high = intervals(vectors, block.codes, block.along, block.residual, turns)
            yield some, vectors, low, high, block


def _table(parts: list[tuple], names: tuple[str, ...]) -> pd.DataFrame:
    """One frame of parts that are tuples of numbers and arrays, the last one an array."""
    columns = [np.concatenate([np.full(len(p[-1]), p[i]) if np.ndim(p[i]) == 0 else p[i] for p in parts]) if parts else np.zeros(0)
               for i in range(len(names))]
    return pd.DataFrame(dict(zip(names, columns, strict=True))).astype("int64")


def _positives(q: pd.DataFrame, r: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best rows of the anchor's label in a block."""
    out = []
    for some, vectors, low, high, block in _by_length(q, r):
        for i, (anchor, label) in enumerate(zip(some["query_id"].to_numpy(), some["label"].to_numpy(), strict=True)):
            allowed = (block.labels == label) & (block.ids != anchor)
            rows = np.flatnonzero(allowed & ~(high[i] < block.kth(low[i], allowed, k)))
            scores = block.scores(rows, vectors[i])
            own = block.best(rows, scores, k)
            out.append((anchor, block.ids[rows[own]], scores[own]))
    return _table(out, ("query_id", "vec_id", "score"))


def band(score: int, lowest: int, highest: int) -> tuple[int, int]:
    """The smallest and the largest whole score between two per cents of a score."""
    return -((-lowest * score) // 100), (highest * score) // 100


def _negatives(q: pd.DataFrame, r: pd.DataFrame, k: int, lowest: int, highest: int) -> pd.DataFrame:
    """For each anchor and positive the ``k`` best rows of other labels within the band in a block."""
    out = []
    for some, vectors, low, high, block in _by_length(q, r):
        for i, (anchor, label, positives) in enumerate(zip(some["query_id"].to_numpy(), some["label"].to_numpy(), some["positives"], strict=True)):
            allowed = (block.labels != label) & (block.ids != anchor)
            bands = [(int(p["vec_id"]), int(p["score"]), *band(int(p["score"]), lowest, highest)) for p in positives]
            wanted = np.zeros(len(allowed), dtype=bool)
            for _, _, least, most in bands:
                inside = allowed & (low[i] >= least) & (high[i] <= most)
                wanted |= allowed & ~(high[i] < max(least, block.kth(low[i], inside, k))) & ~(low[i] > most)
            rows = np.flatnonzero(wanted)
            scores = block.scores(rows, vectors[i])
            for positive, score, least, most in bands:
                fits = np.flatnonzero((scores >= least) & (scores <= most))
                own = fits[block.best(rows[fits], scores[fits], k)]
                out.append((anchor, positive, block.ids[rows[own]], score, scores[own]))
    return _table(out, ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"))


def mine(table: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST,
         row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on ``vec_id``. A negative's score is at least
    ``lowest`` and at most ``highest`` per cent of the positive's.
    """
    rows = stored(prepared(table, id_col, vec_col, label_col, scale), "negatives-codes")
    anchors = stored(rows.where(is_anchor).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("label", "vec")).alias("own"))
                     .select("query_id", "own.label", "own.vec"), "negatives-anchors")
    row_blocks, anchor_blocks = rows.count() // row_block + 1, anchors.count() // anchor_block + 1
    near = block_join(rows, anchors, "vec_id", "query_id", row_blocks, anchor_blocks, lambda q, r: _positives(q, r, positives), FOUND)
    best = stored(best_per_query(near, positives, F.col("score").desc(), F.col("vec_id")), "negatives-positives")
    asked = anchors.join(best.groupBy("query_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives")), "query_id")
    far = block_join(rows, asked, "vec_id", "query_id", row_blocks, anchor_blocks,
                     lambda q, r: _negatives(q, r, negatives, lowest, highest), BAND)
    w = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), F.col("negative_id"))
    return (far.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
