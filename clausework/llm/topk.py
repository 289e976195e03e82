"""Exact top-k by inner product with a pivot table.

Vectors are integer (components scaled and floored). Every row's distances to
a fixed set of pivots are computed once. For a query the table gives, by the
triangle inequality, a lower bound of its distance to each row, the largest
difference of their distances to a pivot, and so, as ``2 <q, x> = |q|^2 +
|x|^2 - |q - x|^2``, an upper bound of the score. Rows are evaluated in the
order of their bounds until the next bound is below the k-th best score; what
is left cannot be among the best.

The pivots are chosen far apart from a bounded sample; they affect speed only,
never the result. Queries meet rows in blocks dealt by a hash of the ids: no
value makes a block large, and no pair of rows becomes a row of a table.

Defined cases: vectors that are null, empty or hold a null or non-finite
component take no part; vectors of different lengths have no score (pivots have
the most frequent length, other rows are evaluated without bounds); components
of any size are scored exactly, and a score that is no long is refused; a row
is never its own answer; ties go to the smaller id; of rows repeated under one id the smallest
vector asks and the best one is found, once; with fewer candidates than asked
for, all are returned; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import best_per_query, block_join, sound_vectors, stored
from .exact import inner_products

SCALE = 64
PIVOTS = 32
# rows from which the pivots are chosen, about
SAMPLE_ROWS = 2_000
ROW_BLOCK = 8192
QUERY_BLOCK = 2048
# rows evaluated at once
STEP = 512
# queries whose bounds are computed at once
BOUNDS = 32
FOUND = "query_id long, vec_id long, score long"


def choose_pivots(sample: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Rows of ``sample`` that are far apart: each next one is the farthest from those before."""
    chosen = [int(((sample - sample.mean(axis=0)) ** 2).sum(axis=1).argmax())]
    near = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(pivots, len(sample)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def scaled(vectors, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` of every component, as doubles, which hold whole numbers of any size."""
    return np.floor(scale * np.stack(list(vectors)).astype(np.float64))


def with_pivot_distances(vectors: DataFrame, pivots: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``(vec_id, vec, far array<double>)``: scaled vectors and their distances to the pivots; none for another length."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            lengths = b["vec"].map(len).to_numpy()
            for n in np.unique(lengths):
                some = b[lengths == n]
                x = scaled(some["vec"], scale)
                with np.errstate(over="ignore"):
                    far = np.sqrt(np.stack([((x - p) ** 2).sum(axis=1) for p in pivots], axis=1)) if n == pivots.shape[1] else np.zeros((len(x), 0))
                yield pd.DataFrame({"vec_id": some["vec_id"].to_numpy(), "vec": list(x), "far": list(far)})

    return vectors.mapInPandas(run, "vec_id long, vec array<double>, far array<double>")


def top_k(table: DataFrame, is_query: F.Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE, pivots: int = PIVOTS, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows with the highest inner product for every row that ``is_query``.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = table.sparkSession
    vectors = stored(sound_vectors(table, id_col, vec_col, any_length=True), "top-vectors")
    rows = vectors.count()
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    parts = 1 << 20
    drawn = F.pmod(F.xxhash64(F.lit("pivot"), F.col("vec_id")), F.lit(parts))
    some = vectors.where(drawn < min(parts, parts * SAMPLE_ROWS // rows + 1)).select("vec").orderBy("vec").toPandas()["vec"].to_list()
    some = some or [vectors.first()["vec"]]
    # the pivots have the length that most of the sample has
    lengths, counts = np.unique([len(v) for v in some], return_counts=True)
    length = lengths[len(counts) - 1 - counts[::-1].argmax()]
    chosen = choose_pivots(scaled([v for v in some if len(v) == length], scale), pivots)
    index = stored(with_pivot_distances(vectors, chosen, scale), "top-index")
    queries = index.where(is_query).withColumnRenamed("vec_id", "query_id")
    n = queries.count()
    found = block_join(index, queries, "vec_id", "query_id", rows // row_block + 1, n // query_block + 1,
                       lambda q, r: _search_block(q, r, k), FOUND)
    return best_per_query(found, k, F.col("score").desc(), F.col("vec_id")).select("query_id", "rank", "vec_id", "score")


def _exact_type(largest: float, length: int) -> type | None:
    """The smallest floating type in which inner products of such components are exact, if there is one."""
    top = largest * largest * length
    return np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else None


def _search_block(q: pd.DataFrame, r: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best rows of a block for each query of a block."""
    none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
    if not len(q) or not len(r):
        return none
    r = r.sort_values("vec_id", kind="stable")
    q = q.assign(order_=[tuple(v) for v in q["vec"]]).sort_values(["query_id", "order_"]).drop_duplicates("query_id")
    lengths_q, lengths_r = q["vec"].map(len).to_numpy(), r["vec"].map(len).to_numpy()
    found = [_search_length(q[lengths_q == n], r[lengths_r == n], k) for n in np.intersect1d(lengths_q, lengths_r)]
    return pd.concat(found) if found else none


def _search_length(q: pd.DataFrame, r: pd.DataFrame, k: int) -> pd.DataFrame:
    """The same for vectors of one length."""
    whole, asked, ids = np.stack(r["vec"].to_numpy()), np.stack(q["vec"].to_numpy()), r["vec_id"].to_numpy()
    kind = _exact_type(max(np.abs(whole).max(), np.abs(asked).max()), whole.shape[1])
    x, a = (whole, asked) if kind is None else (whole.astype(kind), asked.astype(kind))
    score = inner_products if kind is None else lambda rows, v: (rows @ v).astype(np.int64)
    far, far_q = np.ascontiguousarray(np.stack(r["far"].to_numpy()).T), np.stack(q["far"].to_numpy())
    repeated = len(np.unique(ids)) < len(ids)
    with np.errstate(over="ignore", invalid="ignore"):
        size, size_q = (whole ** 2).sum(axis=1), (asked ** 2).sum(axis=1)
        # differences of distances are taken in short floats, less what rounding may have added to them
        longest = max(far.max(initial=0.0), far_q.max(initial=0.0))
        short = np.float32 if longest < 1e18 else np.float64
    far, far_q, slack = far.astype(short), far_q.astype(short), 1e-6 * longest
    apart, one = np.empty((BOUNDS, len(ids)), dtype=short), np.empty((BOUNDS, len(ids)), dtype=short)
    names, found_ids, found = [], [], []
    for first in range(0, len(a), BOUNDS):
        some = slice(first, min(first + BOUNDS, len(a)))
        n = some.stop - first
        apart[:n] = 0
        with np.errstate(over="ignore", invalid="ignore"):
            for p in range(len(far)):
                np.subtract(far_q[some, p][:, None], far[p][None], out=one[:n])
                np.abs(one[:n], out=one[:n])
                np.maximum(apart[:n], one[:n], out=apart[:n])
            least = np.maximum(apart[:n].astype(np.float64) - slack, 0.0)
            norms = size_q[some][:, None] + size[None]
            # the slack covers rounding, so that no row is left out by it
            bounds = (norms - least ** 2) / 2 + 1e-9 * norms + 1e-6
        if len(far) == 0:
            bounds[:] = np.inf
        bounds[np.isnan(bounds)] = np.inf
        for i, query_id in enumerate(q["query_id"].to_numpy()[some]):
            got = _best(x, a[first + i], bounds[i], ids, query_id, k, repeated, score)
            names.append(np.full(len(got[0]), query_id))
            found_ids.append(got[0])
            found.append(got[1])
    return pd.DataFrame({"query_id": np.concatenate(names), "vec_id": np.concatenate(found_ids), "score": np.concatenate(found)})


def _best(x: np.ndarray, q: np.ndarray, bound: np.ndarray, ids: np.ndarray, query_id: int, k: int,
          repeated: bool, score: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Evaluate rows in the order of their bounds until none left can be among the ``k`` best."""
    best_ids, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    order = np.argsort(-bound)
    order = order[ids[order] != query_id]
    falling = -bound[order]
    at, step = 0, STEP
    while at < len(order):
        end = min(len(order), at + step)
        if len(best) == k:  # a row whose bound is below the k-th best score is not among the best
            end = min(end, int(np.searchsorted(falling, -best[-1], side="right")))
            if end <= at:
                break
        some = order[at:end]
        scores, own = score(x[some], q), ids[some]
        if len(best) == k:
            keep = scores >= best[-1]
            scores, own = scores[keep], own[keep]
        best_ids, best = np.concatenate([best_ids, own]), np.concatenate([best, scores])
        ranked = np.lexsort((best_ids, -best))
        if repeated:  # rows under one id: the best one counts
            ranked = ranked[np.sort(np.unique(best_ids[ranked], return_index=True)[1])]
        best_ids, best = best_ids[ranked[:k]], best[ranked[:k]]
        at, step = end, 8 * STEP
    return best_ids, best
