"""Approximate nearest neighbours with an inverted multi-index.

The two halves of a vector are quantised by codebooks of their own; a vector's
cell is its pair of centroids. A query sorts the centroids of each half by
distance and visits the pairs in order of their summed distance with a heap,
until the cells hold a given share of all entries, and as many as ``k`` other ids
need. The entries of the visited cells are reranked by exact distance.

The codebooks are fitted on a bounded sample (at most about ``sample_rows``
vectors) by a few rounds of k-means over Spark tasks; every vector is indexed.
Cell populations are one row per cell, ``centroids ** 2`` at most. Index and
queries are dealt to blocks by a hash of their ids; a block keeps its entries
by cell and reads only those of visited cells, so neither a full cell nor a
frequent vector makes a task large.

The share to visit is the price of recall and depends on the data; the default
reaches a recall of 0.95 and more on vectors that have hardly any structure.

Defined cases: vectors that are null, zero, hold a null or non-finite component
or have another length than most take no part; a row is never its own
neighbour; ties go to the smaller id; of rows repeated under one id the
smallest vector asks and the nearest one is found, once; with fewer candidates
than asked for, all are returned; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import best_per_query, block_join, sound_vectors, stored

CENTROIDS = 64
SAMPLE_ROWS = 20_000
ROUNDS = 6
VISIT_SHARE = 0.6
ROW_BLOCK = 8192
QUERY_BLOCK = 4096
FOUND = "query_id long, vec_id long, score double"


def nearest_centroid(half: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids ** 2).sum(axis=1)[None] - 2 * half @ centroids.T).argmin(axis=1)


def fit_codebooks(vectors: DataFrame, rows: int, centroids: int = CENTROIDS, sample_rows: int = SAMPLE_ROWS,
                  rounds: int = ROUNDS) -> list[np.ndarray]:
    """A codebook for each half of the vectors in ``vec``, from a sample drawn by a hash of the id."""
    parts = 1 << 20
    drawn = F.pmod(F.xxhash64(F.lit("sample"), F.col("vec_id")), F.lit(parts))
    sample = stored(vectors.where(drawn < min(parts, parts * sample_rows // rows + 1)).coalesce(8), "ann-sample")
    start = sample.orderBy(F.xxhash64("vec_id"), "vec").limit(centroids).collect()
    first = np.array([r["vec"] for r in start], dtype=np.float64)
    cut = first.shape[1] // 2
    books = [first[:, :cut], first[:, cut:]]
    for _ in range(rounds):
        def sums(batches: Iterator[pd.DataFrame], books: list = books) -> Iterator[pd.DataFrame]:
            for b in batches:
                x = np.stack(b["vec"].to_numpy())
                for h, half in enumerate((x[:, :cut], x[:, cut:])):
                    at = nearest_centroid(half, books[h])
                    for c in np.unique(at):
                        yield pd.DataFrame({"half": [h], "c": [c], "n": [int((at == c).sum())], "total": [half[at == c].sum(axis=0)]})

        # a row per centroid from each of at most 8 tasks' batches
        got = sample.select("vec").mapInPandas(sums, "half int, c int, n long, total array<double>").toPandas()
        books = [b.copy() for b in books]
        for (h, c), g in got.groupby(["half", "c"]):
            books[h][c] = np.sum(np.stack(g["total"].to_numpy()), axis=0) / g["n"].sum()
    return books


def cells_of(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``(vec_id, vec, cell)`` of every vector."""
    cut, k = books[0].shape[1], len(books[1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = np.stack(b["vec"].to_numpy())
                cell = nearest_centroid(x[:, :cut], books[0]) * k + nearest_centroid(x[:, cut:], books[1])
                yield pd.DataFrame({"vec_id": b["vec_id"], "vec": b["vec"], "cell": cell.astype(np.int32)})

    return vectors.mapInPandas(run, "vec_id long, vec array<double>, cell int")


def visit(query: np.ndarray, books: list[np.ndarray], population: np.ndarray, wanted: float) -> list[int]:
    """The cells of ``query`` in order of summed centroid distance until they hold ``wanted`` vectors."""
    cut, k = books[0].shape[1], len(books[1])
    near = [((b - q) ** 2).sum(axis=1) for b, q in zip(books, (query[:cut], query[cut:]), strict=True)]
    order = [np.argsort(d, kind="stable") for d in near]
    dist = [d[o].tolist() for d, o in zip(near, order, strict=True)]
    first, second = order[0].tolist(), order[1].tolist()
    heap, out, held, done = [(dist[0][0] + dist[1][0], 0, 0)], [], 0, [0] * len(first)
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = first[i] * k + second[j]
        if population[cell]:
            out.append(cell)
            held += population[cell]
        done[i] = j + 1
        # a pair enters once both its predecessors have been visited
        if i + 1 < len(first) and done[i + 1] == j:
            heapq.heappush(heap, (dist[0][i + 1] + dist[1][j], i + 1, j))
        if j + 1 < len(second) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (dist[0][i] + dist[1][j + 1], i, j + 1))
    return out


def nearest(table: DataFrame, is_query: F.Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
            centroids: int = CENTROIDS, share: float = VISIT_SHARE, sample_rows: int = SAMPLE_ROWS,
            row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for every row that ``is_query``.

    ``is_query`` is a condition on ``vec_id``; ``score`` is the Euclidean distance.
    """
    spark = table.sparkSession
    vectors = stored(sound_vectors(table, id_col, vec_col, drop_zero=True), "ann-vectors")
    rows = vectors.count()
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    books = fit_codebooks(vectors, rows, centroids, sample_rows)
    index = stored(cells_of(vectors, books), "ann-index")
    population = np.zeros(len(books[0]) * len(books[1]), dtype=np.int64)
    for r in index.select("cell", "vec_id").distinct().groupBy("cell").count().collect():  # a row per cell
        population[r["cell"]] = r["count"]
    # cells that hold so many ids hold k others, even if every id that is in several cells is counted in each
    held = int(population.sum())
    wanted = max(share * held, held - index.select("vec_id").distinct().count() + k + 1)

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cells = [np.sort(np.array(visit(q, books, population, wanted), dtype=np.int32)) for q in b["vec"]]
            yield pd.DataFrame({"query_id": b["query_id"], "vec": b["vec"], "cells": cells})

    asked = index.where(is_query).select(F.col("vec_id").alias("query_id"), "vec")
    queries = stored(asked.mapInPandas(plan, "query_id long, vec array<double>, cells array<int>"), "ann-queries")
    n = queries.count()

    def search(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        return _search_block(q, r, k, len(population))

    found = block_join(index, queries, "vec_id", "query_id", rows // row_block + 1, n // query_block + 1, search, FOUND)
    return best_per_query(found, k, F.col("score"), F.col("vec_id")).select("query_id", "rank", "vec_id", "score")


def _search_block(q: pd.DataFrame, r: pd.DataFrame, k: int, cells: int) -> pd.DataFrame:
    """The ``k`` nearest entries of a block's visited cells for each query of a block."""
    out = []
    if len(q) and len(r):
        r = r.sort_values("cell", kind="stable")
        x, ids = np.stack(r["vec"].to_numpy()), r["vec_id"].to_numpy()
        names, code = np.unique(ids, return_inverse=True)
        repeated = len(names) < len(ids)
        starts = np.searchsorted(r["cell"].to_numpy(), np.arange(cells + 1))
        lengths, square = np.diff(starts), (x ** 2).sum(axis=1)
        q = q.assign(order_=[tuple(v) for v in q["vec"]]).sort_values(["query_id", "order_"]).drop_duplicates("query_id")
        for query_id, v, visited in zip(q["query_id"], q["vec"], q["cells"], strict=True):
            n = lengths[visited]
            at = np.arange(n.sum()) + np.repeat(starts[visited] - np.cumsum(n) + n, n)
            at = at[ids[at] != query_id]
            if not len(at):
                continue
            # a quick pass leaves the entries that can be among the nearest; those are measured exactly
            rough = square[at] - 2 * (x[at] @ v)
            low = rough
            if repeated:  # rows under one id: the nearest one counts
                low = np.full(len(names), np.inf)
                np.minimum.at(low, code[at], rough)
                low = low[low < np.inf]
            if len(low) > k:
                limit = np.partition(low, k - 1)[k - 1]
                at = at[rough <= limit + 1e-9 * (abs(limit) + (v ** 2).sum() + 1)]
            score = np.sqrt(((x[at] - v) ** 2).sum(axis=1))
            got = pd.DataFrame({"query_id": query_id, "vec_id": ids[at], "score": score})
            out.append(got.sort_values(["score", "vec_id"]).drop_duplicates("vec_id").head(k))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
        {"query_id": "int64", "vec_id": "int64"})
