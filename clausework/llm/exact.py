"""Exact inner products of integer vectors, whatever their size."""

from __future__ import annotations

import numpy as np

LONG = 1 << 63


def inner_products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Longs: the inner product of every row with ``query``; both hold whole numbers as doubles.

    Doubles are used where every sum stays below 2^53, longs below 2^63, and
    unbounded integers beyond. A product that is no long is refused.
    """
    out = np.zeros(len(rows), dtype=np.int64)
    if not len(rows) or not len(query):
        return out
    most = np.abs(rows).max(axis=1) * np.abs(query).max() * len(query)
    small = most < 2.0 ** 53
    if small.all():
        return (rows @ query).astype(np.int64)
    out[small] = (rows[small] @ query).astype(np.int64)
    # the bound itself is rounded, so longs are used well below their limit
    middle = ~small & (most < 2.0 ** 62)
    if middle.any():
        out[middle] = rows[middle].astype(np.int64) @ query.astype(np.int64)
    exact = [int(x) for x in query]
    for i in np.flatnonzero(most >= 2.0 ** 62):
        total = sum(int(a) * b for a, b in zip(rows[i], exact, strict=True))
        if not -LONG <= total < LONG:
            raise OverflowError("the inner product of two vectors leaves a long")
        out[i] = total
    return out
