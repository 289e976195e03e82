"""A linear head of any size, fitted in shards (F1).

The weights are a written table of blocks, each the weights of all labels for a
range of features. Windows are dealt to blocks of windows by a hash of their
number. A step is one pass over the windows and one over the weights:

1. a task takes a block of windows, its features ordered by shard, and the
   shards stream by, each adding its part to the block's logits;
2. the loss's slope of the logits and the truth gives the block's gradient,
   which leaves it shard by shard;
3. each shard adds what the blocks send to its weights as it streams by.

No matrix is larger than ``block_cells`` numbers or ``BLOCK_CELLS``, if that is
more (one feature's labels, or one window's, at least), a block of windows has
about ``BLOCK_ENTRIES`` features, nothing is collected, and the new weights are
written, so a lost executor costs one step at most. A step shuffles the windows
once and the weights once per window block; no logits or slopes are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import BIAS_FEATURE
from ._util import stored
from .scoring import HEAD_SCHEMA

# numbers of a block of weights, logits or slopes: 8 MB
BLOCK_CELLS = 1 << 20
# features of all windows of a block: 24 MB with their counts
BLOCK_ENTRIES = 1 << 21
# numbers that are multiplied at once
CELLS = 1 << 20
BIAS_SHARD = -1


def _bytes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, dtype=np.float64).tobytes()


def _matrix(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.float64).reshape(-1, width)


def streamed(df: DataFrame, key: str, fn: Callable[[int, Iterator[dict]], Iterator[dict]], schema: str, *order: str) -> DataFrame:
    """``fn(key value, its rows)`` for every value, rows one by one in ``order``: none is held that ``fn`` does not hold."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        rows = (r for b in batches for i in range(len(b)) for r in b.slice(i, 1).to_pylist())
        for value, own in groupby(rows, lambda r: r[key]):
            for out in fn(value, own):
                yield pa.RecordBatch.from_pydict({n: [out[n]] for n in names}, schema=kinds)

    kinds = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}[k])
                       for n, k in (f.split() for f in schema.split(", "))])
    return df.repartition(F.col(key)).sortWithinPartitions(key, *order).mapInArrow(run, schema)


class WindowBlock:
    """Windows of one block: their features by shard, and the logits as the shards stream by."""

    def __init__(self, n_labels: int, n_features: int, width: int):
        self.labels, self.n_features, self.width = n_labels, n_features, width
        self.held: list[tuple[np.ndarray, ...]] = []
        self.z: np.ndarray | None = None

    def take(self, b: pa.RecordBatch) -> None:
        """Windows of an Arrow batch; their features are copied as small numbers."""
        from .head import lists

        (features, ends), (counts, at_counts), (labels, own) = (lists(b.column(c)) for c in ("features", "counts", "labels"))
        self.held.append((np.diff(ends), features[ends[0]:ends[-1]].astype(np.int32), counts[at_counts[0]:at_counts[-1]].astype(np.float64),
                          np.diff(own), labels[own[0]:own[-1]].astype(np.int64)))

    def start(self) -> None:
        lengths, features, counts, self.label_lengths, self.own_labels = (np.concatenate(c) for c in zip(*self.held, strict=True))
        self.held = []
        known = features < self.n_features
        shard = (features // self.width).astype(np.min_scalar_type(max(1, self.n_features // self.width + 1)))
        order = np.argsort(shard, kind="stable")
        order = order[known[order]]
        window = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        self.window, self.features, self.counts = window[order], features[order], counts[order]
        self.ends = np.searchsorted(shard[order], np.arange(-(-self.n_features // self.width) + 1))
        self.z = np.zeros((len(lengths), self.labels))

    def parts(self, s: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(window, feature in the shard, count)`` of a shard's entries, few at a time."""
        step = max(1, CELLS // max(1, self.labels))
        for a in range(int(self.ends[s]), int(self.ends[s + 1]), step):
            b = min(a + step, int(self.ends[s + 1]))
            yield self.window[a:b], self.features[a:b] - s * self.width, self.counts[a:b]

    def add(self, s: int, w: np.ndarray) -> None:
        """A shard's part of the logits."""
        if s == BIAS_SHARD:
            self.z += w
            return
        for window, feature, counts in self.parts(s):
            terms = w.take(feature, axis=0)
            terms *= counts[:, None]
            first = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
            self.z[window[first]] += np.add.reduceat(terms, first, axis=0)

    def gradient(self, s: int, slopes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The features of a shard that the windows have, and the gradient of their weights."""
        from .head import add_by_feature

        used = np.unique(self.features[self.ends[s]:self.ends[s + 1]]) - s * self.width
        g = np.zeros((len(used), self.labels))
        for window, feature, counts in self.parts(s):
            terms = slopes.take(window, axis=0)
            terms *= counts[:, None]
            add_by_feature(g, np.searchsorted(used, feature), terms)
        return used, g

    def truth(self) -> np.ndarray:
        from .head import truth_of

        return truth_of(self.own_labels, self.label_lengths, self.labels)


class ShardedModel:
    """Weights as a written table ``(s, w)`` of feature ranges; the bias is shard -1."""

    def __init__(self, blocks: DataFrame, names: DataFrame, n_labels: int, n_features: int, block_cells: int):
        self.blocks, self.names, self.n_labels, self.n_features, self.block_cells = blocks, names, n_labels, n_features, block_cells
        self.width = max(1, block_cells // max(1, n_labels))
        self.shards = -(-n_features // self.width)
        self.sizes: dict[int, tuple[DataFrame, int, int]] = {}

    @classmethod
    def of(cls, head: DataFrame, block_cells: int = BLOCK_CELLS) -> ShardedModel:
        """From a head table, which is grouped into blocks and not collected."""
        top = head.agg(F.max("label_id").alias("l"), F.max("feature").alias("f")).first()
        n_labels, n_features = (top["l"] or 0) + 1, (top["f"] or 0) + 1
        names = stored(head.select("label_id", "label").distinct(), "shard-names")
        width = max(1, block_cells // n_labels)

        def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            s = int(key[0])
            first, size = (BIAS_FEATURE, 1) if s == BIAS_SHARD else (s * width, min(width, n_features - s * width))
            w = np.zeros((size, n_labels))
            w[rows["feature"].to_numpy() - first, rows["label_id"].to_numpy()] = rows["weight"].to_numpy()
            return pd.DataFrame({"s": [s], "w": [_bytes(w)]})

        s = F.when(F.col("feature") == BIAS_FEATURE, F.lit(BIAS_SHARD)).otherwise(F.floor(F.col("feature") / width)).cast("int")
        blocks = head.select(s.alias("s"), "label_id", "feature", "weight").groupBy("s").applyInPandas(build, "s int, w binary")
        return cls(stored(blocks, "shard-weights"), names, n_labels, n_features, block_cells)

    def _sizes(self, x: DataFrame) -> tuple[int, int]:
        """The number of windows of ``x`` and of their features, counted once for all steps over it."""
        if id(x) not in self.sizes:
            got = x.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("features").cast("long")), F.lit(0)).alias("e")).first()
            self.sizes = {id(x): (x, got["n"], got["e"])}
        return self.sizes[id(x)][1:]

    def _blocks(self, x: DataFrame) -> int:
        """Window blocks: within the bounds of a block, and as many as there are cores unless that copies more weights than windows."""
        n, entries = self._sizes(x)
        even = min(2 * x.sparkSession.sparkContext.defaultParallelism, entries // max(1, self.n_features * self.n_labels) + 1)
        return max(1, even, -(-n * self.n_labels // max(self.block_cells, BLOCK_CELLS)), -(-entries // BLOCK_ENTRIES))

    def _met(self, x: DataFrame, finish: Callable[[WindowBlock, list[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType,
             keys: tuple[str, ...] = (), weights: DataFrame | None = None) -> DataFrame:
        """What ``finish`` makes of every block of windows that has met all ``weights`` (all blocks); it is also given the columns ``keys``.

        A block is a partition of its own: windows come first, then the bias, then the shards.
        """
        labels, n_features, width, blocks = self.n_labels, self.n_features, self.width, self._blocks(x)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, own = WindowBlock(labels, n_features, width), []
            for b in batches:
                s = b.column("s").to_numpy(zero_copy_only=False)
                n = int(np.searchsorted(s, BIAS_SHARD))
                if n:
                    block.take(b.slice(0, n))
                    if keys:
                        own.append(b.slice(0, n).select(list(keys)))
                if n < len(s) and block.held:
                    block.start()
                if block.z is not None:
                    for i in range(n, len(s)):
                        block.add(int(s[i]), np.frombuffer(b.column("w")[i].as_buffer(), dtype=np.float64).reshape(-1, labels))
            if block.held:  # a head without weights
                block.start()
            if block.z is not None:
                yield from finish(block, own)

        kinds = {f.name: f.dataType for f in x.schema.fields}
        none = [F.lit(None).cast(kinds[k]).alias(k) for k in keys]
        rows = x.select(F.pmod(F.xxhash64(F.lit("block"), F.col("win")), F.lit(blocks)).cast("int").alias("p"), F.lit(BIAS_SHARD - 1).alias("s"),
                        "features", "counts", "labels", F.lit(None).cast("binary").alias("w"), *keys)
        copies = (self.blocks if weights is None else weights).select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("p"), "s", *[
            F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("features", "counts", "labels")], "w", *none)
        dealt = rows.unionByName(copies).repartitionById(blocks, "p").sortWithinPartitions("s")
        return dealt.mapInArrow(run, schema)

    def step(self, x: DataFrame, rate: float, decay: float, loss) -> ShardedModel:
        n, labels, shards = self._sizes(x)[0], self.n_labels, self.shards
        kind = pa.schema([("s", pa.int32()), ("features", pa.binary()), ("g", pa.binary())])

        def gradients(block: WindowBlock, _: list) -> Iterator[pa.RecordBatch]:
            r = loss.slope(block.z, block.truth())
            yield pa.RecordBatch.from_pydict({"s": [BIAS_SHARD], "features": [None], "g": [_bytes(r.sum(axis=0))]}, schema=kind)
            for s in range(shards):
                used, g = block.gradient(s, r)
                if len(used):
                    yield pa.RecordBatch.from_pydict({"s": [s], "features": [used.astype(np.int32).tobytes()], "g": [_bytes(g)]}, schema=kind)

        def update(s: int, rows: Iterator[dict]) -> Iterator[dict]:
            w = None
            for r in rows:
                if r["kind"] == 0:
                    w = _matrix(r["g"], labels) * (1.0 if s == BIAS_SHARD else 1.0 - rate * decay)
                elif s == BIAS_SHARD:
                    w -= rate / max(1, n) * _matrix(r["g"], labels)
                else:
                    w[np.frombuffer(r["features"], dtype=np.int32)] -= rate / max(1, n) * _matrix(r["g"], labels)
            if w is not None:
                yield {"s": s, "w": _bytes(w)}

        parts = self._met(x, gradients, "s int, features binary, g binary")
        rows = (self.blocks.select("s", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("features"), F.col("w").alias("g"))
                .unionByName(parts.select("s", F.lit(1).alias("kind"), "features", "g")))
        new = ShardedModel(stored(streamed(rows, "s", update, "s int, w binary", "kind"), "shard-weights"), self.names, labels, self.n_features, self.block_cells)
        new.sizes = self.sizes
        return new

    def evaluate(self, x: DataFrame, threshold: float, loss) -> tuple[float, ...]:
        from .head import SUMS, cell_sums, measures

        def sums(block: WindowBlock, _: list) -> Iterator[pa.RecordBatch]:
            got = cell_sums(block.z, block.truth(), loss, threshold)
            yield pa.RecordBatch.from_pydict({c: [v] for c, v in zip(("tp", "fp", "fn", "tn", "loss"), got, strict=True)})

        return measures(self._met(x, sums, SUMS))

    def sums(self, x: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        """``(keys..., z array<double>)``: the logits of every window of ``x`` by all labels, without the bias."""
        from .head import list_column

        def rows(block: WindowBlock, own: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at = 0
            for b in own:
                z = block.z[at:at + b.num_rows]
                at += b.num_rows
                yield pa.RecordBatch.from_arrays([*b.columns, list_column(z.reshape(-1), np.full(len(z), z.shape[1]))], names=[*keys, "z"])

        kinds = T.StructType([*[T.StructField(k, x.schema[k].dataType) for k in keys], T.StructField("z", T.ArrayType(T.DoubleType()))])
        return self._met(x, rows, kinds, keys, self.blocks.where(F.col("s") != BIAS_SHARD))

    def table(self) -> DataFrame:
        """The weights as a head table, made by the executors."""
        labels, width = self.n_labels, self.width

        def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for s, data in zip(b["s"], b["w"], strict=True):
                    w = _matrix(data, labels)
                    first = BIAS_FEATURE if s == BIAS_SHARD else s * width
                    yield pd.DataFrame({"label_id": np.tile(np.arange(labels, dtype=np.int32), len(w)),
                                        "feature": np.repeat(np.arange(first, first + len(w), dtype=np.int32), labels), "weight": w.reshape(-1)})

        long = self.blocks.mapInPandas(rows, "label_id int, feature int, weight double")
        return long.join(self.names, "label_id").select(*[f.name for f in HEAD_SCHEMA.fields])
