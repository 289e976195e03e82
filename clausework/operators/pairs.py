"""Stance by a plug-in model that scores every different (premise, actor) of the whole table once.

``stance`` scores a row's pairs beside the row; a pair that many rows hold is
scored in each of them. Here the pairs are made distinct first, over all rows:
only a hash of the premise travels, and equal pairs meet after a map-side
combine, so a pair that a third of all rows hold is one row per task. Each
different premise joins its pairs once, the model runs on them, and the scores
are written. They come back to the rows by a join on (premise hash, actor) in
which pairs of very many rows are split: the scores of such a pair are repeated
``salts`` times and its rows are dealt over the copies. How many pairs can be
that frequent is bounded by the share of rows that makes one so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import ROW, built, identity_of, numbered, stored
from .stance import _SLOT, BATCH_SIZE, ENTAIL_IDX, TEMPLATES, _decided, _prepared

# rows of one pair that a join's task takes; a pair of more rows is split
SALT_ROWS = 100_000
# pairs that a worker takes out of an Arrow batch at once
PAIRS = 256
# frequent pairs that are broadcast at most
MOST_HOT = 10_000


def _model_scores(premise: Column, actor: Column, make_pair_fn: Callable, templates, max_length: int | None, entail_idx: int,
                  batch_size: int) -> Column:
    """``struct<scores, calls>`` of a pair: the score per template, and how often the model was given each."""
    identity = identity_of(make_pair_fn)
    texts = [t for _, t in templates]

    def score(fn, premises: list[str], hypotheses: list[str], first: int, end: int, scores: list, calls: np.ndarray) -> None:
        calls[first:end] += 1
        try:
            got = np.asarray(fn(premises[first:end], hypotheses[first:end], max_length), dtype=float).reshape(end - first, -1)
        except Exception:
            for i in range(first, end) if end - first > 1 else ():
                score(fn, premises, hypotheses, i, i + 1, scores, calls)
            return
        scores[first:end] = got[:, entail_idx].tolist()

    kind = T.StructType([T.StructField("scores", T.ArrayType(T.DoubleType())), T.StructField("calls", T.ArrayType(T.IntegerType()))])
    # pairs taken out of an Arrow batch at once; whole calls of the model, so that these stay what they are
    step = batch_size * max(1, PAIRS // batch_size)

    @F.arrow_udf(kind)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        from pyspark.sql.pandas.types import to_arrow_type

        fn = built("pair-model", identity, make_pair_fn)

        def of(premises: list[str], actors: list[str]) -> pa.Array:
            first = [p for p in premises for _ in texts]
            second = [t.replace(_SLOT, a) for a in actors for t in texts]
            scores, calls = [None] * len(first), np.zeros(len(first), dtype=np.int32)
            for at in range(0, len(first), batch_size):
                score(fn, first, second, at, min(at + batch_size, len(first)), scores, calls)
            ends = pa.array(np.arange(len(premises) + 1) * len(texts), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, y)) for x, y in ((scores, pa.float64()), (calls, pa.int32()))]
            return pa.StructArray.from_arrays(lists, names=["scores", "calls"]).cast(to_arrow_type(kind))

        for premises, actors in batches:
            parts = [of(premises.slice(at, step).to_pylist(), actors.slice(at, step).to_pylist()) for at in range(0, len(premises), step)]
            yield pa.concat_arrays(parts) if parts else pa.array([], type=to_arrow_type(kind))

    return run(premise, actor)


def _rows(df: DataFrame, keep: list[str], clause: str, actors: str, max_chars: int | None) -> DataFrame:
    """The rows with a number, their premise, its hash and their actors, written."""
    row = _prepared(clause, actors, max_chars, df.schema[actors].dataType)
    src = df.select(*keep, row.alias("__r")).select(*keep, F.col("__r.premise").alias("__premise"), F.col("__r.actors").alias("__actors"))
    return numbered(src.withColumn("__pid", F.unhex(F.md5("__premise"))), "pair-rows")


def _each(rows: DataFrame) -> DataFrame:
    """``(row, pid, pos, actor)`` of the pairs that are scored: neither premise nor actor is empty."""
    some = rows.where(F.length("__premise") > 0).select(ROW, "__pid", F.posexplode_outer("__actors").alias("pos", "actor"))
    return some.where(F.col("pos").isNotNull() & (F.length("actor") > 0))


def _distinct(rows: DataFrame) -> DataFrame:
    return stored(_each(rows).groupBy("__pid", "actor").agg(F.count(F.lit(1)).alias("rows")), "pair-distinct")


def _scored(rows: DataFrame, pairs: DataFrame, pair_model: Callable, templates, max_length, entail_idx, batch_size) -> DataFrame:
    texts = rows.where((F.length("__premise") > 0) & (F.size("__actors") > 0)).select("__pid", "__premise").dropDuplicates(["__pid"])
    scores = _model_scores(F.col("__premise"), F.col("actor"), pair_model, templates, max_length, entail_idx, batch_size)
    return stored(pairs.join(texts, "__pid").select("__pid", "actor", "rows", scores.alias("s"))
                  .select("__pid", "actor", "rows", "s.scores", "s.calls"), "pair-scores")


def distinct_scores(df: DataFrame, pair_model: Callable, templates=TEMPLATES, max_length: int | None = None, max_chars: int | None = None,
                    clause: str = "clause", actors: str = "predicted_actors", entail_idx: int = ENTAIL_IDX,
                    batch_size: int = BATCH_SIZE) -> DataFrame:
    """``(premise_hash, actor, rows, scores, calls)``, one row per different pair of the table.

    ``rows`` counts where it stands, ``scores`` are per template (null:
    failed), ``calls`` says how often the model was given each.
    """
    rows = _rows(df, [], clause, actors, max_chars)
    return _scored(rows, _distinct(rows), pair_model, templates, max_length, entail_idx, batch_size).withColumnRenamed("__pid", "premise_hash")


def stance_distinct(df: DataFrame, pair_model: Callable, templates=TEMPLATES, max_length: int | None = None, max_chars: int | None = None,
                    clause: str = "clause", actors: str = "predicted_actors", entail_idx: int = ENTAIL_IDX, batch_size: int = BATCH_SIZE,
                    salt_rows: int = SALT_ROWS) -> DataFrame:
    """The rows with ``predicted_sentiments`` and ``sentiment_scores``, as ``stance`` gives them with this model.

    Rows are told apart by number; any key may repeat.
    """
    keep = list(df.columns)
    rows = _rows(df, keep, clause, actors, max_chars)
    pairs = _distinct(rows)
    scored = _scored(rows, pairs, pair_model, templates, max_length, entail_idx, batch_size)
    total = pairs.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    # at most MOST_HOT pairs can hold so many rows each
    crowd = max(salt_rows, total // MOST_HOT + 1)
    salts = F.ceil(F.col("rows") / F.lit(salt_rows)).cast("int")
    hot = pairs.where(F.col("rows") >= crowd).select("__pid", "actor", salts.alias("salts"))
    copies = F.when(F.col("rows") >= crowd, salts).otherwise(F.lit(1))
    scored = scored.select("__pid", "actor", "scores", F.explode(F.sequence(F.lit(0), copies - 1)).alias("salt"))
    salt = F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(ROW), F.col("salts"))).cast("int")
    each = _each(rows).join(F.broadcast(hot), ["__pid", "actor"], "left").withColumn("salt", salt)
    found = (each.join(scored, ["__pid", "actor", "salt"])
             .groupBy(ROW).agg(F.map_from_entries(F.collect_list(F.struct("pos", "scores"))).alias("__found")))
    done = rows.join(found, ROW, "left")
    pair = F.transform("__actors", lambda a, i: F.struct(
        a.alias("actor"), ((F.length("__premise") == 0) | a.isNull() | (F.length(a) == 0)).alias("guard"),
        F.try_element_at("__found", i).alias("scores")))
    done = done.select(*keep, F.transform(pair, lambda x: _decided(x, templates)).alias("__done"))
    return done.select(*keep, F.transform("__done", lambda d: d["stance"]).alias("predicted_sentiments"),
                       F.transform("__done", lambda d: d["scores"]).alias("sentiment_scores"))
