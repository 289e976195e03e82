"""Label vocabulary, multi-hot encoding, wide label columns, warm-start mapping
(L1-L5, J1, J2, J4-J6, M1-M3).

The vocabulary is the sorted distinct label set with dense ids from 0
(UTF-8 binary order, which is code-point order). Ids are assigned without a
single-partition window: the distinct set is range-partitioned and sorted,
checkpointed to the shared folder so its partitions are stable, and each
label's id is its partition offset plus its index in the partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from ._util import ROW, bounded_broadcast, numbered

# The warm-start map (new label -> old label), 16 pairs.
WARM_MAP = [
    ("Donors", "Investors And Stakeholders"),
    ("Government", "Politicians"),
    ("Mediators", "Civil Servants"),
    ("Member States", "Citizens"),
    ("Pirates", "Criminals"),
    ("Rebels", "Criminals"),
    ("Refugees", "Migrants And Refugees"),
    ("Regional Organizations", "Ethnic And National Communities"),
    ("Regional Stakeholders", "Ethnic And National Communities"),
    ("Peacekeeping", "Military Personnel"),
    ("Troop Contributing Countries", "Military Personnel"),
    ("Terrorists", "Criminals"),
    ("Stakeholders", "Investors And Stakeholders"),
    ("Secretary General", "Politicians"),
    ("Security Council", "Politicians"),
    ("Permanent Members", "Politicians"),
]

# Vocabularies up to this size travel as a literal array beside a row's own labels; larger ones are joined.
INLINE_LABELS = 1_000


def dense_ids(df: DataFrame, column: str, out: str) -> DataFrame:
    """Dense 0-based ids for the distinct values of ``column`` in sorted order."""
    return dense_ids_sized(df, column, out)[0]


def dense_ids_sized(df: DataFrame, column: str, out: str) -> tuple[DataFrame, int]:
    """``dense_ids`` and the number of distinct values (known from the
    per-partition counts, so no extra job is needed to size a broadcast)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    ranged = (df.select(column).where(F.col(column).isNotNull()).distinct()
              .repartitionByRange(column).sortWithinPartitions(column)
              .checkpoint(eager=True))
    ranked = ranged.select(column, F.monotonically_increasing_id().alias("_mid"))
    ranked = ranked.select(column, F.shiftright("_mid", 33).alias("_pid"),
                           (F.col("_mid") - F.shiftleft(F.shiftright("_mid", 33), 33)).alias("_local"))
    # one count per partition: bounded by the partition count
    counts = sorted((r["_pid"], r["count"]) for r in ranked.groupBy("_pid").count().collect())
    offsets, acc = [], 0
    for pid, cnt in counts:
        offsets.append((int(pid), int(acc)))
        acc += cnt
    schema = T.StructType([T.StructField("_pid", T.LongType()), T.StructField("_off", T.LongType())])
    offs = spark.createDataFrame(offsets or [(0, 0)], schema)
    # one row per partition of the distinct labels: bounded by the partition count
    return (ranked.join(F.broadcast(offs), "_pid")
            .select((F.col("_off") + F.col("_local")).cast("int").alias(out), column)), int(acc)


def vocabulary(df: DataFrame, actors: str = "actors") -> DataFrame:
    """L1/L4: ``vocab(label_id INT, label STRING)`` over all rows' label lists."""
    return vocabulary_sized(df, actors)[0]


def vocabulary_sized(df: DataFrame, actors: str = "actors") -> tuple[DataFrame, int]:
    """``vocabulary`` and its number of labels."""
    # the outer form keeps the planner from parsing every list again, in a filter on its size; null is no label
    labels = df.select(F.explode_outer(actors).alias("label"))
    return dense_ids_sized(labels, "label", "label_id")


def labels_in_id_order(vocab: DataFrame) -> DataFrame:
    """The class list ordered by integer id."""
    return vocab.orderBy(F.col("label_id").cast("int"))


def label_ids(df: DataFrame, vocab: DataFrame, actors: str = "actors", key: str = "row_id",
              vocab_rows: int | None = None) -> DataFrame:
    """J1 + L2 (sparse): ``(key, label_ids ARRAY<INT>)``, one row per row, sorted, duplicates collapsed.

    Labels outside the vocabulary are dropped. Rows with an empty list keep
    an empty array.
    """
    return _joined_ids(df.select(key, actors), vocab, actors, vocab_rows, "label_ids").select(key, "label_ids")


def _joined_ids(df: DataFrame, vocab: DataFrame, actors: str, vocab_rows: int | None, out: str) -> DataFrame:
    """``df`` with its label ids, by a join of its rows' labels; rows are told apart by number, as keys may repeat."""
    rows = numbered(df, "label-rows")
    ex = rows.select(ROW, F.explode(actors).alias("label"))
    ids = (ex.join(bounded_broadcast(vocab, rows=vocab_rows), "label")
           .groupBy(ROW).agg(F.array_sort(F.collect_set("label_id")).alias(out)))
    return (rows.join(ids, ROW, "left").drop(ROW)
            .withColumn(out, F.coalesce(F.col(out), F.array().cast("array<int>"))))


def multi_hot(ids: DataFrame, n_labels: int, ids_col: str = "label_ids", out: str = "labels") -> DataFrame:
    """L2 (dense): 0/1 vector of width ``n_labels`` from sorted label ids."""
    if n_labels < 1:
        return ids.withColumn(out, F.array().cast("array<int>"))
    return ids.withColumn(out, F.transform(F.sequence(F.lit(0), F.lit(n_labels - 1)),
                                           lambda i: F.array_contains(F.col(ids_col), i).cast("int")))


def label_names(vocab: DataFrame, rows: int | None = None, most: int = INLINE_LABELS) -> list[str] | None:
    """The labels in id order if there are at most ``most`` of them, else None."""
    n = vocab.count() if rows is None else rows
    return [r["label"] for r in vocab.orderBy("label_id").collect()] if n <= most else None


def own_label_ids(actors: Column, names: list[str]) -> Column:
    """J1 + L2 beside the row: the sorted ids of an actor list, labels outside the vocabulary dropped."""
    ids = F.transform(actors, lambda a: (F.array_position(F.lit(names) if names else F.array().cast("array<string>"), a) - 1).cast("int"))
    return F.array_sort(F.array_distinct(F.filter(F.coalesce(ids, F.array().cast("array<int>")), lambda i: i >= 0)))


def with_label_ids(df: DataFrame, vocab: DataFrame, actors: str = "actors",
                   vocab_rows: int | None = None, out: str = "label_ids") -> DataFrame:
    """``df`` with its label ids as a column: computed in the row, or joined row by row for a large vocabulary."""
    names = label_names(vocab, vocab_rows)
    if names is not None:
        return df.withColumn(out, own_label_ids(F.col(actors), names))
    return _joined_ids(df, vocab, actors, vocab_rows, out)


def label_cells(df: DataFrame, vocab: DataFrame, actors: str = "actors", key: str = "row_id") -> DataFrame:
    """L3 in long form: ``(key, label, hit)`` with a row per label that a row has (``hit`` 1)."""
    ex = df.select(key, F.explode(F.array_distinct(actors)).alias("label"))
    return ex.join(bounded_broadcast(vocab.select("label")), "label", "left_semi").select(key, "label", F.lit(1).alias("hit"))


def label_wide(df: DataFrame, names: list[str], actors: str = "actors", key: str = "row_id") -> DataFrame:
    """L3 + J6: one 0/1 INT column per label of ``names`` beside the key.

    The caller passes the names, since a table's columns must be known when it
    is planned; ``label_cells`` and ``multi_hot`` need none. A name equal to
    the key or differing from another only by case is refused (unless the
    session is case-sensitive).
    """
    case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    fold = (lambda x: x) if case_sensitive else str.lower
    folded = [fold(c) for c in [key, *names]]
    twice = sorted({c for c, f in zip([key, *names], folded, strict=True) if folded.count(f) > 1})
    if twice:
        raise ValueError(f"these names cannot be columns of one table: {twice}")
    own = F.coalesce(F.col(actors), F.array().cast("array<string>"))
    return df.select(key, *[F.array_contains(own, c).cast("int").alias(c) for c in names])


def label_map(vocab: DataFrame) -> DataFrame:
    """L4 as a one-row ``{"classes": [...]}`` table in id order (bounded by the vocabulary)."""
    return vocab.agg(F.transform(F.array_sort(F.collect_list(F.struct("label_id", "label"))),
                                 lambda x: x["label"]).alias("classes"))


# --- warm start (M1-M3) ------------------------------------------------------

def warm_map_table(spark, pairs=None) -> DataFrame:
    pairs = WARM_MAP if pairs is None else pairs
    return spark.createDataFrame(list(pairs), "new_label string, old_label string")


def warm_pairs(warm: DataFrame, new_vocab: DataFrame, old_vocab: DataFrame) -> DataFrame:
    """Keep the pairs whose both ends exist (two semi joins)."""
    return (warm.join(new_vocab.select(F.col("label").alias("new_label")), "new_label", "left_semi")
            .join(old_vocab.select(F.col("label").alias("old_label")), "old_label", "left_semi")
            .select("new_label", "old_label"))


def warm_skipped(warm: DataFrame, new_vocab: DataFrame, old_vocab: DataFrame) -> DataFrame:
    """Names of the map that were dropped (set difference)."""
    valid = warm_pairs(warm, new_vocab, old_vocab)
    return warm.select("new_label").join(valid.select("new_label"), "new_label", "left_anti").distinct()


def warm_copy(new_head: DataFrame, old_head: DataFrame, pairs: DataFrame) -> DataFrame:
    """M3: copy each mapped old label's weights and bias onto the new label.

    Heads are ``(label_id, label, feature, weight)`` with the bias at
    feature -1; labels without a pair keep their fresh weights.
    """
    m = pairs.select(F.col("new_label").alias("label"), "old_label")
    old = old_head.select(F.col("label").alias("old_label"), "feature", F.col("weight").alias("old_weight"))
    return (new_head.join(m, "label", "left").join(old, ["old_label", "feature"], "left")
            .select("label_id", "label", "feature",
                    F.coalesce("old_weight", "weight").alias("weight")))
