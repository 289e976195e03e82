"""Mix sources to target weights by seeded hash order and exact budgets.

Each source gets a target number of words by weight. Within a source the
documents have a hash-random order; distributed prefix sums of their sizes
tell where the target ends. A target over the source's size repeats it whole
(epochs) and cuts the last one.

The order is cut into ranges of the hash key. A first pass sums the sizes of
each (source, range); the prefix sums of these few totals say in which range
the budget ends. Only the rows of that range are sorted and summed one by one,
so no task holds more than a range, however large a source is. The cut found
there decides on every other row by comparing places. There are about as many
ranges as a range has rows: the square root of the row count.

Defined cases: a null text is empty (size 0) and takes nothing; the null source
is a source of its own, last in order; rows repeated whole
(same id and text) share a place, and at the end of the budget take equal
parts of it; an empty table gives an empty result; a source without words has target 0.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators._util import bounded_broadcast
from ._common import stored

# a word, as the contract of the mix has it
WORD = r"[^\x20\x09-\x0D]+"
# a source is repeated at most this often
MAX_EPOCHS = 3
# the weights of the sources in code-point order, repeating
WEIGHTS = (1, 2, 3)


def word_count(text: F.Column) -> F.Column:
    """The number of words ``[^\\x20\\x09-\\x0D]+``; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target, budget)`` from ``(source, source_size)``, one row per source.

    The sources share the sum of all sizes by weight. A share over
    ``max_epochs`` times the source's size stops there and its excess goes to
    the others, until none is above. In order of ``limit / weight`` the limited
    sources come first, and one share per weight holds for all behind them, so
    one ordered pass finds the end of the resharing. Sums are exact decimals.
    The table has a row per source, not per document.
    """
    dec = "decimal(38,0)"
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("weight", w.cast("long")).withColumn("limit", F.col("source_size") * max_epochs)
    by_ratio = Window.orderBy((F.col("limit") / F.col("weight")), F.col("source").isNull(), F.encode("source", "UTF-8"))
    whole = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("total", F.sum(F.col("source_size")).over(whole).cast(dec))
         .withColumn("limits_before", F.coalesce(F.sum("limit").over(before), F.lit(0)).cast(dec))
         .withColumn("weights_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("limited", F.col("limit").cast(dec) * F.col("weights_left").cast("decimal(18,0)")
                     <= F.col("weight").cast("decimal(18,0)") * (F.col("total") - F.col("limits_before")).cast("decimal(20,0)")))
    s = (s.withColumn("rest", (F.max("total").over(whole) - F.coalesce(F.sum(F.when(F.col("limited"), F.col("limit"))).over(whole), F.lit(0))).cast("long"))
         .withColumn("rest_weight", F.sum(F.when(~F.col("limited"), F.col("weight"))).over(whole)))
    target = F.when(F.col("limited"), F.col("limit").cast("double")).otherwise(
        (F.col("weight") * F.col("rest")).cast("double") / F.col("rest_weight"))
    return s.select("source", "source_size", target.alias("target"), F.floor(target + 0.5).cast("long").alias("budget"))


def bucket_of(key: F.Column, ranges: int) -> F.Column:
    """The range of a key (32 hex digits): its first 32 bits scaled to ``ranges`` equal parts."""
    head = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.shiftright(head * F.lit(ranges), 32).cast("int")


def keyed_place(id_col: str, text_col: str) -> F.Column:
    """A row's place in its source's random order: the MD5 of its id, then a hash of its text."""
    return F.struct(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("key"),
                    F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"))


def keyed_sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``(doc_id, source, place struct<key, text_hash>, size)``: what the mix needs of a document."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), keyed_place(id_col, text_col).alias("place"),
                       word_count(F.col(text_col)).alias("size"))


def source_cuts(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``(source, source_size, target, epochs, cut, cut_words)``.

    ``rows`` are ``keyed_sizes``. Whole epochs are taken ``epochs`` times; the
    partial one takes every row placed before ``cut`` and ``cut_words`` words of
    the row at it.
    """
    ranges = 1 << (math.isqrt(rows.count()).bit_length())
    totals = stored(rows.groupBy("source", bucket_of(F.col("place.key"), ranges).alias("bucket"))
                    .agg(F.sum("size").alias("bucket_size")), "mix-totals")
    per_source = totals.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    goal = (targets(per_source, weights, max_epochs)
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0).cast("long")))
            .withColumn("over", F.col("budget") - F.col("epochs") * F.col("source_size"))
            .withColumnRenamed("source", "goal_source"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (totals.withColumn("ahead", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
            .join(goal, F.col("source").eqNullSafe(F.col("goal_source")))
            .withColumn("left", F.col("over") - F.col("ahead"))
            .where((F.col("left") >= 0) & (F.col("left") < F.col("bucket_size")))
            .select(F.col("source").alias("end_source"), F.col("bucket").alias("end_bucket"), "left"))
    # rows of the one range per source in which the budget ends; rows repeated whole count as one
    inside = (rows.join(ends, F.col("source").eqNullSafe(F.col("end_source"))
                        & (bucket_of(F.col("place.key"), ranges) == F.col("end_bucket")))
              .groupBy("source", "left", "place", "size").agg(F.count(F.lit(1)).alias("copies")))
    ahead = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    at = (inside.withColumn("open", F.col("left") - F.coalesce(F.sum(F.col("size") * F.col("copies")).over(ahead), F.lit(0)))
          .where((F.col("open") >= 0) & (F.col("open") < F.col("size") * F.col("copies")))
          .select(F.col("source").alias("cut_source"), F.col("place").alias("cut"),
                  F.expr("open div copies").alias("cut_words")))
    return (goal.join(at, F.col("goal_source").eqNullSafe(F.col("cut_source")), "left")
            .select(F.col("goal_source").alias("source"), "source_size", "target", "epochs", "cut", "cut_words"))


def with_taken(rows: DataFrame, cuts: DataFrame, source_col: str = "source", place: str = "place",
               size: str = "size") -> DataFrame:
    """Add ``source_size``, ``target``, ``epochs`` and ``last`` (words of the partial epoch) to every row.

    ``cuts`` has a row per source; it is broadcast only if its counted size is
    small, else the join shuffles and splits large sources.
    """
    c = bounded_broadcast(cuts.withColumnRenamed("source", "cut_source"))
    last = (F.when(F.col(place) < F.col("cut"), F.col(size))
            .when(F.col(place) == F.col("cut"), F.col("cut_words")).otherwise(F.lit(0)))
    return rows.join(c, F.col(source_col).eqNullSafe(F.col("cut_source"))).withColumn("last", last.cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` for every row of ``docs``.

    ``taken`` counts the words the mix takes, repeats included: whole epochs
    times the size, and in the last epoch the words up to the budget. The
    ``taken`` of a source sum to its target, rounded to a whole number (less
    the remainder if the row at the end of the budget is repeated whole).
    """
    rows = stored(keyed_sizes(docs, id_col, text_col, source_col), "mix-sizes")
    cuts = stored(source_cuts(rows, weights, max_epochs), "mix-cuts")
    return with_taken(rows, cuts).select("doc_id", "source", "size", "source_size", "target",
                                         (F.col("epochs") * F.col("size") + F.col("last")).alias("taken"))


def first_words(text: F.Column, n: F.Column) -> F.Column:
    """The text up to the end of its ``n``-th word, white space kept."""
    words = F.regexp_extract_all(text, F.lit(f"(?s).*?{WORD}"), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The rows of the mix, columns of ``docs`` kept: each document once per epoch that takes it.

    The document in which a source's budget ends appears with its words up to
    the budget (and ``n_chars`` counted anew); what the mix does not take goes.
    Texts are not shuffled: every row is placed against its source's cut.
    """
    rows = stored(keyed_sizes(docs, id_col, text_col, source_col), "mix-sizes")
    cuts = stored(source_cuts(rows, weights, max_epochs), "mix-cuts")
    marked = docs.select(F.struct("*").alias("row"), *[F.col(c) for c in dict.fromkeys((id_col, text_col, source_col))])
    keyed = marked.select("row", F.col(source_col).alias("source_"), keyed_place(id_col, text_col).alias("place"),
                          word_count(F.col(text_col)).alias("size"))
    got = with_taken(keyed, cuts, "source_")
    whole = F.col("epochs") + F.when((F.col("last") == F.col("size")) & (F.col("size") > 0), 1).otherwise(0)
    part = F.when(F.col("last") < F.col("size"), F.col("last")).otherwise(F.lit(0).cast("long"))
    none = F.array().cast("array<bigint>")
    takes = F.concat(F.when((whole > 0) & (F.col("size") > 0), F.array_repeat(F.lit(-1).cast("bigint"), whole.cast("int"))).otherwise(none),
                     F.when(part > 0, F.array(part)).otherwise(none))
    got = got.select("row", F.explode(takes).alias("words"))
    text = F.when(F.col("words") < 0, F.col(f"row.{text_col}")).otherwise(first_words(F.col(f"row.{text_col}"), F.col("words")))

    def column(c: str) -> F.Column:
        if c == text_col:
            return text.alias(c)
        if c == "n_chars":
            return F.when(F.col("words") < 0, F.col("row.n_chars")).otherwise(F.length(text).cast("long")).alias(c)
        return F.col(f"row.`{c}`").alias(c)

    return got.select(*[column(c) for c in docs.columns])
