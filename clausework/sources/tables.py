"""Map the driver's tables onto clause tables.

``documents`` is the clause table (``row_id = doc_id``, ``clause = text``).
Its gold actor list is ``[lang, source]`` plus ``quality`` / ``toxic`` when
``labels`` flags them; ``actors_text`` writes that list as a literal (three
spellings the list grammar allows, chosen by row, to exercise the parser).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lists import write_list
from ..operators._util import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def gold_actors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(row_id, clause, actors ARRAY<STRING>)`` from documents + labels."""
    lab = labels.select("doc_id", "quality", "toxic")
    extra = F.concat(
        F.when(F.col("quality") == 1, F.array(F.lit("quality"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(F.array().cast("array<string>")))
    base = F.filter(F.array(F.col("lang"), F.col("source")), lambda x: x.isNotNull())
    return (docs.select("doc_id", "text", "lang", "source").join(lab, "doc_id", "left")
            .select(F.col("doc_id").alias("row_id"), F.col("text").alias("clause"),
                    F.concat(base, extra).alias("actors")))


def list_literal(actors: F.Column, style: F.Column) -> F.Column:
    """Write a string list as a literal: style 0 ``['a', 'b']``, 1 ``["a", "b"]``,
    2 ``[ 'a','b', ]`` (spaces and a trailing comma)."""
    single = write_list(actors)
    double = F.concat(F.lit('["'), F.array_join(actors, '", "'), F.lit('"]'))
    loose = F.concat(F.lit("[ '"), F.array_join(actors, "','"), F.lit("', ]"))
    empty = F.lit("[]")
    return (F.when(F.size(actors) == 0, empty).when(style == 0, single)
            .when(style == 1, double).otherwise(loose))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, clause)``: the documents scan alone, for work that needs no labels."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), F.col("text").alias("clause"))
    return spread(docs, "row_id")


def clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, clause, actors, actors_text)`` over the whole documents table."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    g = gold_actors(docs, table(spark, sf_dir, "labels"))
    return g.withColumn("actors_text", list_literal(F.col("actors"), F.pmod(F.col("row_id"), F.lit(3))))


def edge_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, clause, predicted_actors)``: the documents with the odd inputs a user meets, by row.

    Clauses: null, empty, or the text. Lists: null, empty, unquoted, a tuple,
    escaped, an empty name, unreadable, empty text, no list, two quoted parts,
    a number.
    """
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    lang, source = F.coalesce("lang", F.lit("x")), F.coalesce("source", F.lit("y"))
    forms = [F.lit(None).cast("string"), F.lit("[]"), F.concat(F.lit("["), lang, F.lit("]")),
             F.concat(F.lit("('x', '"), source, F.lit("')")), F.concat(F.lit("['it\\'s', \""), source, F.lit("\"]")),
             F.lit("['']"), F.lit("{[]:1}"), F.lit(""), F.concat(source, F.lit(", "), lang),
             F.concat(F.lit("['"), source, F.lit("' '"), lang, F.lit("']")), F.lit("5")]
    text = F.when(F.pmod("doc_id", F.lit(5)) == 0, F.lit(None)).when(F.pmod("doc_id", F.lit(5)) == 1, F.lit("")).otherwise(F.col("text"))
    return docs.select(F.col("doc_id").alias("row_id"), text.alias("clause"),
                       F.get(F.array(*forms), F.pmod("doc_id", F.lit(len(forms))).cast("int")).alias("predicted_actors"))


def stance_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stance input: ``(row_id, clause, predicted_actors)`` with the actor list as text."""
    c = clauses(spark, sf_dir)
    return c.select("row_id", "clause", F.col("actors_text").alias("predicted_actors"))


def cooccurrence_warm_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A data-derived warm-start map: each source label -> the language label it
    occurs with most (ties: smallest language), plus the fixed 16 pairs."""
    from ..operators.labels import warm_map_table

    docs = table(spark, sf_dir, "documents").select("source", "lang").where(
        F.col("source").isNotNull() & F.col("lang").isNotNull())
    counts = docs.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("source").orderBy(F.col("n").desc(), F.col("lang").asc())
    top = (counts.withColumn("rk", F.row_number().over(w)).where(F.col("rk") == 1)
           .select(F.col("source").alias("new_label"), F.col("lang").alias("old_label")))
    return warm_map_table(spark).unionByName(top)
