"""Readers and sinks.

CSV stays for compatibility; parquet is the format at scale (a multi-line
CSV cannot be split). Nested columns go to CSV as JSON text and come back
with ``from_json``; parquet keeps them native.
"""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import NA_VALUES, null_tokens_to_null
from . import inference


# what a null counts as in a checksum: CSV does not tell it from an empty text
EMPTY = {"csv": "", "parquet": "\u0000"}
# Fixed value: the suffix of a second copy.
BACKUP_FORMAT = "%Y%m%d_%H%M%S"


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, quote='"', escape='"',
                          mode="FAILFAST", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, na_values: tuple[str, ...] = NA_VALUES) -> DataFrame:
    """S1 (+S6): header CSV; pandas' null tokens become null.

    Without a schema the types are those that pandas would give, told by one
    pass over all values (``inference``). A missing path raises Spark's
    PATH_NOT_FOUND analysis error, a row that does not fit the schema or the
    header fails the job. Texts may hold line breaks, so a file is not split:
    write many files, or parquet, at scale.
    """
    if schema is None:
        names = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"').columns
        texts = null_tokens_to_null(_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in names])), names, na_values)
        return inference.typed(texts, inference.column_types(texts))
    df = _csv(spark, path, schema)
    strings = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return null_tokens_to_null(df, strings, na_values)


def _flat(df: DataFrame) -> DataFrame:
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(*[F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
                       for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S2 (+S5): CSV with header, no index; nested columns as JSON text."""
    _flat(df).write.mode(mode).csv(path, header=True, quote='"', escape='"',
                                   ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def backup_path(path: str, when: datetime.datetime | None = None) -> str:
    """S3 naming: a separate folder with a yyyyMMdd_HHmmss suffix."""
    ts = (when or datetime.datetime.now(datetime.timezone.utc)).strftime(BACKUP_FORMAT)
    return f"{path.rstrip('/')}_backup_{ts}"


def _sums(df: DataFrame, null: str = "\u0000") -> list:
    """Rows, and an order-free checksum of their values: sums of two hashes of each row, in which equal rows count each.

    Nested values count as JSON, nulls as the text ``null``.
    """
    nested = (T.ArrayType, T.StructType, T.MapType)
    values = [F.coalesce(F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`").cast("string"), F.lit(null))
              for f in df.schema.fields]
    none = F.lit(0).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)")), none).alias(f"sum{seed}")
                                               for seed in (1, 2)]]


def _write_summed(df: DataFrame, path: str, fmt: str) -> dict:
    """Write a flat table; its checksum is taken on the way (an ``Observation``, no extra pass)."""
    obs = Observation()
    observed = df.observe(obs, *_sums(df, EMPTY[fmt]))
    if fmt == "csv":
        write_csv(observed, path)
    else:
        observed.write.mode("overwrite").parquet(path)
    return dict(obs.get)


def _read_summed(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> tuple[DataFrame, dict]:
    if fmt == "csv":  # as texts under the written header: a line that does not fit fails instead of becoming null
        df = _csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in schema.names]))
    else:
        df = spark.read.schema(schema).parquet(path)
    return df, df.agg(*_sums(df, EMPTY[fmt])).first().asDict()


def save_with_backup(df: DataFrame, path: str, fmt: str = "csv") -> dict:
    """S3 + S4: write the result into a timestamped folder, copy it to ``path``, compare the values of both.

    The result is computed once, into the second copy's folder, and its
    checksum is taken while it is written; only when what can be read back has
    the same checksum is it copied to ``path``, from the written files, and read
    back there too. A computation that fails leaves the former result as it was
    (and a folder without Spark's success mark). CSV knows no null apart from
    the empty text, so both count the same. The report has the rows of each copy.
    """
    spark, backup = df.sparkSession, backup_path(path)
    flat = _flat(df) if fmt == "csv" else df
    sums = {"written": _write_summed(flat, backup, fmt)}
    rows, sums["backup"] = _read_summed(spark, backup, flat.schema, fmt)
    _same(sums)
    _write_summed(rows, path, fmt)
    sums["read"] = _read_summed(spark, path, flat.schema, fmt)[1]
    _same(sums)
    return {"path": path, "backup": backup, "checksum": f"{sums['written']['sum1']}/{sums['written']['sum2']}",
            **{f"rows_{name}": sums[name]["rows"] for name in ("written", "read", "backup")}}


def _same(sums: dict[str, dict]) -> None:
    if any(s != sums["written"] for s in sums.values()):
        raise RuntimeError(f"the written copies differ: {sums}")


def publish(df: DataFrame, path: str) -> dict:
    """S2 + S4: a new version of a table below ``path``, seen by readers once it is whole and checked.

    A version is its own folder. When its files give the checksum that was taken
    while they were written, a manifest naming it is added; adding is one file
    that appears at once, so a reader sees the former version or the new one, and
    a run that fails at any point leaves the former one in place.
    """
    spark = df.sparkSession
    version = f"{datetime.datetime.now(datetime.timezone.utc).strftime('%Y%m%dT%H%M%S%f')}-{uuid.uuid4().hex[:8]}"
    folder = f"{path.rstrip('/')}/versions/{version}"
    obs = Observation()
    df.observe(obs, *_sums(df)).write.parquet(folder)
    written = dict(obs.get)
    back = spark.read.schema(df.schema).parquet(folder)
    found = back.agg(*_sums(back)).first().asDict()
    _same({"written": written, "read": found})
    manifest = {"version": version, "rows": written["rows"], "checksum": f"{written['sum1']}/{written['sum2']}"}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("append").text(f"{path.rstrip('/')}/manifests")
    return manifest


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version of a published table."""
    # one short line per version
    newest = max(json.loads(r[0])["version"] for r in spark.read.text(f"{path.rstrip('/')}/manifests").collect())
    return spark.read.parquet(f"{path.rstrip('/')}/versions/{newest}")


def write_json_row(df: DataFrame, path: str) -> None:
    """A one-row result (metrics) as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str) -> None:
    """Vocabulary and head tables as parquet."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
