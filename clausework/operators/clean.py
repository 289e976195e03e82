"""Validation, profiling and cleaning of a clause table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import CUT_CHARS, CUT_SUFFIX, as_text, cut_text
from ._util import require_columns

# The field values a pandas CSV read treats as missing by default
# (Spark's CSV reader knows one null token, so the rest are mapped after the read).
NA_VALUES = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
             "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def validate(df: DataFrame, required: tuple[str, ...] = ("clause", "predicted_actors")) -> DataFrame:
    """V1 + V2: required columns present and at least one row."""
    require_columns(df, list(required))
    if df.isEmpty():
        raise ValueError("the input table has no rows")
    return df


def profile(df: DataFrame, columns: tuple[str, ...] = ("clause", "predicted_actors")) -> DataFrame:
    """V3: row count and non-null count per column, one aggregate pass."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count(F.col(c)).alias(f"n_{c}") for c in columns]
    return df.agg(*aggs)


def null_tokens_to_null(df: DataFrame, columns: list[str], na_values: tuple[str, ...] = NA_VALUES) -> DataFrame:
    """CSV null rule: every field equal to one of ``na_values`` becomes null."""
    out = df
    for c in columns:
        out = out.withColumn(c, F.when(F.col(c).isin(list(na_values)), F.lit(None)).otherwise(F.col(c)))
    return out


def fill_missing(df: DataFrame, fills: dict[str, str] | None = None) -> DataFrame:
    """Fill nulls per column (clause -> "", predicted_actors -> "[]")."""
    fills = fills or {"clause": "", "predicted_actors": "[]"}
    return df.na.fill({k: v for k, v in fills.items() if k in df.columns})


def text_column(df: DataFrame, column: str = "clause", null_text: str = "") -> DataFrame:
    """Cast to text, null -> ``null_text`` ("nan" reproduces pandas)."""
    return df.withColumn(column, as_text(F.col(column), null_text))


def cut(df: DataFrame, column: str = "clause", max_chars: int | None = CUT_CHARS,
        suffix: str = CUT_SUFFIX, out: str | None = None) -> DataFrame:
    """Cut to ``max_chars`` characters + suffix; ``None`` keeps the text."""
    target = out or column
    if max_chars is None:
        return df.withColumn(target, F.col(column))
    return df.withColumn(target, cut_text(F.col(column), max_chars, suffix))


def preview(df: DataFrame, n: int = 3, column: str = "clause", chars: int = 100,
            order_by: str = "row_id") -> DataFrame:
    """First ``n`` rows by key with the text cut to ``chars`` (a top-n report)."""
    return (df.orderBy(order_by).limit(n)
            .withColumn(column, cut_text(F.col(column), chars, CUT_SUFFIX)))
