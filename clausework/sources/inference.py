"""Column types of a text table, as pandas would read them.

Every value has a kind, a bit; a column's kinds are merged by OR, which is
associative, so one aggregate over all rows, combined map-side, tells the types
of all columns at once. No sample decides.

A column of whole numbers is a long, with missing values a double (a missing
value has no place among whole numbers there); of numbers a double; of truth
values alone a boolean; of missing values alone a double; anything else, also a
mixture or a column without rows, stays text. Whole numbers beyond a long make
text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING, WHOLE, NUMBER, TRUTH, TEXT = 1, 2, 4, 8, 16

# fixed values: spellings of truth values and of numbers
TRUE, FALSE = ("True", "TRUE", "true"), ("False", "FALSE", "false")
WHOLE_FORM = r"^[ \t]*[+-]?[0-9]+[ \t]*$"
NUMBER_FORM = r"^[ \t]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t]*$"
ENDLESS_FORM = r"^[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?$"


def kind(value: Column) -> Column:
    """The kind of one value (null: missing)."""
    whole = value.rlike(WHOLE_FORM)
    return (F.when(value.isNull(), MISSING)
            .when(whole & F.btrim(value, F.lit(" \t")).try_cast("long").isNotNull(), WHOLE)
            .when(whole, TEXT).when(value.rlike(NUMBER_FORM) | value.rlike(ENDLESS_FORM), NUMBER)
            .when(value.isin(*TRUE, *FALSE), TRUTH).otherwise(TEXT))


def type_of(kinds: int | None) -> str:
    """The type of a column with these kinds."""
    if kinds is None:
        return "string"
    if kinds == WHOLE:
        return "bigint"
    if kinds == TRUTH:
        return "boolean"
    return "double" if not kinds & (TRUTH | TEXT) else "string"


def column_types(texts: DataFrame) -> dict[str, str]:
    """The type of every column of a table of texts whose missing values are null: one pass, one row back."""
    found = texts.agg(*[F.bit_or(kind(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(texts.columns)]).first()
    return {c: type_of(found[f"k{i}"]) for i, c in enumerate(texts.columns)}


def typed(texts: DataFrame, types: dict[str, str]) -> DataFrame:
    """The texts as values of these types."""
    def value(c: str) -> Column:
        text, t = F.col(f"`{c}`"), types[c]
        if t == "string":
            return text.alias(c)
        if t == "boolean":
            return F.when(text.isNotNull(), text.isin(*TRUE)).alias(c)
        return F.btrim(text, F.lit(" \t")).cast(t).alias(c)

    return texts.select(*[value(c) for c in texts.columns])
