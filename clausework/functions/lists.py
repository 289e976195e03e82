"""Parse Python-style list literals held in a string column (C3 strict, C4 tolerant).

Fast path (JVM only): a literal that is a list of plainly quoted strings
(no backslash, no control character, commas between items, optional trailing
comma) is matched by a regular grammar and split with ``regexp_extract_all``.
Slow path: every other non-null text goes to an Arrow-batched pandas UDF that
applies Python's literal grammar. The UDF receives null for fast-path rows,
so it is one scan and the Python side only does work for the odd rows.

Result struct: ``items ARRAY<STRING>`` and ``status INT``:
0 list, 1 other literal (wrapped as one item), 2 not a literal (stripped
fallback), 3 other failure (the caller resets the row).
"""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import UNKNOWN, strip_brackets_quotes

OK, WRAPPED, FALLBACK, FAILED = 0, 1, 2, 3

_ITEM = r"""(?:'[^'\\\x00-\x08\x0a-\x1f]*'|"[^"\\\x00-\x08\x0a-\x1f]*")"""
_SP = r"[ \t]*"
FAST_LIST = rf"^{_SP}\[{_SP}(?:{_ITEM}{_SP}(?:,{_SP}{_ITEM}{_SP})*(?:,{_SP})?)?\]{_SP}$"
_ITEM_EXTRACT = r"""('[^']*'|"[^"]*")"""

PARSED = T.StructType([
    T.StructField("items", T.ArrayType(T.StringType(), False), True),
    T.StructField("status", T.IntegerType(), False),
])


def _read_literal(text: str | None) -> tuple[list[str] | None, int]:
    """The items that Python's literal grammar finds, and how it went; no items where the JVM decides."""
    if not isinstance(text, str):
        return None, OK
    try:
        value = ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return None, FALLBACK
    except Exception:  # nested too deep, an unhashable key ...
        return None, FAILED
    return ([str(v) for v in value], OK) if isinstance(value, list) else ([str(value)], WRAPPED)


@F.pandas_udf(PARSED)
def _slow_parse(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_read_literal(t) for t in texts], columns=["items", "status"])


def is_fast_list(text: Column) -> Column:
    return text.rlike(FAST_LIST)


def fast_items(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(_ITEM_EXTRACT), 1),
                       lambda x: F.substring(x, F.lit(2), F.length(x) - 2))


def parse_list(text: Column) -> Column:
    """Struct(items, status) for a list-literal text column; null stays null."""
    fast = is_fast_list(text)
    slow = _slow_parse(F.when(~fast, text))
    bare = strip_brackets_quotes(text)
    status = slow.getField("status")
    items = (F.when(status == FALLBACK, F.array(F.when(F.length(bare) > 0, bare).otherwise(F.lit(UNKNOWN))))
             .when(status == FAILED, F.array(F.lit(UNKNOWN))).otherwise(slow.getField("items")))
    return (F.when(text.isNull(), F.lit(None).cast(PARSED))
            .when(fast, F.struct(fast_items(text).alias("items"), F.lit(OK).alias("status")))
            .otherwise(F.struct(items.alias("items"), status.alias("status"))))


def write_list(items: Column) -> Column:
    """A string array as a list literal that reads back to the same items.

    Backslashes, quotes and control characters are escaped; a null array is null.
    """
    def quoted(x: Column) -> Column:
        for raw, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\x00", "\\x00")):
            x = F.replace(x, F.lit(raw), F.lit(escaped))
        return F.concat(F.lit("'"), x, F.lit("'"))

    return F.concat(F.lit("["), F.array_join(F.transform(items, quoted), ", "), F.lit("]"))


def parse_list_tolerant(text: Column) -> Column:
    """items of ``parse_list``; null text counts as ``[]`` (C4)."""
    return F.coalesce(parse_list(text).getField("items"), F.array().cast("array<string>"))


def parse_list_strict(text: Column) -> Column:
    """items of ``parse_list``; anything but a list literal fails the job."""
    p = parse_list(text)
    return F.when(p.isNull() | (p.getField("status") != OK),
                  F.raise_error(F.concat(F.lit("not a list literal: "), F.coalesce(text, F.lit("null"))))
                  ).otherwise(p.getField("items"))


__all__ = ["parse_list", "write_list", "parse_list_tolerant", "parse_list_strict", "is_fast_list", "fast_items",
           "strip_brackets_quotes", "OK", "WRAPPED", "FALLBACK", "FAILED", "FAST_LIST"]
