"""Parsing of list and id literals and of loosely typed settings."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_JSON = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}

# Text the JSON reader may decode differently from a list literal: escapes other than
# those that mean the same in both, nested brackets or braces, bare words.
_NOT_PLAIN = (
    r"""(?<!\\)(?:\\\\)*\\(?![\\"'ntrbf])|^.+[\[{]|[\[,]\s*(true|false|null|NaN|-?Infinity)\s*[,\]]"""
)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _literal_list(texts: pd.Series) -> pd.Series:
    def parse(text):
        if text is None:
            return None
        try:
            value = ast.literal_eval(text)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return [text]
        if not isinstance(value, list):
            return [str(value)]
        return [None if item is None else str(item) for item in value]

    return texts.map(parse, na_action="ignore")


def _native_list(text: Column) -> Column:
    """A list literal that the JVM reads as Python would; null for any other text."""
    body = F.trim(text)
    bracketed = body.startswith("[") & body.endswith("]")
    plain = bracketed & ~body.rlike("(?s)" + _NOT_PLAIN)
    return F.from_json(F.when(plain, body), "array<string>", _JSON)


def _unsettled(text: Column) -> Column:
    """Whether a text may be a literal that only Python can tell."""
    like = F.trim(text).rlike(r"^[\[('\"{]")
    return F.coalesce(like & _native_list(text).isNull(), F.lit(False))


def text_list(text: Column, exact: bool = True) -> Column:
    """List literal → array; any other text → one-element array; null stays null.

    Plain lists, with the usual escapes, are parsed in the JVM. With ``exact`` the remaining literals
    (rare escapes, nesting, bare words) go through Python in Arrow batches, and
    every other row is sent there as null; ``with_text_list`` sends only those rows.
    """
    native = _native_list(text)
    if not exact:
        return F.coalesce(native, F.array(text))
    return F.when(text.isNotNull(), F.coalesce(native, _literal_list(F.when(_unsettled(text), text)), F.array(text)))


def with_text_list(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """``text_list`` of a column; rows the JVM can settle never reach Python.

    ``df`` is read twice, once for either kind of row.
    """
    text, out = F.col(column), out or column
    settled = df.where(~_unsettled(text)).withColumn(out, F.when(text.isNotNull(), F.coalesce(_native_list(text), F.array(text))))
    rest = df.where(_unsettled(text)).withColumn(out, F.coalesce(_literal_list(text), F.array(text)))
    return settled.unionByName(rest)


def whole_number(text: Column) -> Column:
    """BIGINT of digits, also written ``7.0`` as CSV hops leave it; else null."""
    body = F.trim(text)
    return F.coalesce(
        body.try_cast("bigint"),
        F.regexp_extract(body, r"^(-?\d+)\.0+$", 1).try_cast("bigint"),
    )


def id_list(text: Column) -> Column:
    """All ids of a scalar or list literal; null when any of them is no id."""
    body = F.trim(text)
    items = F.from_json(F.when(body.startswith("["), body), "array<string>", _JSON)
    ids = F.when(body.startswith("["), F.transform(items, whole_number)).otherwise(
        F.array(whole_number(body))
    )
    usable = (F.size(ids) > 0) & ~F.exists(ids, lambda i: i.isNull())
    return F.when(usable, ids)


def first_id(text: Column) -> Column:
    """First id of a list literal, or the id itself; null when there is none."""
    body = F.trim(text)
    items = F.from_json(F.when(body.startswith("["), body), "array<string>", _JSON)
    head = F.try_element_at(items, F.lit(1))
    return whole_number(F.when(body.startswith("["), head).otherwise(body))


def safe_int(value: Column, default: int = 0) -> Column:
    return F.coalesce(value.try_cast("int"), F.lit(default).cast("int"))


def safe_float(value: Column, default: float = 0.0) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(float(default)))


def safe_bool(value: Column, default: bool = False, numeric: bool = False) -> Column:
    """Text is true only as ``true``, ``1`` or ``yes`` in any case; a number unless 0."""
    if numeric:
        return F.coalesce(value != 0, F.lit(default))
    return F.coalesce(F.lower(value.cast("string")).isin("true", "1", "yes"), F.lit(default))
