"""The missing-value rule: null, NaN, '', empty array, and zero where a number must carry a value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def blank_text(c: Column) -> Column:
    return c.isNull() | (c == "")


def blank_number(c: Column) -> Column:
    return c.isNull() | F.isnan(c.cast("double")) | (c == 0)


def no_number(c: Column) -> Column:
    """Missing number where zero counts as a value."""
    return c.isNull() | F.isnan(c.cast("double"))


def blank_array(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(-1)) <= 0


def blank(df: DataFrame, name: str) -> Column:
    """blank_* chosen by the column's type."""
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, T.StringType):
        return blank_text(c)
    if isinstance(kind, T.NumericType):
        return blank_number(c)
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return blank_array(c)
    if isinstance(kind, T.BooleanType):
        return c.isNull() | ~c
    return c.isNull()


def strip(c: Column) -> Column:
    """Drop white space of every kind at both ends (Spark's trim drops spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def first_text(*cols: Column) -> Column:
    """First value that is not empty text."""
    return F.coalesce(*[F.when(c != "", c) for c in cols])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once; an expression inside a lambda would run again per element."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def distinct_ignoring_case(arr: Column) -> Column:
    """Distinct texts compared without case; the first spelling stays, in first-seen order."""
    pairs = F.struct(arr.alias("own"), F.transform(arr, F.lower).alias("low"))
    return let(
        pairs, lambda p: F.filter(p["own"], lambda x, i: F.array_position(p["low"], F.lower(x)) == i + 1)
    )
