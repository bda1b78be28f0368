"""Expressions over nested records: walkers and dotted paths built from the schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def map_strings(c: Column, kind: T.DataType, fn: Callable[[Column], Column]) -> Column:
    """Apply fn to every string at any depth."""
    if isinstance(kind, T.StringType):
        return fn(c)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: map_strings(x, kind.elementType, fn))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, v: map_strings(v, kind.valueType, fn))
    if isinstance(kind, T.StructType):
        fields = [map_strings(c[f.name], f.dataType, fn).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def map_all_strings(df: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    return df.select(*[map_strings(F.col(f"`{f.name}`"), f.dataType, fn).alias(f.name) for f in df.schema.fields])


def get_path(df: DataFrame, path: str) -> Column:
    """Value at a dotted path; null when any part is missing."""
    kind: T.DataType = df.schema
    c: Column | None = None
    for part in path.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
            return F.lit(None)
        c = F.col(f"`{part}`") if c is None else c[part]
        kind = kind[part].dataType
    return c


def set_path(df: DataFrame, path: str, value: Column) -> DataFrame:
    """Write a value at a dotted path; missing levels are created."""
    head, *rest = path.split(".")

    def put(c: Column | None, kind: T.DataType | None, parts: list[str]) -> Column:
        if not parts:
            return value
        name = parts[0]
        if isinstance(kind, T.StructType):
            inner = kind[name].dataType if name in kind.fieldNames() else None
            below = put(c[name] if inner is not None else None, inner, parts[1:])
            others = [c[f].alias(f) for f in kind.fieldNames() if f != name]
            fields = [below.alias(f) if f == name else c[f].alias(f) for f in kind.fieldNames()]
            return F.struct(*fields) if inner is not None else F.struct(*others, below.alias(name))
        return F.struct(put(None, None, parts[1:]).alias(name))

    present = head in df.columns
    c = F.col(f"`{head}`") if present else None
    kind = df.schema[head].dataType if present else None
    return df.withColumn(head, put(c, kind, rest))


def dotted_columns(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """(access path, dotted name) of every leaf; arrays stay whole."""
    leaves: list[tuple[str, str]] = []
    for field in schema.fields:
        path = f"{prefix}`{field.name}`"
        if isinstance(field.dataType, T.StructType):
            leaves += dotted_columns(field.dataType, f"{path}.")
        else:
            leaves.append((path, path.replace("`", "")))
    return leaves
