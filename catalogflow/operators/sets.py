"""Set operations on records, images and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.urls import dedupe_urls, strip_query
from ..functions.values import blank_text
from .aggregate import first_wins


def dedupe_images(df: DataFrame, product: list[str], src: str, order: list[str]) -> DataFrame:
    """First image per product and address, query dropped, compared without case."""
    cleaned = df.withColumn(src, strip_query(F.col(src), keep_fragment=True)).filter(~blank_text(F.col(src)))
    keyed = cleaned.withColumn("__key", F.lower(src))
    return first_wins(keyed, [*product, "__key"], order).drop("__key")


def append_new(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """a plus the rows of b whose key a lacks."""
    return a.unionByName(b.join(a.select(*key), key, "left_anti"), allowMissingColumns=True)


def key_differences(original: DataFrame, augmented: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: (key, side) with side 'not_found' (original only) or 'extra' (augmented only)."""
    left = original.select(key).filter(F.col(key).isNotNull()).distinct()
    right = augmented.select(key).filter(F.col(key).isNotNull()).distinct()
    only_left = left.join(right, key, "left_anti").select(key, F.lit("not_found").alias("side"))
    only_right = right.join(left, key, "left_anti").select(key, F.lit("extra").alias("side"))
    return only_left.unionByName(only_right)


def union_candidates(*tiers: Column, cap: int | None = None) -> Column:
    """Candidates of several patterns in order, first link kept."""
    out = dedupe_urls(F.concat(*tiers))
    return F.slice(out, 1, cap) if cap else out


def category_tree_schema(levels: int) -> T.StructType:
    """Schema of a nested category tree of bounded depth."""
    base = [T.StructField("fullurl", T.StringType()), T.StructField("level", T.StringType())]
    schema = T.StructType(base)
    for _ in range(levels - 1):
        schema = T.StructType([*base, T.StructField("categories", T.ArrayType(schema))])
    return schema


def category_urls(trees: DataFrame, tree: str, levels: int = 6, skip: str = "/accessories") -> DataFrame:
    """Category pages of nested trees: level >= 2, at least two slashes, skipped branch left out with its children.

    trees has one row per document with its key columns and a JSON array of root categories. Output: key.., url,
    path (positions from the root; sorting by it is the reading order), first appearance of each url only.
    """
    keys = [c for c in trees.columns if c != tree]
    roots = F.from_json(F.col(tree), T.ArrayType(category_tree_schema(levels)))
    walk = trees.select(*keys, F.transform(roots, lambda n, i: F.struct(F.array(i).alias("path"), n.alias("node"))).alias("l0"))
    for depth in range(levels):
        # each level is a column of its own, so the document is parsed once
        kept = F.filter(F.col(f"l{depth}"), lambda x: ~F.coalesce(x["node"]["fullurl"].startswith(skip), F.lit(False)))
        walk = walk.withColumn(f"l{depth}", kept)
        if depth < levels - 1:
            below = F.transform(
                F.col(f"l{depth}"),
                lambda x: F.transform(
                    x["node"]["categories"], lambda c, i: F.struct(F.concat(x["path"], F.array(i)).alias("path"), c.alias("node"))
                ),
            )
            walk = walk.withColumn(f"l{depth + 1}", F.flatten(F.filter(below, lambda x: x.isNotNull())))
    entries = [
        F.transform(
            F.col(f"l{depth}"),
            lambda x: F.struct(
                x["path"].alias("path"), x["node"]["fullurl"].alias("url"),
                F.coalesce(x["node"]["level"].try_cast("int"), F.lit(1)).alias("level"),
            ),
        )
        for depth in range(levels)
    ]
    found = walk.select(*keys, F.explode(F.concat(*[F.coalesce(e, F.slice(entries[0], 1, 0)) for e in entries])).alias("e")).select(*keys, "e.*")
    slashes = F.length("url") - F.length(F.replace(F.col("url"), F.lit("/"), F.lit("")))
    pages = found.filter((F.col("level") >= 2) & ~blank_text(F.col("url")) & (slashes >= 2))
    return pages.groupBy(*keys, "url").agg(F.min("path").alias("path"))
