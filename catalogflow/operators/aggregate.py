"""Grouping operators. Partial aggregation everywhere; no group is ever gathered whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import blank_array, blank_text
from .order import Running, group_position, nest, running_values


def _pick(df: DataFrame, key: list[str], order: list[str], chooser) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    rank = F.struct(*[F.col(o) for o in order])
    picked = df.groupBy(*key).agg(chooser(F.struct(*[F.col(c) for c in rest]), rank).alias("__row"))
    return picked.select(*[c if c in key else F.col("__row")[c].alias(c) for c in df.columns])


def last_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last in input order."""
    return _pick(df, key, order, F.max_by)


def first_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in input order."""
    return _pick(df, key, order, F.min_by)


def group_families(
    df: DataFrame, title: str, order: list[str], parts: int | None = None
) -> DataFrame:
    """Rows with a title, with their family's first position and their own position in the family."""
    named = df.withColumn("family", F.trim(F.col(title))).filter(~blank_text(F.col("family")))
    return running_values(
        named,
        ["family"],
        order,
        [Running("member_pos", F.lit(1).cast("bigint")), Running("family_first", F.struct(*order), "first")],
        parts,
    )


def id_quality(df: DataFrame, id_col: str, position: str) -> tuple[DataFrame, DataFrame]:
    """(rows without id, later rows of duplicate ids with the first position).

    Duplicates stay one row each, so an id that fills a third of the table is spread like any other rows.
    """
    key = F.col(id_col).cast("string")
    missing = df.filter(blank_text(key)).select(position)
    present = df.filter(~blank_text(key)).select(key.alias("id"), F.col(position).alias("position"))
    firsts = present.groupBy("id").agg(F.min("position").alias("first_position"), F.count(F.lit(1)).alias("uses"))
    later = present.join(firsts.filter(F.col("uses") > 1), "id").filter(F.col("position") > F.col("first_position"))
    return missing, later.select("id", "first_position", "position")


def duplicate_ids(df: DataFrame, id_col: str, position: str) -> DataFrame:
    """Per duplicate id: first and last position and number of uses."""
    return (
        df.filter(~blank_text(F.col(id_col).cast("string")))
        .groupBy(F.col(id_col).alias("id"))
        .agg(
            F.min(position).alias("first_position"),
            F.max(position).alias("last_position"),
            F.count(F.lit(1)).alias("uses"),
        )
        .filter(F.col("uses") > 1)
    )


def first_seen_values(
    df: DataFrame, family: str, order: str, slots: list[tuple[int, Column, Column]]
) -> DataFrame:
    """The values of the option lists, once each: (family, slot, value, __ord, name), __ord where it is first seen."""
    entries = F.array(
        *[F.struct(F.lit(n).alias("slot"), name.alias("name"), value.cast("string").alias("value")) for n, name, value in slots]
    )
    long = df.select(family, F.col(order).alias("__ord"), F.explode(entries).alias("e")).select(
        family, "__ord", "e.slot", "e.name", "e.value"
    )
    return (
        long.filter(~blank_text(F.col("value")))
        .groupBy(family, "slot", "value")
        .agg(F.min("__ord").alias("__ord"), F.min_by("name", "__ord").alias("name"))
    )


def option_values(
    df: DataFrame, family: str, order: str, slots: list[tuple[int, Column, Column]]
) -> DataFrame:
    """Long form of the option lists: (family, slot, name, value, value_pos) with values in first-seen order.

    slots: (slot number, display name, value). Slots without values do not appear.
    """
    seen = first_seen_values(df, family, order, slots)
    return group_position(seen, [family, "slot"], ["__ord", "value"], "value_pos").drop("__ord")


def product_options(df: DataFrame, family: str, order: str, slots, max_items: int = 1000) -> DataFrame:
    """Options as arrays: (family, slot, part, values); slot order is the option position."""
    seen = first_seen_values(df, family, order, slots)  # numbered once, by the arrays
    return nest(seen, [family, "slot", "name"], ["__ord", "value"], F.col("value"), "values", max_items)


def default_options(df: DataFrame, names: list[str], size: str = "size") -> DataFrame:
    """When no option is named and a size is filled, the first option is the size."""
    unnamed = F.lit(True)
    for name in names:
        unnamed = unnamed & blank_text(F.trim(F.col(name)))
    return df.withColumn(
        names[0], F.when(unnamed & ~blank_text(F.col(size)), F.lit(size)).otherwise(F.col(names[0]))
    )


def option_title(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def missing_fields(weight: Column, cost: Column, model_number: Column, swatch: Column) -> Column:
    """Names of the empty fields of a variant."""
    tests = [
        ("weight", weight.isNull() | (weight == 0)),
        ("cost", cost.isNull() | cost.cast("string").isin("", "0")),
        ("model_number", blank_text(model_number)),
        ("color_swatch", blank_text(swatch)),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests]))


def metafield(metafields: Column, key: str) -> Column:
    """Value of the last metafield with this key."""
    hits = F.filter(metafields, lambda m: m["key"] == key)
    return F.try_element_at(hits, F.lit(-1))["value"]


def missing_report(variants: DataFrame, product: str, missing: str = "missing") -> DataFrame:
    """Variants with missing fields, counted per product and field, with totals per product and overall."""
    long = variants.select(product, F.explode(missing).alias("field"))
    return _rollup_counts(long, product, "field")


def product_gaps(products: DataFrame, images: str, description: str) -> DataFrame:
    """One row: products, products without images, products without description."""
    no_text = blank_text(F.regexp_replace(F.coalesce(description, F.lit("")), r"(?U)^\s+|\s+$", ""))
    return products.agg(
        F.count(F.lit(1)).alias("products"),
        F.count_if(blank_array(F.col(images))).alias("without_images"),
        F.count_if(no_text).alias("without_description"),
    )


def run_summary(outcomes: DataFrame, status: str, reason: str) -> DataFrame:
    """Rows per status and reason with subtotals and the total."""
    return _rollup_counts(outcomes, status, reason)


def _rollup_counts(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Counts per (outer, inner) with subtotals; rows are counted first, so only the counts are repeated per level."""
    counted = df.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("__n"))
    return counted.rollup(outer, inner).agg(F.sum("__n").alias("n"), F.grouping_id().cast("int").alias("level"))


def bucket_manifest(df: DataFrame, key: Column) -> DataFrame:
    return df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "key")


def array_lengths(df: DataFrame) -> DataFrame:
    """One row: the longest array of every array column."""
    arrays = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    return df.agg(*[F.coalesce(F.max(F.size(c)), F.lit(0)).alias(c) for c in arrays])


def variant_image_map(variants: DataFrame, media: DataFrame, product: str, max_keys: int = 1000) -> DataFrame:
    """Images by position with the variant keys that use them; other media only at free positions.

    variants: product, ord, key, position, src, alt. media: product, ord, position, media_type, src, alt.
    Keys of one image go on in further parts beyond max_keys.
    """
    used = variants.filter(~blank_text(F.col("src")))
    images = used.groupBy(product, "position").agg(
        F.min_by("src", "ord").alias("src"), F.min_by("alt", "ord").alias("alt"), F.lit("image").alias("media_type")
    )
    keys = nest(used.select(product, "position", "ord", "key"), [product, "position"], ["ord"], F.col("key"), "variant_keys", max_keys)
    free = media.filter(~blank_text(F.col("src"))).join(images.select(product, "position"), [product, "position"], "left_anti")
    shared = first_wins(free, [product, "position"], ["ord"]).select(
        product,
        "position",
        "src",
        "alt",
        "media_type",
        F.lit(0).cast("bigint").alias("part"),
        F.array().cast("array<string>").alias("variant_keys"),
    )
    return images.join(keys, [product, "position"]).unionByName(shared)


def upc_consensus(images: DataFrame, key: list[str], codes: Column, name: Column, prefix: str) -> DataFrame:
    """Codes found in a product's image addresses: exactly one decides code and key, else the name does.

    Output: key.., n_codes, upc, product_key; the codes themselves come from `image_codes`.
    """
    found = image_codes(images, key, codes)
    counted = found.groupBy(*key).agg(F.count(F.lit(1)).alias("n_codes"), F.min("code").alias("__code"))
    products = images.groupBy(*key).agg(F.min(name).alias("__name")).join(counted, key, "left")
    single = F.coalesce(F.col("n_codes"), F.lit(0)) == 1
    by_name = F.when(
        blank_text(F.col("__name")), F.lit("PRODUCT")
    ).otherwise(F.replace(F.upper("__name"), F.lit(" "), F.lit("-")))
    return products.select(
        *key,
        F.coalesce("n_codes", F.lit(0)).alias("n_codes"),
        F.when(single, F.col("__code")).alias("upc"),
        F.concat(F.lit(f"{prefix}-"), F.when(single, F.col("__code")).otherwise(by_name)).alias("product_key"),
    )


def image_codes(images: DataFrame, key: list[str], codes: Column) -> DataFrame:
    """Distinct codes per product, one row each (the variants of a product without a single code)."""
    return images.select(*key, F.explode(codes).alias("code")).distinct()


def url_codes(c: Column) -> Column:
    """12-digit codes in an address: runs of 12 or 13 digits, a 13-digit code without its leading zero."""
    runs = F.regexp_extract_all(c, F.lit(r"(\d{12,13})"), F.lit(1))
    cut = F.transform(
        runs, lambda d: F.when((F.length(d) == 13) & d.startswith("0"), F.substring(d, 2, 12)).otherwise(d)
    )
    return F.array_distinct(F.filter(cut, lambda d: F.length(d) == 12))


def log_missing_summary(lines: DataFrame, product: str, color: str, item: Column) -> DataFrame:
    """Distinct missing items per product and color, after the log context was carried down."""
    return lines.withColumn("item", item).filter(F.col("item").isNotNull()).select(product, color, "item").distinct()
