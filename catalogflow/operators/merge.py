"""Merging record sets: replace, patch, upsert, skip, variant order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import blank_text
from ..session import materialize, reusable
from .aggregate import last_wins
from .order import group_position


def _with_key(df: DataFrame, id_col: str) -> DataFrame:
    text = F.col(id_col).cast("string")
    return df.withColumn("__key", F.when(text != "", text))


def merge_batches(original: DataFrame, augmented: DataFrame, id_col: str, aug_order: list[str]) -> DataFrame:
    """Each original row replaced whole by the last augmented row of its id; `replaced` tells which."""
    newest = last_wins(_with_key(augmented, id_col).filter("__key is not null"), ["__key"], aug_order)
    o, a = _with_key(original, id_col).alias("o"), newest.alias("a")
    joined = o.join(a, F.col("o.__key") == F.col("a.__key"), "left")
    hit = F.col("a.__key").isNotNull()
    names = [*original.columns, *[c for c in augmented.columns if c not in original.columns]]

    def side(name: str, frame: DataFrame, alias: str) -> Column:
        return F.col(f"{alias}.{name}") if name in frame.columns else F.lit(None)

    merged = [F.when(hit, side(n, augmented, "a")).otherwise(side(n, original, "o")).alias(n) for n in names]
    return joined.select(*merged, hit.alias("replaced"))


def merge_report(original: DataFrame, augmented: DataFrame, id_col: str) -> DataFrame:
    """One row: replaced, not_found, extras, duplicate ids and missing ids of a merge."""
    o = _with_key(original, id_col).groupBy("__key").agg(F.count(F.lit(1)).alias("o_rows"))
    a = _with_key(augmented, id_col).groupBy("__key").agg(F.count(F.lit(1)).alias("a_rows"))
    both = o.filter("__key is not null").join(a.filter("__key is not null"), "__key", "full")
    counts = both.agg(
        F.coalesce(F.sum(F.when(F.col("a_rows").isNotNull(), F.col("o_rows"))), F.lit(0)).alias("replaced"),
        F.coalesce(F.sum(F.when(F.col("a_rows").isNull(), F.col("o_rows"))), F.lit(0)).alias("not_found"),
        F.count_if(F.col("o_rows").isNull()).alias("extras"),
        F.count_if(F.col("a_rows") > 1).alias("duplicate_ids"),
    )
    missing = a.filter("__key is null").agg(F.coalesce(F.sum("a_rows"), F.lit(0))).scalar()
    return counts.withColumn("missing_ids", missing)


def patch_columns(
    original: DataFrame,
    updated: DataFrame,
    id_col: str,
    order: str,
    overwrite: list[str] = (),
    add: list[str] = (),
    append_new: bool = False,
) -> DataFrame:
    """Take chosen columns from the update: `overwrite` where both sides have them and differ, `add` where missing.

    Rows without id are dropped. A duplicate original id keeps its first position and its last record.
    Adds `overwrites` and `adds`, the number of values taken per row.
    """
    keyed = _with_key(original, id_col).filter("__key is not null")
    firsts = keyed.groupBy("__key").agg(F.min(order).alias("__first"))
    base = last_wins(keyed, ["__key"], [order]).join(firsts, "__key").withColumn(order, F.col("__first")).drop("__first")
    newest = last_wins(_with_key(updated, id_col).filter("__key is not null"), ["__key"], [order])
    joined = base.alias("o").join(newest.alias("u"), "__key", "full" if append_new else "left")
    known = F.col(f"o.{id_col}").isNotNull()
    hit = F.col(f"u.{id_col}").isNotNull()
    changed = {
        c: known & hit & ~F.col(f"u.{c}").eqNullSafe(F.col(f"o.{c}"))
        for c in overwrite
        if c in original.columns and c in updated.columns
    }
    added = [c for c in add if c in updated.columns and c not in original.columns]

    def value(name: str) -> Column:
        old = F.col(f"o.{name}") if name in original.columns else None
        new = F.col(f"u.{name}") if name in updated.columns else F.lit(None)
        if old is None:
            return F.when(hit, new)
        if name in changed:
            return F.when(changed[name] | ~known, new).otherwise(old)
        return F.when(known, old).otherwise(new)

    extra = [c for c in updated.columns if c not in original.columns and append_new and c not in added]
    names = [*original.columns, *added, *extra]
    overwrites = sum((c.cast("int") for c in changed.values()), F.lit(0))
    return joined.select(
        *[(value(n) if n not in extra else F.when(~known, value(n))).alias(n) for n in names],
        overwrites.alias("overwrites"),
        F.when(known & hit, F.lit(len(added))).otherwise(0).alias("adds"),
    )


def skip_existing(df: DataFrame, done: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows still to do, rows already done)."""
    keys = done.select(*key).distinct()
    return df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi")


def product_key(upc: Column, item: Column) -> Column:
    """Key of a product: its code, else 'item_' and the item number."""
    text = F.trim(F.coalesce(upc.cast("string"), F.lit("")))
    return F.when(text != "", text).otherwise(F.concat(F.lit("item_"), item.cast("string")))


def mark_skipped(df: DataFrame, existing: DataFrame, product: str) -> DataFrame:
    """Input rows with `skip`: their color and unit exist complete.

    df: product, color, unit (null = unknown, always processed). existing: product, color, unit, complete.
    """
    done = existing.filter("complete").select(product, "color", "unit").distinct().withColumn("__done", F.lit(True))
    return df.join(done, [product, "color", "unit"], "left").withColumn(
        "skip", F.col("unit").isNotNull() & F.coalesce("__done", F.lit(False))
    ).drop("__done")


def skip_variants(df: DataFrame, existing: DataFrame, product: str) -> DataFrame:
    """Input rows with `skip` as in mark_skipped and the family's `family_skipped`."""
    marked = materialize(mark_skipped(df, existing, product))
    families = marked.groupBy(product).agg(F.bool_and("skip").alias("family_skipped"))
    return marked.join(families, product)


def upsert(existing: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """New rows replace old ones of the same key in place; the rest is kept; unknown keys go to the end.

    Columns of either side are kept; one that only old rows have stays as it was, one that only new rows have is null
    elsewhere. `is_new` then `order` is the output order; order may be null.
    """
    o = existing.withColumn("__old", F.lit(True)).alias("o")
    n = last_wins(new, key, [order]).withColumn("__new", F.lit(True)).alias("n")
    joined = o.join(n, key, "full")
    replaced = F.col("n.__new").isNotNull()

    def value(c: str) -> Column:
        if c not in new.columns:
            return F.col(f"o.{c}")
        old = F.col(f"o.{c}") if c in existing.columns else F.lit(None)
        return F.when(replaced, F.col(f"n.{c}")).otherwise(old).alias(c)

    every = [*existing.columns, *[c for c in new.columns if c not in existing.columns]]
    values = [value(c) for c in every if c not in key and c != order]
    return joined.select(*key, F.coalesce(f"o.{order}", f"n.{order}").alias(order), *values, F.col("o.__old").isNull().alias("is_new"))


def merge_variants(
    inputs: DataFrame, existing: DataFrame, generated: DataFrame, product: str, parts: int | None = None
) -> DataFrame:
    """Final variants of every product in input order: (product, position, source, color, unit, sku).

    inputs: product, ord, color, unit, skip. existing and generated: product, ord, color, unit, sku.
    Skipped rows keep their old variant, others take the new one; rows without unit take the variants of their
    color that no other row claims (new before old); unclaimed new variants come last.
    """
    key = [product, "color", "unit"]
    # each is read several times below
    inputs, existing, generated = reusable(inputs), reusable(existing), reusable(generated)
    newest = materialize(last_wins(existing.select(*key, "sku", "ord"), key, ["ord"]))
    old = newest.select(*key, F.col("sku").alias("old_sku"))
    new = materialize(last_wins(generated.select(*key, "sku", "ord"), key, ["ord"])).select(*key, F.col("sku").alias("new_sku"), F.col("ord").alias("new_ord"))
    with_unit = inputs.filter(F.col("unit").isNotNull() & ~blank_text(F.col("color")))
    keyed = with_unit.join(old, key, "left").join(new, key, "left").select(
        product,
        F.lit(0).alias("stage"),
        F.col("ord"),
        F.when(F.col("skip") & F.col("old_sku").isNotNull(), F.lit("existing")).otherwise(F.lit("generated")).alias("source"),
        "color",
        "unit",
        F.when(F.col("skip") & F.col("old_sku").isNotNull(), F.col("old_sku")).otherwise(F.col("new_sku")).alias("sku"),
    ).filter(F.col("sku").isNotNull())
    keyed = materialize(keyed)
    claimed = keyed.select(*key, "source").distinct()
    spare_new = new.select(*key, F.lit("generated").alias("source"), F.col("new_sku").alias("sku"), F.col("new_ord").alias("rank"))
    spare_old = newest.select(*key, F.lit("existing").alias("source"), "sku", F.col("ord").alias("rank"))
    spare = spare_new.unionByName(spare_old).join(claimed, [*key, "source"], "left_anti")
    spare = spare.withColumn("tier", F.when(F.col("source") == "generated", 0).otherwise(1))
    spare = group_position(spare, [product, "color"], ["tier", "rank", "unit"], "slot", parts)
    unitless = inputs.filter(F.col("unit").isNull() & ~blank_text(F.col("color"))).select(product, "ord", "color")
    unitless = group_position(unitless, [product, "color"], ["ord"], "slot", parts)
    taken = unitless.join(spare, [product, "color", "slot"]).select(
        product, F.lit(0).alias("stage"), "ord", "source", "color", "unit", "sku"
    )
    left_over = (
        spare.filter("source = 'generated'")
        .join(unitless.select(product, "color", "slot"), [product, "color", "slot"], "left_anti")
        .select(product, F.lit(1).alias("stage"), F.col("rank").alias("ord"), "source", "color", "unit", "sku")
    )
    every = keyed.unionByName(taken).unionByName(left_over)
    placed = group_position(every, [product], ["stage", "ord", "color", "unit"], "position", parts)
    return placed.select(product, "position", "source", "color", "unit", "sku")


def carried_images(existing_images: DataFrame, skipped: DataFrame, product: str) -> DataFrame:
    """Old images whose alt text is tagged with a skipped color (#color#)."""
    tagged = existing_images.withColumn("color", F.regexp_extract("alt", "#([^#]+)#", 1))
    return tagged.join(skipped.select(product, "color").distinct(), [product, "color"], "left_semi").drop("color")
