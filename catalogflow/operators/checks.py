"""Row checks, summaries and input validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.codes import valid_upc
from ..functions.values import blank, blank_array, blank_text, no_number
from ..functions import fixed
from .lookup import family_key


def missing_names(df: DataFrame, names: list[str]) -> Column:
    return F.array_compact(F.array(*[F.when(blank(df, n), F.lit(n)) for n in names]).cast("array<string>"))


def required_fields(df: DataFrame, critical: list[str], important: list[str]) -> DataFrame:
    """is_valid (nothing critical missing) and the missing names of both kinds."""
    out = df.withColumns(
        {"missing_critical": missing_names(df, critical), "missing_important": missing_names(df, important)}
    )
    return out.withColumn("is_valid", F.size("missing_critical") == 0)


def any_data(df: DataFrame, names: list[str]) -> DataFrame:
    """Portal rule: valid as soon as one of the fields carries data."""
    missing = missing_names(df, names)
    return df.withColumns({"missing_important": missing, "is_valid": F.size(missing) < len(names)})


def color_table_failures(df: DataFrame, needed: list[str], kind: str | None = None, kinds: list[str] = ()) -> DataFrame:
    """One row: how many rows a color table holds and how many break its rule (a run stops when bad or empty)."""
    bad = F.size(missing_names(df, needed)) > 0
    if kind:
        bad = bad | ~F.coalesce(F.col(kind).isin(list(kinds)), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_bad")).withColumn(
        "fails", (F.col("n_rows") == 0) | (F.col("n_bad") > 0)
    )


def data_summary(df: DataFrame, flags: list[str], arrays: list[str]) -> DataFrame:
    """has_<name> flags and <name>_count counts."""
    out = {f"has_{n}": ~blank(df, n) for n in flags}
    out.update({f"{n}_count": F.greatest(F.coalesce(F.size(F.col(n)), F.lit(0)), F.lit(0)) for n in arrays})
    return df.withColumns(out)


def variant_complete(sku: Column, price: Column, cost: Column) -> Column:
    return ~blank_text(sku.cast("string")) & ~blank_text(price.cast("string")) & ~blank_text(cost.cast("string"))


# Units of sale in order of preference.
SALE_UNITS = ["Piece", "Kit", "Sq Ft"]


def variant_unit(prices: dict[str, tuple[Column, Column]], units: list[str] = SALE_UNITS) -> Column:
    """First unit of sale whose cost and price both carry a number. prices: unit -> (cost, price)."""
    tries = [F.when(~no_number(prices[u][0]) & ~no_number(prices[u][1]), F.lit(u)) for u in units if u in prices]
    return F.coalesce(*tries)


def index_stale(updated: Column, now: Column, max_age_days: int = fixed.INDEX_MAX_AGE_DAYS) -> Column:
    """Whether an index must be rebuilt: no readable build time, or more whole days old than allowed."""
    ts = F.try_to_timestamp(updated.cast("string"))
    seconds = F.unix_micros(now.cast("timestamp")) - F.unix_micros(ts)
    return F.coalesce(F.floor(seconds / F.lit(86_400_000_000)) > max_age_days, F.lit(True))


def validate_input(
    df: DataFrame,
    item: str = "item_no",
    parent: str = "parent",
    upc: str = "upc_updated",
    required: list[str] = (),
    options: list[str] = ("option_1", "option_2", "option_3", "option_4"),
    data_columns: list[str] = (),
) -> DataFrame:
    """One row per violation: (item, rule, detail). Eight rules; joins only on item keys."""
    text = F.lit("").cast("string")
    own, up = family_key(df, item, item), family_key(df, parent, item)

    def found(frame: DataFrame, rule: str, detail: Column = text) -> DataFrame:
        return frame.select(own.alias("item"), F.lit(rule).alias("rule"), detail.alias("detail"))

    # rules on the row alone: one pass
    row_rules = [
        *[F.struct(F.lit("required_missing").alias("rule"), F.lit(n).alias("detail"), blank(df, n).alias("hit")) for n in required],
        F.struct(
            F.lit("bad_upc").alias("rule"),
            F.coalesce(F.col(upc).cast("string"), text).alias("detail"),
            (~valid_upc(F.col(upc))).alias("hit"),
        ),
        *[
            F.struct(
                F.lit("option_without_data").alias("rule"),
                F.lit(o).alias("detail"),
                _names_blank_column(df, o, list(data_columns)).alias("hit"),
            )
            for o in options
        ],
    ]
    by_row = df.select(own.alias("item"), F.explode(F.array(*row_rules)).alias("r")).filter("r.hit").select(
        "item", "r.rule", "r.detail"
    )
    parents = df.select(own.alias("__p"), up.alias("__pp")).groupBy("__p").agg(F.max("__pp").alias("__pp"))
    children = df.filter(up.isNotNull() & ~up.eqNullSafe(own)).select(own.alias(item), up.alias("__up"))
    linked = children.join(parents, F.col("__up") == F.col("__p"), "left")
    detail = F.col("__up").cast("string")
    orphan = found(linked.filter(F.col("__p").isNull()), "parent_missing", detail)
    not_self = found(
        linked.filter(F.col("__p").isNotNull() & ~F.col("__pp").eqNullSafe(F.col("__p"))), "parent_not_self", detail
    )
    circular = found(linked.filter(F.col("__pp") == own), "parent_circular", detail)
    duplicate = found(df.groupBy(item).count().filter("count > 1"), "duplicate_item", F.col("count").cast("string"))
    family = F.coalesce(up, own)
    signature = F.concat_ws("|", *[F.coalesce(F.col(o), text) for o in options])
    mixed = df.groupBy(family.alias(item)).agg(F.min(signature).alias("__a"), F.max(signature).alias("__b"))
    disagree = found(mixed.filter(F.col("__a") != F.col("__b")), "options_disagree")
    out = by_row
    for part in (orphan, not_self, circular, duplicate, disagree):
        out = out.unionByName(part)
    return out


def _names_blank_column(df: DataFrame, option: str, data_columns: list[str]) -> Column:
    hit = F.lit(False)
    for name in data_columns:
        hit = hit | ((F.lower(F.trim(F.col(option))) == name) & blank(df, name))
    return F.coalesce(hit, F.lit(False))


def valid_gallery(c: Column) -> Column:
    return ~blank_array(c)
