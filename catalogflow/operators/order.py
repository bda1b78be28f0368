"""Order as data: positions and running values over inputs of any size and any skew.

Input order is part of the meaning (slices, first and last wins, numbering). A window over one big group, or over no
group at all, would put that group in one task. Here rows are range-partitioned by (group, order), so even a single
group is spread over many partitions. Every partition is scanned by itself; what earlier partitions hold of the group a
partition begins with comes in through a table with one row per partition, summed in two levels: within runs of
partitions, and over these runs. The plan is the same for every size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize, reusable

RUN = 256  # partitions whose totals are summed by one window
_PART, _RUN, _GROUP, _AT, _ROW = "__part", "__run", "__group", "__at", "__row"


@dataclass
class Running:
    """A running value per group in order. kind: sum, max, xor, last (last non-null), first (first non-null)."""

    name: str
    value: Column
    kind: str = "sum"
    exclude_current: bool = False


def _combine(kind: str, before: Column, here: Column) -> Column:
    if kind == "sum":
        return F.coalesce(before + here, here, before)
    if kind == "xor":
        return F.coalesce(before.bitwiseXOR(here), here, before)
    if kind == "max":
        return F.greatest(before, here)
    if kind == "last":
        return F.coalesce(here, before)
    return F.coalesce(before, here)


def _window_value(kind: str, value: Column) -> Column:
    return {
        "sum": lambda: F.sum(value),
        "xor": lambda: F.bit_xor(value),
        "max": lambda: F.max(value),
        "last": lambda: F.last(value, ignorenulls=True),
        "first": lambda: F.first(value, ignorenulls=True),
    }[kind]()


def _total(kind: str, value: Column, order: Column) -> Column:
    if kind in ("last", "first"):
        filled = F.when(value.isNotNull(), order)
        return F.max_by(value, filled) if kind == "last" else F.min_by(value, filled)
    return _window_value(kind, value)


def _struct(keys: list[str]) -> Column:
    return F.struct(*[F.col(k).alias(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))


def _partitions(df: DataFrame, parts: int | None) -> int:
    return parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _carried(ends: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """What the partitions before hold of the group a partition begins with: a row per partition, none for a first one.

    ends: a row per partition with _PART, head (its first group), tail (its last) and the tail's totals.
    """
    tails = ends.select(F.col("tail").alias(_GROUP), (F.col(_PART) * 2 + 1).alias(_AT), *kinds)
    heads = ends.select(F.col("head").alias(_GROUP), (F.col(_PART) * 2).alias(_AT))
    events = tails.unionByName(heads, allowMissingColumns=True).withColumn(_RUN, F.floor(F.col(_AT) / (2 * RUN)))
    before = Window.partitionBy(_GROUP, _RUN).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    within = events.withColumns({n: _window_value(k, F.col(n)).over(before) for n, k in kinds.items()}).filter(F.col(_AT) % 2 == 0)

    runs = events.groupBy(_GROUP, _RUN).agg(*[_total(k, F.col(n), F.col(_AT)).alias(n) for n, k in kinds.items()])
    upto = events.filter(F.col(_AT) % 2 == 0).groupBy(F.col(_GROUP).alias("__of")).agg(F.max(_RUN).alias("__upto"))
    later = runs.join(upto, (F.col(_GROUP).eqNullSafe(F.col("__of"))) & (F.col("__upto") > F.col(_RUN)))
    spread = later.withColumn("__to", F.explode(F.sequence(F.col(_RUN) + 1, F.col("__upto"))))
    over = spread.groupBy("__of", "__to").agg(*[_total(k, F.col(n), F.col(_RUN)).alias(f"__over_{n}") for n, k in kinds.items()])
    both = within.join(over, F.col(_GROUP).eqNullSafe(F.col("__of")) & (F.col(_RUN) == F.col("__to")), "left")
    return both.select(
        (F.col(_AT) / 2).cast("int").alias(_PART), F.col(_GROUP),
        *[_combine(k, F.col(f"__over_{n}"), F.col(n)).alias(f"__before_{n}") for n, k in kinds.items()],
    )


def running_values(df: DataFrame, group: list[str], order: list[str], values: list[Running], parts: int | None = None) -> DataFrame:
    """Add running values per group in ascending order. (group, order) must identify a row.

    Costs a range shuffle of the rows (whose sampling reads their source once more) and one by (partition, group). The
    result of both is written to the shared folder, so that what follows sees the very same partitions. parts: range partitions,
    by default the session's number of shuffle partitions.
    """
    keys = [*group, *order]
    ranged = df.repartitionByRange(_partitions(df, parts), *keys).withColumn(_PART, F.spark_partition_id())
    base = Window.partitionBy(_PART, *group).orderBy(*order)
    here = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = base.rowsBetween(Window.unboundedPreceding, -1)
    found = {v.name: _window_value(v.kind, v.value).over(earlier if v.exclude_current else here) for v in values}
    whole = {f"__upto_{v.name}": _window_value(v.kind, v.value).over(here) for v in values if v.exclude_current}
    local = materialize(ranged.withColumns(found | whole))

    totals = [F.col(f"__upto_{v.name}" if v.exclude_current else v.name).alias(v.name) for v in values]
    last = F.max_by(F.struct(_struct(group).alias("tail"), *totals), _struct(keys))
    ends = local.groupBy(_PART).agg(F.min_by(_struct(group), _struct(keys)).alias("head"), last.alias("last")).select(_PART, "head", "last.*")
    carried = F.broadcast(_carried(ends, {v.name: v.kind for v in values}))  # at most a row per partition
    joined = local.join(carried, _PART, "left")
    continues = _struct(group).eqNullSafe(F.col(_GROUP))
    whole_value = {v.name: _combine(v.kind, F.when(continues, F.col(f"__before_{v.name}")), F.col(v.name)) for v in values}
    return joined.withColumns(whole_value).drop(_PART, _GROUP, *whole, *[f"__before_{v.name}" for v in values])


def distributed_sequence(df: DataFrame, order: list[str], name: str = "seq", parts: int | None = None) -> DataFrame:
    """Contiguous 0-based position of every row in the given order (which must be unique).

    One range shuffle: rows are counted within their sorted partitions, and the partitions' counts are summed.
    """
    placed = df.repartitionByRange(_partitions(df, parts), *order).sortWithinPartitions(*order)
    placed = placed.withColumn(_ROW, F.monotonically_increasing_id())  # partition in the upper bits, place within it below
    local = materialize(placed.withColumns({_PART: F.shiftright(_ROW, 33).cast("int"), name: F.col(_ROW).bitwiseAND((1 << 33) - 1)}).drop(_ROW))
    ends = local.groupBy(_PART).agg(F.count(F.lit(1)).alias(name)).select(_PART, _struct([]).alias("head"), _struct([]).alias("tail"), name)
    carried = F.broadcast(_carried(ends, {name: "sum"}).drop(_GROUP))  # at most a row per partition
    total = F.col(name) + F.coalesce(F.col(f"__before_{name}"), F.lit(0))
    return local.join(carried, _PART, "left").withColumn(name, total).drop(_PART, f"__before_{name}")


def group_position(df: DataFrame, group: list[str], order: list[str], name: str = "pos", parts: int | None = None) -> DataFrame:
    """1-based position of every row inside its group; a group may be larger than a task."""
    return running_values(df, group, order, [Running(name, F.lit(1).cast("bigint"))], parts)


def record_range(
    df: DataFrame, order: list[str], start: int | None, end: int | None, parts: int | None = None
) -> DataFrame:
    """1-based inclusive slice of the ordered rows; a blank or bad start means the first row."""
    first = start if start and start >= 1 else 1
    numbered = distributed_sequence(df, order, "__seq", parts)
    kept = numbered.filter(F.col("__seq") >= first - 1)
    if end:
        kept = kept.filter(F.col("__seq") <= end - 1)
    return kept.drop("__seq")


def split_batches(
    df: DataFrame, size: int, order: list[str], parts: int | None = None
) -> DataFrame:
    """Batch number (from 1) and its zero-padded label for `size` rows per batch, in order."""
    numbered = distributed_sequence(df, order, "__seq", parts)
    batches = df.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / size)).alias("n")).scalar()
    digits = F.greatest(F.lit(3), F.length(batches.cast("string")))
    return (
        numbered.withColumn("batch", F.floor(F.col("__seq") / size) + 1)
        .withColumn("batch_label", F.lpad(F.col("batch").cast("string"), digits, F.lit("0")))
        .drop("__seq")
    )


def nest(
    df: DataFrame,
    key: list[str],
    order: list[str],
    item: Column,
    name: str = "items",
    max_items: int = 1000,
    parts: int | None = None,
    numbered: bool = False,
) -> DataFrame:
    """Rows of a key as ordered arrays of at most `max_items`: (key.., part, items).

    A key that outgrows one array goes on in part 1, 2, ..; nothing is dropped and no task holds a whole hot key. Positions are
    worked out only if some key outgrows one. numbered: order is one column that numbers the rows of a key from 1.
    """
    if numbered:
        placed = df.withColumn("__pos", F.col(order[0]))
    else:
        df = reusable(df)
        if df.groupBy(*key).count().filter(F.col("count") > max_items).isEmpty():
            rows = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], item.alias("item"))
            whole = df.groupBy(*key).agg(F.array_sort(F.collect_list(rows)).alias("__sorted"))
            return whole.select(*key, F.lit(0).cast("bigint").alias("part"), F.transform("__sorted", lambda x: x["item"]).alias(name))
        placed = group_position(df, key, order, "__pos", parts)
    return (
        placed.groupBy(*key, F.floor((F.col("__pos") - 1) / max_items).alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("__pos").alias("pos"), item.alias("item")))).alias("__sorted"))
        .select(*key, "part", F.transform("__sorted", lambda x: x["item"]).alias(name))
    )


def candidate_cap(df: DataFrame, key: list[str], order: list[Column], n: int) -> DataFrame:
    """First n rows per key. Spark turns rank <= n into a limit before the shuffle, so a hot key stays small."""
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter(F.col("__rank") <= n).drop("__rank")


def multi_key_sort(df: DataFrame, specs: list[tuple[Column, bool]], tie: list[str]) -> DataFrame:
    """Stable sort by several paths, each ascending or descending; a missing text sorts as ''.

    Numbers keep their own order, with null before every value (as '' before every text).
    """
    keys = [c.desc_nulls_last() if descending else c.asc_nulls_first() for c, descending in specs]
    return df.orderBy(*keys, *tie)


def sku_base(registry: DataFrame, start: int) -> DataFrame:
    """One row: used count and the next number = max(stored next, highest numeric + 1)."""
    number = F.col("sku").try_cast("bigint")
    stored = F.max("next_auto_sku") if "next_auto_sku" in registry.columns else F.lit(None).cast("bigint")
    return registry.agg(
        F.count_distinct("sku").alias("used_count"),
        F.greatest(F.lit(start).cast("bigint"), stored, F.max(number) + 1).alias("next_auto_sku"),
    )


def allocate_skus(
    df: DataFrame, registry: DataFrame, order: list[str], start: int, parts: int | None = None
) -> DataFrame:
    """A new, unique, ascending text number per row; gaps in the registry are not refilled."""
    base = sku_base(registry, start).select("next_auto_sku").scalar()
    numbered = distributed_sequence(df, order, "__seq", parts)
    return numbered.withColumn("sku", (base + F.col("__seq")).cast("string")).drop("__seq")


def mark_used(registry: DataFrame, used: DataFrame) -> DataFrame:
    """Registry with more numbers in use; a stored next number stays on its rows."""
    more = used.select(F.col("sku").cast("string"))
    return registry.unionByName(more, allowMissingColumns=True).distinct()


def search_breaker(
    df: DataFrame, group: list[str], order: list[str], failed: Column, n: int, parts: int | None = None
) -> DataFrame:
    """disabled = the search path was already off when the row ran: n failures in a row came before, no reset after.

    failures counts rows since the last success; the first row where it reaches n switches the path off for good.
    """
    flagged = df.withColumn("__failed", failed)
    placed = running_values(
        flagged,
        group,
        order,
        [Running("__pos", F.lit(1).cast("bigint"))],
        parts,
    )
    ran = running_values(
        placed, group, order, [Running("__last_ok", F.when(~F.col("__failed"), F.col("__pos")), "max")], parts
    )
    ran = ran.withColumn("failures", F.col("__pos") - F.coalesce(F.col("__last_ok"), F.lit(0)))
    tripped = ran.filter(F.col("failures") >= n)
    if group:
        joined = ran.join(tripped.groupBy(*group).agg(F.min("__pos").alias("__trip")), group, "left")
    else:
        joined = ran.withColumn("__trip", tripped.agg(F.min("__pos")).scalar())
    return joined.withColumn(
        "disabled", F.coalesce(F.col("__pos") > F.col("__trip"), F.lit(False))
    ).drop("__failed", "__pos", "__last_ok", "__trip")


def log_context(
    log: DataFrame,
    file: list[str],
    line: list[str],
    product_marker: Column,
    color_marker: Column,
    used: Column,
    parts: int | None = None,
) -> DataFrame:
    """Carry the latest product and color markers down; a color is spent once a line uses it."""
    marker = F.when(color_marker.isNotNull(), F.struct(color_marker.alias("color"))).when(
        used, F.struct(F.lit(None).cast("string").alias("color"))
    )
    carried = running_values(
        log.withColumns({"__product": product_marker, "__marker": marker}),
        file,
        line,
        [
            Running("product", F.col("__product"), "last"),
            Running("__color", F.col("__marker"), "last", exclude_current=True),
        ],
        parts,
    )
    color = F.coalesce(color_marker, F.col("__color.color"))
    return carried.withColumn("color", color).drop("__product", "__marker", "__color")

