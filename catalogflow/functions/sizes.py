"""Sizes and weights in text."""

from __future__ import annotations

import json

from pyspark.sql import Column, functions as F

from . import fixed
from .values import let, strip

_NUMBER = r"\d+(?:\.\d+)?"


def _unit_map(table: dict[str, tuple[str, float]], position: int, value_type: str) -> Column:
    plain = {unit: pair[position] for unit, pair in table.items()}
    return F.from_json(F.lit(json.dumps(plain)), f"map<string,{value_type}>")


def extract_sizes(c: Column) -> Column:
    """Map of unit family to the distinct base-unit values named in a text."""
    text = F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), "[“”]", '"'))
    found = F.regexp_extract_all(text, F.lit(rf'(?<!\d)({_NUMBER}\s*(?:"|[A-Z]+\b))'), F.lit(1))
    family = _unit_map(fixed.SIZE_UNITS, 0, "string")
    factor = _unit_map(fixed.SIZE_UNITS, 1, "double")

    def measure(piece: Column) -> Column:
        unit = F.regexp_extract(piece, r'("|[A-Z]+)$', 1)
        number = F.regexp_extract(piece, rf"^({_NUMBER})", 1).cast("double")
        return F.struct(
            F.try_element_at(family, unit).alias("family"), (number * F.try_element_at(factor, unit)).alias("value")
        )

    measured = F.filter(F.transform(found, measure), lambda m: m["family"].isNotNull())

    def by_family(known: Column) -> Column:
        entries = F.transform(
            F.array_distinct(F.transform(known, lambda m: m["family"])),
            lambda name: F.struct(
                name.alias("key"),
                F.array_distinct(
                    F.transform(F.filter(known, lambda m: m["family"] == name), lambda m: m["value"])
                ).alias("value"),
            ),
        )
        return F.map_from_entries(entries)

    return let(measured, by_family)


def sizes_match(query: Column, product: Column, tolerance: float = fixed.SIZE_TOLERANCE) -> Column:
    """True unless a family named on both sides has no pair of values within the tolerance."""

    def agree(both: Column) -> Column:
        def family_agrees(name: Column) -> Column:
            return F.exists(
                F.try_element_at(both["p"], name),
                lambda p: (p != 0)
                & F.exists(F.try_element_at(both["q"], name), lambda q: F.abs(p - q) / F.nullif(p, F.lit(0.0)) <= tolerance),
            )

        shared = F.array_intersect(F.map_keys(both["p"]), F.map_keys(both["q"]))
        return F.forall(shared, family_agrees)

    return let(F.struct(query.alias("q"), product.alias("p")), agree)


def parse_weight(c: Column) -> Column:
    """struct(weight, unit, grams) of a size text; weight and unit null and grams 0 when it is no weight."""
    return let(F.upper(strip(c)), _weight_of)


def _weight_of(text: Column) -> Column:
    counted = rf"^({_NUMBER})\s*-\s*({_NUMBER})\s*([A-Z]+)"
    simple = rf"^({_NUMBER})\s*([A-Z]+)?$"

    def number(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).cast("double")

    is_counted = text.rlike(counted)
    total = F.when(is_counted, number(counted, 1) * number(counted, 2)).otherwise(number(simple, 1))
    word = F.when(is_counted, F.regexp_extract(text, counted, 3)).otherwise(F.regexp_extract(text, simple, 2))
    unit = F.try_element_at(_unit_map(fixed.WEIGHT_UNITS, 0, "string"), word)
    weight = total * F.try_element_at(_unit_map(fixed.WEIGHT_UNITS, 1, "double"), word)
    per_unit = F.from_json(F.lit(json.dumps(fixed.GRAMS_PER_UNIT)), "map<string,double>")
    grams = F.bround(weight * F.try_element_at(per_unit, unit), 0).cast("bigint")
    return F.struct(
        weight.alias("weight"),
        F.when(weight.isNotNull(), unit).alias("unit"),
        F.coalesce(grams, F.lit(0).cast("bigint")).alias("grams"),
    )


def product_weight(size: Column, lookup_size: Column, lookup_title: Column) -> Column:
    """First weight found in the size, the bracketed lookup size, or the lookup title."""
    pattern = rf"(?i)({_NUMBER})\s*[-\s]?\s*(lb|lbs|oz|kg|g|gallon|gal|liter|l)\b"
    from_title = F.concat(
        F.regexp_extract(lookup_title, pattern, 1), F.lit(" "), F.regexp_extract(lookup_title, pattern, 2)
    )
    bare = strip(F.regexp_replace(lookup_size, r"^[\[\]]+|[\[\]]+$", ""))
    tries = [parse_weight(size), parse_weight(bare), parse_weight(from_title)]
    none = F.struct(
        F.lit(None).cast("double").alias("weight"),
        F.lit(None).cast("string").alias("unit"),
        F.lit(0).cast("bigint").alias("grams"),
    )
    return F.coalesce(*[F.when(t["weight"].isNotNull(), t) for t in tries], none)


def portal_weight(c: Column) -> Column:
    """struct(value, unit) of the first 'number unit' in a text; 0 and '' when there is none."""
    pattern = rf"({_NUMBER})\s*(lb|lbs|kg|kgs|oz|g)"
    text = F.lower(F.coalesce(c, F.lit("")))
    number = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    return F.struct(
        F.coalesce(number.cast("double"), F.lit(0.0)).alias("value"),
        F.regexp_extract(text, pattern, 2).alias("unit"),
    )


def unit_weight(cube_weight: Column, unit_of_weight: Column, sale_unit: Column, pieces: Column, sq_ft: Column) -> Column:
    """struct(weight, grams, error): cube weight per sale unit. A zero factor is an error."""

    def usable(c: Column) -> Column:
        return F.coalesce(F.nanvl(c.cast("double"), F.lit(0.0)), F.lit(0.0))

    factor = (
        F.when(sale_unit == "Piece", usable(pieces)).when(sale_unit == "Kit", F.lit(1.0)).when(sale_unit == "Sq Ft", usable(sq_ft))
    )
    weight = F.when((factor != 0) & (cube_weight != 0), cube_weight / F.nullif(factor, F.lit(0.0)))
    grams = F.when(unit_of_weight == "lb", (weight * fixed.GRAMS_PER_UNIT["lb"]).cast("bigint"))
    return F.struct(
        F.coalesce(weight, F.lit(0.0)).alias("weight"),
        F.coalesce(grams, F.lit(0).cast("bigint")).alias("grams"),
        F.when(factor == 0, F.concat(sale_unit, F.lit(": conversion factor is zero or missing"))).alias("error"),
    )
