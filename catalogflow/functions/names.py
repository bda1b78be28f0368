"""Product names: normal form and the attributes hidden in them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed
from .values import strip


def singular(word: Column) -> Column:
    return (
        F.when(word.endswith("IES") & (F.length(word) > 3), F.concat(F.left(word, F.length(word) - 3), F.lit("Y")))
        .when(word.endswith("S") & ~word.endswith("SS"), F.left(word, F.length(word) - 1))
        .otherwise(word)
    )


def normalize_name(c: Column) -> Column:
    """Upper-case name without maker, quantity, size and filler words; first word in the singular."""
    out = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"(?U)\s+", " ")
    out = F.replace(F.regexp_replace(out, fixed.MAKER_WORDS, " "), F.lit("-"), F.lit(""))
    for pattern in (fixed.QUANTITY_WORDS, fixed.SIZE_WORDS, fixed.FILLER_WORDS, fixed.NAME_PUNCTUATION):
        out = F.regexp_replace(out, pattern, " ")
    out = F.upper(strip(F.regexp_replace(out, r"(?U)\s+", " ")))
    words = F.split(out, " ")
    return F.array_join(F.transform(words, lambda w, i: F.when(i == 0, singular(w)).otherwise(w)), " ")


def _canonical(text: Column, tokens: Column, table: dict[str, list[str]]) -> Column:
    hits = [
        F.when(
            text.contains(name) | F.arrays_overlap(tokens, F.array(*[F.lit(a) for a in aliases])), F.lit(name)
        )
        for name, aliases in table.items()
    ]
    return F.array_compact(F.array(*hits))


def flavors(c: Column) -> Column:
    text = F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[-_]", " ")
    return _canonical(text, F.split(text, "[^A-Za-z0-9]+"), fixed.FLAVORS)


def product_lines(c: Column) -> Column:
    raw = F.coalesce(c, F.lit(""))
    return _canonical(F.replace(F.upper(raw), F.lit("-"), F.lit("")), F.split(raw, r"(?U)\s+"), fixed.PRODUCT_LINES)


def forms(c: Column) -> Column:
    words = F.split(F.upper(F.coalesce(c, F.lit(""))), r"(?U)\s+")
    words = F.when(F.array_contains(words, "XBONE"), F.concat(words, F.array(F.lit("X-BONE")))).otherwise(words)
    return F.array_intersect(words, F.array(*[F.lit(f) for f in fixed.FORMS]))


def taxonomy(c: Column) -> Column:
    text = F.coalesce(c, F.lit(""))
    out = None
    for label, pattern in fixed.TAXONOMY_HINTS:
        out = F.when(text.rlike(pattern), label) if out is None else out.when(text.rlike(pattern), label)
    return out.otherwise("")
