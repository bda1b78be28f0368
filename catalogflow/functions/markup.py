"""HTML for the store: cleaning, paragraphs, alt texts, JSON blocks."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from . import fixed
from .text import unescape_entities
from .values import let, strip

ELEMENTS = "(?is)" + "|".join(f"<{tag}[^>]*>.*?</{tag}>" for tag in fixed.DROPPED_ELEMENTS) + "|<img[^>]*>"
ATTRIBUTES = "|".join(rf'\s*{name}="[^"]*"' for name in fixed.DROPPED_ATTRIBUTES) + r'|\s*(?i:on[a-z]+)="[^"]*"'


def clean_html(c: Column, drop_empty: bool = True) -> Column:
    """Store-safe HTML: layout and scripts gone, presentational attributes gone, text kept."""
    out = F.regexp_replace(F.coalesce(c, F.lit("")), ELEMENTS, "")
    out = F.regexp_replace(out, "(?i)</?(?:div|span)[^>]*>", "")
    out = F.regexp_replace(out, ATTRIBUTES, "")
    out = F.regexp_replace(F.regexp_replace(out, r"(?U)\s+", " "), r"\s+>", ">")
    if drop_empty:
        out = F.regexp_replace(out, r"(?i)<([a-z]+)>\s*</\1>", "")
    return strip(out)


def body_html(c: Column, drop_empty: bool = True) -> Column:
    """Cleaned HTML with every bare part in a paragraph."""
    return let(clean_html(c, drop_empty), _paragraphs)


def _paragraphs(cleaned: Column) -> Column:
    has_paragraphs = cleaned.rlike("(?i)<p[^>]*>")
    parts = F.filter(F.transform(F.split(cleaned, r"(?i)<br\s*/?>"), strip), lambda p: p != "")

    def wrap(part: Column, always: bool) -> Column:
        wrapped = F.concat(F.lit("<p>"), part, F.lit("</p>"))
        return wrapped if always else F.when(part.startswith("<"), part).otherwise(wrapped)

    kept = F.array_join(F.transform(parts, lambda p: wrap(p, False)), "")
    joined = F.when(has_paragraphs, kept).otherwise(F.array_join(F.transform(parts, lambda p: wrap(p, True)), ""))
    bare = F.when(~has_paragraphs & (F.size(parts) == 0), F.concat(F.lit("<p>"), cleaned, F.lit("</p>"))).otherwise(joined)
    return F.when(cleaned == "", F.lit("")).otherwise(bare)


def specification_html(description: Column, specifications: Column) -> Column:
    """Description paragraph plus the specification lines as a list."""
    lines = F.filter(
        F.transform(F.split(F.coalesce(specifications, F.lit("")), "\n"), strip), lambda s: s != ""
    )
    items = F.array_join(F.transform(lines, lambda s: F.concat(F.lit("<li>"), s, F.lit("</li>"))), "")
    lead = F.when(
        F.coalesce(description, F.lit("")) != "", F.concat(F.lit("<p>"), description, F.lit("</p>"))
    ).otherwise(F.lit(""))
    block = F.when(F.size(lines) > 0, F.concat(F.lit("<h3>Specifications</h3><ul>"), items, F.lit("</ul>"))).otherwise(
        F.lit("")
    )
    return F.concat(lead, block)


def filter_alt(title: Column, *options: Column) -> Column:
    """'Title #OPTION#OPTION' with each option in capitals and '_' for blanks; unit words are left out."""
    tags = []
    for option in options:
        text = F.coalesce(option.cast("string"), F.lit(""))
        tag = F.concat(F.lit("#"), F.translate(F.upper(text), " -&", "___"))
        tags.append(F.when(~F.lower(text).isin(fixed.ALT_SKIPPED), tag))
    return strip(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.concat_ws("", *tags)))


def variant_alt(*options: Column) -> Column:
    """'#option#option' of the filled options, '' when none is filled."""
    filled = F.filter(F.array(*[o.cast("string") for o in options]), lambda o: F.coalesce(o, F.lit("")) != "")
    return F.when(F.size(filled) > 0, F.concat(F.lit("#"), F.array_join(filled, "#"))).otherwise(F.lit(""))


def lifestyle_alt(title: Column, kind: Column) -> Column:
    return F.concat(title, F.lit(" - "), kind)


def json_ld(c: Column, of_type: str | None = None) -> Column:
    """First JSON-LD block of a page that parses (and has the wanted @type), as JSON text."""
    blocks = F.regexp_extract_all(
        c, F.lit(r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1)
    )
    good = F.filter(F.transform(blocks, strip), lambda b: F.try_parse_json(b).isNotNull())
    if of_type is None:
        return F.get(good, F.lit(0))
    items = F.flatten(
        F.transform(
            good,
            lambda b: F.coalesce(
                F.when(b.startswith("["), F.from_json(b, "array<string>")),
                F.array(b),
            ),
        )
    )
    typed = F.filter(items, lambda b: F.get_json_object(b, "$['@type']") == of_type)
    return F.get(typed, F.lit(0))


def json_variable(c: Column, variable: str) -> Column:
    """JSON object assigned to a script variable, as JSON text; null when absent or broken."""
    pattern = rf"(?s)var\s+{re.escape(variable)}\s*=\s*(\{{.*?\}});"
    raw = F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
    text = F.replace(unescape_entities(raw), F.lit("http://"), F.lit("https://"))
    return F.when(F.try_parse_json(text).isNotNull(), text)
