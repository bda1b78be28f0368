"""Product codes: digits, padding, validity, key candidates, prices, dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def upc_digits(c: Column) -> Column:
    return F.coalesce(F.regexp_replace(c.cast("string"), r"[^0-9]", ""), F.lit(""))


def valid_upc(c: Column) -> Column:
    return F.length(upc_digits(c)).isin(12, 13)


def upc_12_to_13(c: Column) -> Column:
    digits = upc_digits(c)
    return F.when(F.length(digits) == 12, F.concat(F.lit("0"), digits)).otherwise(digits)


def upc_13_to_12(c: Column) -> Column:
    digits = upc_digits(c)
    return F.when((F.length(digits) == 13) & digits.startswith("0"), F.substring(digits, 2, 12)).otherwise(digits)


def _drop_ean_zero(code: Column) -> Column:
    return F.when((F.length(code) == 13) & code.startswith("0"), F.substring(code, 2, 12)).otherwise(code)


def extract_upcs(c: Column) -> Column:
    """Sorted distinct 12-digit codes among the 12/13-digit words of a text."""
    words = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?U)\b(\d{12,13})\b"), F.lit(1))
    codes = F.filter(F.transform(words, _drop_ean_zero), lambda x: F.length(x) == 12)
    return F.array_sort(F.array_distinct(codes))


def pad_left(c: Column, width: int) -> Column:
    """Zero-pad without cutting longer codes (lpad alone would)."""
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def table_upc(c: Column) -> Column:
    """A spreadsheet UPC cell as text: digits padded to 12; blank, 'nan' and 'none' become null."""
    text = F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", "")
    digits = upc_digits(text)
    usable = ~F.lower(text).isin("", "nan", "none") & (digits != "")
    return F.when(usable, pad_left(digits, 12))


def upc_candidates(c: Column) -> Column:
    """Key forms to try in order: the raw text, then padded or cut to 12, 13, 14, then the same without zeros."""
    digits = upc_digits(c)
    stripped = F.regexp_replace(digits, "^0+", "")

    def sized(code: Column, width: int) -> Column:
        return F.when(F.length(code) < width, F.lpad(code, width, "0")).otherwise(F.substring(code, -width, width))

    forms = [sized(digits, w) for w in (12, 13, 14)]
    bare = [stripped] + [sized(stripped, w) for w in (12, 13, 14)]
    derived = F.when(digits == "", F.array().cast("array<string>")).otherwise(
        F.concat(
            F.array(*forms),
            F.when(stripped != "", F.array(*bare)).otherwise(F.array().cast("array<string>")),
            F.array(digits),
        )
    )
    tried = F.concat(F.array(F.coalesce(c.cast("string"), F.lit(""))), derived)
    return F.array_distinct(F.filter(tried, lambda x: x != ""))


def effective_upc(*cols: Column) -> Column:
    """Digits of the first non-blank code column."""
    texts = [c.cast("string") for c in cols]
    return upc_digits(F.coalesce(*[F.when(F.trim(t) != "", t) for t in texts], F.lit("")))


def parse_price(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"[$,]", "").try_cast("decimal(12,2)")


def portal_price(attribute: Column, text: Column) -> Column:
    """'$12.34' from the numeric attribute when it parses, else from the text; '' when neither does."""
    rate = attribute.try_cast("double")
    found = F.regexp_extract(F.coalesce(text, F.lit("")), r"\$\s*(\d+(?:\.\d{2})?)", 1)
    return F.when(rate.isNotNull(), F.format_string("$%.2f", rate)).otherwise(
        F.when(found != "", F.concat(F.lit("$"), found)).otherwise(F.lit(""))
    )


# Accepted date shapes (guard pattern, Spark format, two-digit year).
DATE_SHAPES = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d", False),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d'T'H:m:s", False),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d H:m:s", False),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy", False),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy", True),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy", False),
    (r"^\d{1,2}-\d{1,2}-\d{2}$", "M-d-yy", True),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d", False),
    (r"^\d{4}\.\d{1,2}\.\d{1,2}$", "yyyy.M.d", False),
]


def to_date_value(c: Column) -> Column:
    """Timestamp of a date-like text, null otherwise; bare digits are never dates."""
    text = F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    tries = []
    for pattern, fmt, short_year in DATE_SHAPES:
        shown = F.substring(text, 1, 19) if fmt.startswith("yyyy-") else text
        value = F.when(shown.rlike(pattern), F.try_to_timestamp(shown, F.lit(fmt)))
        if short_year:
            # two-digit years 69-99 belong to the last century
            value = F.when(F.year(value) >= 2069, value - F.expr("INTERVAL 100 YEARS")).otherwise(value)
        tries.append(value)
    return F.coalesce(*tries)


def is_date(c: Column) -> Column:
    return to_date_value(F.coalesce(c, F.lit(""))).isNotNull()


def coerce_text(c: Column) -> Column:
    """Date-like text in one timestamp form, other text unchanged."""
    value = to_date_value(c)
    return F.when(value.isNotNull(), F.date_format(value, "yyyy-MM-dd HH:mm:ss")).otherwise(c)
