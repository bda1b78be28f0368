"""Text expressions. All native; only full Unicode decomposition needs an Arrow function."""

from __future__ import annotations

import html.entities
import json
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from . import fixed
from .values import distinct_ignoring_case, let, strip

_BREAK = r"(?i)<\s*br\s*/?>"
_TAG = r"<[^>]+>"
_TEXTS = "array<string>"


def unescape_entities(c: Column) -> Column:
    """Named (HTML 4 set) and numeric entities in one left-to-right pass, so '&amp;lt;' gives '&lt;'."""
    names = {name: chr(code) for name, code in html.entities.name2codepoint.items()}
    names["apos"] = "'"
    table = F.from_json(F.lit(json.dumps(names)), "map<string,string>")

    def decode(part: Column) -> Column:
        name = F.regexp_extract(part, r"^(#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        rest = F.substring(part, F.length(name) + 2, F.length(part))
        hexa = F.when(name.rlike("^#[xX]"), F.substring(name, F.lit(3), F.length(name))).when(
            name.startswith("#"), F.hex(F.substring(name, F.lit(2), F.length(name)).cast("bigint"))
        )
        by_code = F.when(
            hexa.isNotNull(), F.decode(F.unhex(F.lpad(hexa, 8, "0")), "UTF-32")
        )
        value = F.coalesce(by_code, F.when(name != "", F.try_element_at(table, name)))
        return F.when(value.isNull(), F.concat(F.lit("&"), part)).otherwise(F.concat(value, rest))

    parts = F.split(c, "&")
    decoded = F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(decode(p)))
    return F.when(c.contains("&"), F.array_join(decoded, "")).otherwise(c)


def text_only(c: Column) -> Column:
    """Text of an HTML fragment: line breaks kept, tags dropped, entities resolved."""
    bare = F.regexp_replace(F.regexp_replace(c, _BREAK, "\n"), _TAG, "")
    return F.coalesce(strip(let(bare, unescape_entities)), F.lit(""))


def plain_text(c: Column) -> Column:
    out = F.regexp_replace(F.regexp_replace(c, _BREAK, "\n"), _TAG, " ")
    out = F.regexp_replace(out, r"[ \t\r\f\x0B]+", " ")
    out = F.regexp_replace(out, r"(?U)\s*\n\s*", "\n")
    return F.coalesce(strip(out), F.lit(""))


def squeeze_ws(c: Column) -> Column:
    return F.coalesce(strip(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def normalize_text(c: Column) -> Column:
    out = F.replace(c, F.lit('\\"'), F.lit('"'))
    out = F.replace(out, F.lit("©"), F.lit("(C)"))
    return strip(F.regexp_replace(out, r"(?U)\s+", " "))


def bullet_points(c: Column) -> Column:
    """Items of a description that reads like a list, else an empty array."""
    marked = strip(c)
    for mark in ("\r\n", "\r", "..", ";", "•", "·", "●"):
        marked = F.replace(marked, F.lit(mark), F.lit("\n"))
    marked = F.regexp_replace(marked, r"(?U)\n?\s*[–—-]\s+", "\n")
    parts = F.transform(F.split(marked, "\n"), lambda p: F.regexp_replace(p, "^[ .•\t]+|[ .•\t]+$", ""))
    parts = F.filter(parts, lambda p: p != "")

    def sentence_case(text: Column) -> Column:
        shouted = (F.length(text) > 2) & (text == F.upper(text)) & (text != F.lower(text))
        sentence = F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substring(text, F.lit(2), F.length(text))))
        return F.when(shouted, sentence).otherwise(text)

    def tidy(part: Column) -> Column:
        return let(strip(F.regexp_replace(strip(part), r"\.$", "")), sentence_case)

    def items(found: Column) -> Column:
        short = F.size(F.filter(found, lambda p: F.length(p) <= fixed.BULLET_MAX_CHARS))
        needed = F.greatest(F.lit(2), F.floor(F.size(found) * F.lit(0.6)))
        kept = let(F.filter(F.transform(found, tidy), lambda p: p != ""), distinct_ignoring_case)
        return F.when((F.size(found) >= 2) & (short >= needed), kept).otherwise(F.array().cast(_TEXTS))

    return let(parts, items)


def fix_description(c: Column) -> Column:

    def close(text: Column) -> Column:
        words = F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))
        return F.when(~text.endswith(".") & (words > 8), F.concat(text, F.lit("."))).otherwise(text)

    return F.coalesce(let(strip(F.regexp_replace(c, r"(?U)\s*\.\.\s*", ". ")), close), F.lit(""))


def _latin_folding() -> tuple[str, str, str]:
    """(letters, their base letters, marks to drop) for every Latin letter that decomposes to one base letter."""
    letters, bases = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        parts = [ch for ch in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(ch)]
        if len(parts) == 1 and parts[0] != chr(code):
            letters.append(chr(code))
            bases.append(parts[0])
    marks = "".join(chr(code) for code in range(0x300, 0x370) if unicodedata.combining(chr(code)))
    return "".join(letters), "".join(bases), marks


_LETTERS, _BASES, _MARKS = _latin_folding()


def drop_accents(c: Column) -> Column:
    """Latin letters without accents; for other scripts use `decompose` first."""
    return F.translate(F.replace(c, F.lit("\u00a0"), F.lit(" ")), _LETTERS + _MARKS, _BASES)


_ASCII = r"^[\x00-\x7F]*$"
_PLAIN_CASE = r"^[\x00-\xB4\xB6-\xFF]*$"  # letters whose full case fold is their lower case, but for the sharp s


def _bare(text: str) -> str:
    return "".join(ch for ch in text if not unicodedata.combining(ch))


@F.pandas_udf(T.StringType())
def decompose(texts: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks, for any script."""
    return texts.map(lambda t: None if t is None else _bare(unicodedata.normalize("NFKD", t)))


@F.pandas_udf(T.StringType())
def _folded_any(texts: pd.Series) -> pd.Series:
    """Compatibility decomposition, full case fold, no combining marks."""
    return texts.map(lambda t: None if t is None else _bare(unicodedata.normalize("NFKD", t).casefold()))


@F.pandas_udf(T.StringType())
def _casefold_any(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else t.casefold())


def _elsewhere(c: Column, simple: Column, udf) -> Column:
    """The udf's value for the texts that SQL functions cannot do; the others reach it as null."""
    return udf(F.when(~simple, c))


def casefold(c: Column) -> Column:
    """Full case fold of any script; texts of Latin letters stay in SQL functions."""
    simple = c.rlike(_PLAIN_CASE)
    return F.when(simple, F.lower(F.replace(c, F.lit("ß"), F.lit("ss")))).otherwise(_elsewhere(c, simple, _casefold_any))


def soft_key(c: Column) -> Column:
    """Decomposed, case-folded, without accents and punctuation, white space squeezed; any script.

    Latin letters with accents are done by SQL functions; only texts with other letters are sent to Python.
    """
    latin = drop_accents(c)
    simple = latin.rlike(_ASCII)
    bare = F.when(simple, F.lower(latin)).otherwise(_elsewhere(c, simple, _folded_any))
    out = F.regexp_replace(strip(bare), r"(?U)\s+", " ")
    return F.regexp_replace(out, r"(?U)[^\w\s.-]", "")


def canonical_key(c: Column, mode: str, mapping: dict[str, str] | None = None, group: int = 1) -> Column:
    """Grouping key of a value. Modes: exact, casefold, normalize, prefix:N, regex:PATTERN, map."""
    raw = c.cast("string")
    if mode == "casefold":
        out = casefold(raw)
    elif mode == "normalize":
        out = soft_key(raw)
    elif mode.startswith("prefix:"):
        size = mode.split(":", 1)[1]
        out = F.left(soft_key(raw), F.lit(int(size) if size.isdigit() else 4))
    elif mode.startswith("regex:"):
        out = F.regexp_extract(raw, mode.split(":", 1)[1], group)
    elif mode.startswith("map"):
        base = soft_key(raw)
        table = F.from_json(F.lit(json.dumps(mapping or {})), "map<string,string>")
        out = F.coalesce(F.try_element_at(table, raw), F.try_element_at(table, base), base)
    else:
        out = raw
    return F.coalesce(out, F.lit(""))


def slugify(c: Column, maxlen: int = 80) -> Column:
    """File-name form of a text. Where the beginning of a long text gives `maxlen` characters, what follows cannot change them."""

    def trimmed(part: Column) -> Column:
        latin = drop_accents(part)
        simple = latin.rlike(_ASCII)
        bare = F.when(simple, latin).otherwise(_elsewhere(part, simple, decompose))
        return F.regexp_replace(F.regexp_replace(bare, r"[^a-zA-Z0-9._-]+", "-"), r"^[-._]+|[-._]+$", "")

    head = trimmed(F.left(c, F.lit(4 * maxlen)))
    decided = F.length(head) >= maxlen
    out = F.left(F.when(decided, head).otherwise(trimmed(F.when(~decided, c))), F.lit(maxlen))
    return F.when(F.coalesce(out, F.lit("")) == "", F.lit("_")).otherwise(out)


def keyword_set(c: Column, stop: list[str] = fixed.KEYWORD_STOP, synonyms: dict[str, str] = fixed.KEYWORD_SYNONYMS) -> Column:
    """Distinct lower-case words without numbers, single letters and stop words; synonyms first."""
    words = F.filter(
        F.split(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\W+"),
        lambda w: (F.length(w) >= 2) & ~w.rlike(r"(?U)^\d+$"),
    )
    if synonyms:
        table = F.from_json(F.lit(json.dumps(synonyms)), "map<string,string>")
        words = F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w))
    return F.array_except(words, F.array(*[F.lit(s) for s in stop]).cast(_TEXTS))


def word_tokens(c: Column) -> Column:
    """Distinct runs of [a-z0-9] of the lower-cased text, in first-seen order."""
    return F.array_distinct(
        F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([a-z0-9]+)"), F.lit(1))
    )


def variant_tokens(*cols: Column) -> Column:
    """Tokens of the name fields plus the extra forms of known labels."""
    tokens = word_tokens(F.concat_ws(" ", *cols))
    out = tokens
    for words, label in fixed.LABEL_EXPANSIONS:
        extra = [*label.split(" "), label.replace(" ", "_"), label.replace(" ", "")]
        present = F.size(F.array_intersect(tokens, F.array(*[F.lit(w) for w in words]))) == len(words)
        out = F.array_union(
            out, F.when(present, F.array(*[F.lit(e) for e in extra])).otherwise(F.array().cast(_TEXTS))
        )
    return out


def split_list(c: Column) -> Column:
    typo, repaired = fixed.COLOR_LIST_TYPO
    items = F.split(F.replace(F.coalesce(c, F.lit("")), F.lit(typo), F.lit(repaired)), ",")
    return F.filter(F.transform(items, strip), lambda x: x != "")


def normalize_size(c: Column) -> Column:
    """Unit words in capitals, '50lb' as '50 LB', other words capitalized."""
    units = F.array(*[F.lit(u) for u in fixed.UPPERCASE_UNITS])

    def word_case(word: Column) -> Column:
        return F.when(F.array_contains(units, F.upper(word)), F.upper(word)).otherwise(
            F.concat(F.upper(F.left(word, F.lit(1))), F.lower(F.substring(word, F.lit(2), F.length(word))))
        )

    def fix(word: Column) -> Column:
        glued = word.rlike(r"(?i)^\d+[A-Z]+$")
        number = F.regexp_extract(word, r"^(\d+)", 1)
        unit = F.regexp_extract(word, r"^\d+(.*)$", 1)
        return (
            F.when(word.rlike(r"^\d+(\.\d+)?$"), word)
            .when(glued, F.concat(number, F.lit(" "), word_case(unit)))
            .otherwise(word_case(word))
        )

    words = F.filter(F.split(strip(F.coalesce(c, F.lit(""))), r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, fix), " ")


def query_variants(c: Column, cap: int = fixed.QUERY_VARIANT_CAP) -> Column:
    """Spelling variants of a search text: the original first, then by length, case-blind distinct."""
    return let(strip(F.coalesce(c, F.lit(""))), lambda base: _spellings(base, cap))


def _spellings(base: Column, cap: int) -> Column:
    none = F.array().cast(_TEXTS)
    found = F.array(base)
    for pattern in fixed.TWO_IN_ONE_PATTERNS:
        forms = F.array(*[F.regexp_replace(base, pattern, form) for form in fixed.TWO_IN_ONE_FORMS])
        found = F.concat(found, F.when(base.rlike(pattern), forms).otherwise(none))

    def extended(arr: Column, forms: Callable[[Column], Column]) -> Column:
        return let(arr, lambda known: F.array_distinct(F.concat(known, F.flatten(F.transform(known, lambda t: forms(t))))))

    def inch_forms(t: Column) -> Column:
        spaced = F.regexp_replace(t, r'(\d+)"', r"$1 in")
        glued = F.replace(F.regexp_replace(t, r'(\d+)"', r"$1in"), F.lit('"'), F.lit(""))
        return F.when(base.contains('"'), F.array(spaced, glued)).otherwise(none)

    found = extended(found, inch_forms)

    def pair_forms(t: Column) -> Column:
        a, b = F.regexp_extract(t, fixed.SIZE_PAIR, 1), F.regexp_extract(t, fixed.SIZE_PAIR, 2)
        forms = [F.regexp_replace(t, F.lit(fixed.SIZE_PAIR), F.concat(a, F.lit(sep), b)) for sep in ("x", " x ", "×", "/")]
        return F.when(t.rlike(fixed.SIZE_PAIR), F.array(*forms)).otherwise(none)

    found = extended(found, pair_forms)
    found = extended(found, lambda t: F.array(F.replace(t, F.lit("-"), F.lit(" "))))
    found = extended(found, lambda t: F.array(F.regexp_replace(t, r"(?i)\bgrizzle\b", "grizzly")))
    found = let(F.filter(F.transform(found, squeeze_ws), lambda t: t != ""), distinct_ignoring_case)
    ranked = F.array_sort(
        F.transform(
            found,
            lambda t: F.struct(
                F.when(F.lower(t) == F.lower(base), 0).otherwise(1).alias("other"),
                F.length(t).alias("size"),
                t.alias("text"),
            ),
        )
    )
    return F.slice(F.transform(ranked, lambda r: r["text"]), 1, cap)
