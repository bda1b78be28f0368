"""Line-first cleaning: rules per line, failed lines go, and documents that lose too much text with them are rejected.

SQL functions only: nothing leaves the JVM, and as every document is judged by itself, nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .arrays import free_name

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOL = "[#*$%&|<>]"
WINDOW = 8


@dataclass(frozen=True)
class LineRules:
    """What makes a line fail, and how much a document may lose.

    ending: the last character of a line of prose (white space aside). marks: a run of these is a shout or decoration; a line fails
    with at least marks_percent of them per hundred words. separators: a line with two and at least separators_percent
    of them per hundred words is a menu. boilerplate: fails a line of up to boilerplate_words words. A document may lose
    max_lost_percent of the code points in its words.
    """

    ending: str = r"[.!?:;…。！？：；।؟۔)\]}'\"“”’«»」』]"
    marks: str = r"[!?#*$%&|<>=_~^+]{2,}"
    marks_percent: int = 30
    separators: str = "[|»›•·→]"
    separators_percent: int = 20
    boilerplate: str = (
        "all rights reserved|copyright|privacy policy|terms of (use|service)|cookie (policy|settings|notice)|accept (all )?cookies"
        "|enable javascript|click here|read more|sign (in|up) |log ?in |subscribe (to|now)|share (on|this)|powered by|back to top"
        "|skip to (main )?content|lorem ipsum"
    )
    boilerplate_words: int = 25
    max_lost_percent: int = 30


RULES = LineRules()


def let(value: Column, fn) -> Column:
    """fn of a value that is computed once however often fn names it, inside further functions as well."""
    return F.transform(F.array(value), fn)[0]


def repeated_words(words: Column) -> Column:
    """Words in windows of WINDOW words that stand twice or more in the list, the first ones included.

    Windows are named by 64-bit hashes of their words' hashes. Sorted by name, equal windows are neighbours; what the windows
    found cover is summed over their sorted places, so the work grows with n log n.
    """

    def windows(names: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(names) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(names, i + k) for k in range(WINDOW)]))

    def covered(places: Column) -> Column:
        own = F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def found(pairs: Column) -> Column:
        twice = F.filter(pairs, lambda p, k: (p["h"] == F.get(pairs, k - 1)["h"]) | (p["h"] == F.get(pairs, k + 1)["h"]))
        return let(F.sort_array(F.transform(twice, lambda p: p["i"])), covered)

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(let(pairs, found))

    each = F.transform(words, lambda word: F.xxhash64(word))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("bigint")).otherwise(let(each, lambda names: let(windows(names), count)))


def failed_rule(line: Column, rules: LineRules = RULES) -> Column:
    """The first rule that a line with words fails: punctuation, marks, navigation, boilerplate; null if none."""
    last = F.right(F.btrim(line, F.lit(SPACE)), F.lit(1))

    def judged(n: Column) -> Column:
        signs = F.regexp_count(line, F.lit(rules.separators))
        return (
            F.when(~last.rlike(rules.ending), "punctuation")
            .when(F.regexp_count(line, F.lit(rules.marks)) * 100 >= n * rules.marks_percent, "marks")
            .when((signs >= 2) & (signs * 100 >= n * rules.separators_percent), "navigation")
            .when((n <= rules.boilerplate_words) & F.lower(line).rlike(rules.boilerplate), "boilerplate")
        )

    return let(F.regexp_count(line, F.lit(WORD)), judged)


def clean(docs: DataFrame, text: str = "text", out: str = "quality", rules: LineRules = RULES, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """docs with a column `out`: counts, what the rules removed, the cleaned text, and whether the document is kept.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (longs); base_failed (under min_words words, or more than
    max_repeat_percent of them in repeated windows); lost_chars (code points of words in failed lines); removed (line number from 0 and
    rule of each failed line); cleaned (the text without them); kept. Null and empty texts have no words, fail the base
    and clean to an empty text. Lines end at newlines only. Rows are judged one by one: repeated ones get equal results,
    an empty table stays empty, other columns are left as they are (one called `out` is replaced).
    """
    whole = F.coalesce(F.col(text), F.lit(""))

    def chars(value: Column) -> Column:
        return F.length(F.regexp_replace(value, GAP, ""))

    lines = F.transform(
        F.split(whole, "\n"),
        lambda line, i: F.struct(
            i.alias("line"), line.alias("text"), F.when(line.rlike(WORD), failed_rule(line, rules)).alias("rule")
        ),
    )

    def cleaned(all_lines: Column) -> Column:
        bad = F.filter(all_lines, lambda s: s["rule"].isNotNull())
        good = F.filter(all_lines, lambda s: s["rule"].isNull())
        return F.struct(
            F.aggregate(bad, F.lit(0).cast("bigint"), lambda n, s: n + chars(s["text"])).alias("lost_chars"),
            F.transform(bad, lambda s: F.struct(s["line"].alias("line"), s["rule"].alias("rule"))).alias("removed"),
            F.array_join(F.transform(good, lambda s: s["text"]), "\n").alias("cleaned"),
        )

    def counted(words: Column) -> Column:
        return F.struct(F.size(words).cast("bigint").alias("n_words"), repeated_words(words).alias("n_repeat_words"))

    inked = F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD))
    base, line, result = (free_name(docs, c) for c in ("_base", "_lines", "_result"))
    found = docs.withColumns(
        {
            base: F.struct(
                let(F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)), counted).alias("words"),
                chars(whole).cast("bigint").alias("word_chars"),
                F.regexp_count(whole, F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
                let(inked, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            ),
            line: let(lines, cleaned),
        }
    )
    n, repeats = F.col(f"{base}.words.n_words"), F.col(f"{base}.words.n_repeat_words")
    found = found.withColumn(result, (n < min_words) | (repeats * 100 > n * max_repeat_percent))
    kept = ~F.col(result) & (F.col(f"{line}.lost_chars") * 100 <= F.col(f"{base}.word_chars") * rules.max_lost_percent)
    return found.withColumn(
        out,
        F.struct(
            n.alias("n_words"), F.col(f"{base}.word_chars"), F.col(f"{base}.n_symbols"), F.col(f"{base}.n_dup_lines"), repeats.alias("n_repeat_words"),
            F.col(result).alias("base_failed"), F.col(f"{line}.lost_chars"), F.col(f"{line}.removed"), F.col(f"{line}.cleaned"), kept.alias("kept"),
        ),
    ).drop(base, line, result)
