"""Scored matching of rows to candidates.

Candidates arrive per row (search results), so a row meets only its own candidates; the best one is picked with a
partial aggregation. Only `nearest_title` compares two whole title lists, through an exact prefix filter.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import fixed
from ..functions.codes import upc_digits
from ..functions.names import flavors, forms, normalize_name, product_lines, taxonomy
from ..functions.sizes import extract_sizes, sizes_match
from ..functions.text import keyword_set, word_tokens
from ..functions.urls import strip_query
from ..functions.values import let, strip
from ..session import materialize, reusable
from .skew import skew_join


def keyword_score(candidate: Column, query: Column) -> Column:
    """Share of the query's words the candidate has; 0 without query words."""
    return F.size(F.array_intersect(candidate, query)) / F.greatest(F.size(query), F.lit(1))


def _best(url: Column, score: Column, pos: Column, when: Column) -> Column:
    """Best-scored candidate, earliest among equals."""
    rank = F.when(when, F.struct(score.alias("score"), (-pos).alias("neg_pos")))
    return F.max_by(F.struct(url.alias("url"), score.alias("score")), rank)


def match_keywords(
    inputs: DataFrame, candidates: DataFrame, threshold: float = fixed.KEYWORD_THRESHOLD, cap: int | None = None
) -> DataFrame:
    """Waterfall match: (input_id, url, tier, score); url '' and tier 0 where nothing matched.

    inputs: input_id, description, title. candidates: input_id, source, pos, name, url with source 'by_description',
    'by_title' (same site, searched by the second name) or 'second' (the other site). Tiers: 1 one name contains the
    other; 2 words shared with the description; 3 with the title; 4 second site. `cap` leaves out what stands behind
    that place of a search; by default every candidate counts.
    """
    description, title = strip(F.coalesce("description", F.lit(""))), strip(F.coalesce("title", F.lit("")))
    inputs = reusable(inputs)  # read again for rows without candidates
    queries = inputs.select(
        "input_id",
        F.lower(description).alias("q"),
        keyword_set(description).alias("q_words"),
        (title != description).alias("other_title"),
        keyword_set(title).alias("t_words"),
    )
    listed = candidates.filter(F.col("pos") <= cap) if cap else candidates
    met = skew_join(listed.select("input_id", "source", "pos", "name", "url"), queries, ["input_id"])
    by_description, by_title, second = [F.col("source") == s for s in ("by_description", "by_title", "second")]
    has_query = F.col("q") != ""
    asked = F.when(by_description & has_query, F.col("q_words")).when(by_title & F.col("other_title"), F.col("t_words")).when(
        second, F.when(has_query, F.col("q_words")).otherwise(F.col("t_words"))
    )  # the words its own search is scored by
    pairs = met.withColumns({"low": F.lower("name"), "words": keyword_set(F.col("name")), "asked": asked}).withColumn(
        "score", F.when(F.col("asked").isNotNull(), keyword_score(F.col("words"), F.col("asked")))
    )
    contained = by_description & has_query & (F.col("low").contains(F.col("q")) | F.col("q").contains(F.col("low")))
    url, pos, score = F.col("url"), F.col("pos"), F.col("score")
    enough = (score > 0) & (score >= threshold)
    best = pairs.groupBy("input_id").agg(
        F.min_by(F.struct(url.alias("url"), F.lit(1.0).alias("score")), F.when(contained, pos)).alias("t1"),
        *[_best(url, score, pos, when & enough).alias(f"t{i}") for i, when in ((2, by_description), (3, by_title), (4, second))],
    )
    found = F.coalesce("t1", "t2", "t3", "t4")
    number = F.coalesce(*[F.when(F.col(f"t{i}").isNotNull(), F.lit(i)) for i in (1, 2, 3, 4)], F.lit(0))
    return inputs.select("input_id").join(
        best.select("input_id", found["url"].alias("url"), number.alias("tier"), found["score"].alias("score")), "input_id", "left"
    ).select(
        "input_id",
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("tier", F.lit(0)).alias("tier"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def query_attributes(queries: DataFrame) -> DataFrame:
    """Attributes of the asked name, once per row. query_text is the name, query its normal form."""

    def own_or_alternate(attribute: Callable[[Column], Column]) -> Column:
        own = attribute(F.col("query_text"))
        return F.when(F.size(own) > 0, own).otherwise(attribute(F.col("alt_text")))

    return queries.withColumns(
        {
            "q_words": F.filter(F.split("query", " "), lambda w: w != ""),
            "q_taxonomy": taxonomy(F.col("query_text")),
            "q_flavors": own_or_alternate(flavors),
            "q_lines": own_or_alternate(product_lines),
            "q_forms": forms(F.col("query")),
            "q_sizes": extract_sizes(F.col("query_text")),
        }
    )


def title_attributes(candidates: DataFrame) -> DataFrame:
    """Attributes of a candidate page, once per candidate. Needs title, url, page_text, page_taxonomy."""
    named = candidates.withColumns({"title_norm": normalize_name(F.col("title")), "t_slug": F.upper(url_slug(F.col("url")))})
    return named.withColumns(
        {
            "t_words": F.filter(F.split("title_norm", " "), lambda w: w != ""),
            "t_taxonomy": F.lower(F.coalesce("page_taxonomy", F.lit(""))),
            "t_flavors": flavors(F.upper("page_text")),
            "t_lines": product_lines(F.col("title_norm")),
            "t_forms": forms(F.col("title_norm")),
            "t_sizes": extract_sizes(F.col("title")),
        }
    )


def attribute_score(pairs: DataFrame) -> DataFrame:
    """Score of each (query_attributes, title_attributes) pair that passes the gates and coverage tests.

    Gates come first and the coverage tests work on what they leave.
    """
    title = F.col("title")
    clash = ((F.col("q_taxonomy") == "cat") & (F.col("t_taxonomy").contains("dog") | title.rlike(r"(?i)\bdog\b"))) | (
        (F.col("q_taxonomy") == "dog") & (F.col("t_taxonomy").contains("cat") | title.rlike(r"(?i)\bcat\b"))
    )
    gate = (
        ~clash
        & ((F.size("q_flavors") == 0) | F.arrays_overlap("q_flavors", "t_flavors"))
        & ((F.size("q_lines") == 0) | F.arrays_overlap("q_lines", "t_lines"))
        & sizes_match(F.col("q_sizes"), F.col("t_sizes"))
    )
    reach = F.concat(F.col("t_words"), F.split("t_slug", "-"))
    counted = pairs.filter(gate).withColumn(
        "n_match", let(reach, lambda known: F.size(F.filter("q_words", lambda w: F.array_contains(known, w))))
    )
    matches = F.col("n_match")
    n_title = F.greatest(F.lit(1), F.size("t_words"))
    enough = (
        (matches >= 2)
        & (matches / n_title >= F.when(n_title <= 4, F.lit(0.75)).otherwise(F.lit(0.60)))
        & (matches / F.greatest(F.lit(1), F.size("q_words")) >= 0.50)
    )
    form_hits = F.size(F.array_intersect("q_forms", "t_forms"))
    form_part = F.when(F.size("q_forms") == 0, F.lit(0.0)).when(form_hits > 0, form_hits * 1.5).otherwise(F.lit(-0.8))
    slug_hits = F.size(F.filter("q_words", lambda w: F.col("t_slug").contains(w)))
    score = matches * 1.2 + form_part + F.when(slug_hits >= 2, F.lit(0.6)).otherwise(F.lit(0.0))
    return counted.filter(enough).withColumn("score", score)


def url_slug(c: Column) -> Column:
    """Last path part of an address."""
    path = F.regexp_replace(strip_query(c), r"^[a-zA-Z]+://[^/]*", "")
    return F.coalesce(F.element_at(F.split(F.regexp_replace(path, "^/+|/+$", ""), "/"), -1), F.lit(""))


def match_attributes(inputs: DataFrame, candidates: DataFrame, cap: int | None = None) -> DataFrame:
    """Best candidate per row by gated token score: (input_id, url, score). Rows without one are absent.

    inputs: input_id, name and, if there is one, alt_name, whose flavors and lines count where the name has none.
    candidates: input_id, pos, url, title, page_text, page_taxonomy. `cap` leaves out places behind it; none by default.
    """
    listed = candidates.filter(F.col("pos") <= cap) if cap else candidates
    alternate = F.col("alt_name") if "alt_name" in inputs.columns else F.lit("")
    queries = inputs.select(
        "input_id", F.col("name").alias("query_text"), normalize_name(F.col("name")).alias("query"), alternate.alias("alt_text")
    )
    scored = attribute_score(skew_join(title_attributes(listed), query_attributes(queries), ["input_id"]))
    best = scored.groupBy("input_id").agg(_best(F.col("url"), F.col("score"), F.col("pos"), F.lit(True)).alias("b"))
    return best.select("input_id", "b.url", "b.score")


STAGES = ("code", "description", "title")


def match_staged(inputs: DataFrame, candidates: DataFrame, cap: int | None = None) -> DataFrame:
    """Best candidate of the first stage that has one: input_id, stage, url, score. Rows without one are absent.

    inputs: input_id, upc, description, title. candidates: input_id, stage (code, description, title: the search that brought them), pos,
    url, title, page_text, page_taxonomy. The words asked for are the code's digits, the normalized description, or the
    normalized title; what a candidate may not contradict (animal, flavor, line, size, form) comes from the description, else
    from the title, in all stages. A single word never is enough, so a bare code finds nothing, as where the rules come
    from. Each candidate is scored once, for its own stage; later stages count for rows that earlier ones left open.
    """
    listed = candidates.filter(F.col("pos") <= cap) if cap else candidates
    asked = inputs.select("input_id", *[strip(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in ("upc", "description", "title")])
    told = F.when(F.col("description") != "", F.col("description")).otherwise(F.col("title"))
    named = asked.select("input_id", "upc", "description", "title", told.alias("query_text"), normalize_name(told).alias("query"), F.col("title").alias("alt_text"))
    attributes = query_attributes(named).withColumn("q_taxonomy", taxonomy(F.col("description")))

    def words(c: Column) -> Column:
        return F.filter(F.split(c, " "), lambda w: w != "")

    texts = {"code": upc_digits(F.col("upc")), "description": normalize_name(F.col("description")), "title": normalize_name(F.col("title"))}
    stages = F.explode(F.array(*[F.struct(F.lit(n).alias("stage"), F.lit(i).alias("stage_no"), words(texts[n]).alias("words")) for i, n in enumerate(STAGES)]))
    queries = attributes.withColumn("s", stages).filter(F.size("s.words") > 0)
    queries = queries.select(*[c for c in attributes.columns if c not in ("upc", "description", "title", "q_words")], "s.stage", "s.stage_no", F.col("s.words").alias("q_words"))
    scored = attribute_score(skew_join(title_attributes(listed), queries, ["input_id", "stage"]))
    best = scored.groupBy("input_id").agg(F.min_by(F.struct("stage", "url", "score"), F.struct("stage_no", -F.col("score"), "pos")).alias("b"))
    return best.select("input_id", "b.*")


def title_score(name: Column, query: Column) -> Column:
    """Shared tokens minus a tenth per extra name token."""
    words, asked = word_tokens(name), word_tokens(query)
    shared = F.size(F.array_intersect(words, asked))
    return F.when(F.coalesce(query, F.lit("")) == "", F.lit(0.0)).otherwise(shared - (F.size(words) - shared) * 0.1)


def rank_titles(inputs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Best tile per row by title score, first among equals: (input_id, url, score).

    inputs: input_id, query. candidates: input_id, pos, name, url.
    """
    pairs = skew_join(candidates, inputs.select("input_id", "query"), ["input_id"])
    scored = pairs.withColumn("score", title_score(F.col("name"), F.col("query")))
    best = scored.groupBy("input_id").agg(_best(F.col("url"), F.col("score"), F.col("pos"), F.lit(True)).alias("b"))
    return best.select("input_id", "b.url", "b.score")


def _style_text(c: Column) -> Column:
    out = F.replace(F.lower(strip(F.coalesce(c, F.lit("")))), F.lit("blackbear"), F.lit("black bear"))
    return F.regexp_replace(out, r"\bgrizzle\b", "grizzly")


def _reference_text(reference: Column) -> Column:
    ref = F.replace(F.lower(F.coalesce(reference, F.lit(""))), F.lit("×"), F.lit("x"))
    return F.regexp_replace(F.regexp_replace(ref, r"[^a-z0-9\s-]", " "), r"\s+", " ")


def style_score(text: str, words: str, ref: str, known: str) -> Column:
    """100 when the label stands in the reference, else shared words, plus 0.1 if any word is a substring of it.

    Names of columns: the label's text and words, the reference's text and words.
    """
    part = F.exists(words, lambda w: F.col(ref).contains(w))
    partial = F.size(F.array_intersect(words, known)) + F.when(part, F.lit(0.1)).otherwise(F.lit(0.0))
    return F.when(F.col(ref).contains(F.col(text)), F.lit(100.0)).otherwise(partial)


def match_style(references: DataFrame, labels: DataFrame, key: list[str]) -> DataFrame:
    """Best style label per row, first among equals: key.., label, score.

    references: key, reference and, if the row has some, tokens (words of its variant, counted like the reference's).
    labels: key, pos, label.
    """
    tokens = F.coalesce("tokens", F.array().cast("array<string>")) if "tokens" in references.columns else F.array().cast("array<string>")
    asked = references.select(*key, _reference_text(F.col("reference")).alias("__ref"), tokens.alias("__tokens"))
    known = asked.select(*key, "__ref", F.array_union(word_tokens(F.col("__ref")), "__tokens").alias("__known"))  # once per reference
    named = skew_join(labels.select(*key, "pos", "label"), known, key).withColumn("__text", _style_text(F.col("label")))
    scored = named.withColumn("__words", word_tokens(F.col("__text"))).withColumn("score", style_score("__text", "__words", "__ref", "__known"))
    best = scored.groupBy(*key).agg(_best(F.col("label"), F.col("score"), F.col("pos"), F.lit(True)).alias("b"))
    return best.select(*key, F.col("b.url").alias("label"), "b.score")


def match_option(chosen: DataFrame, options: DataFrame, key: list[str]) -> DataFrame:
    """Option of the chosen label: exact beats containment (80) beats shared words; first among equals.

    chosen: key, label. options: key, pos, option_id, option_label.
    """
    pairs = skew_join(options, chosen.select(*key, _style_text(F.col("label")).alias("__want")), key)
    low = F.lower("option_label")
    score = (
        F.when(low == F.col("__want"), F.lit(1000))
        .when(F.col("__want").contains(low) | low.contains(F.col("__want")), F.lit(80))
        .otherwise(F.size(F.array_intersect(word_tokens(low), word_tokens(F.col("__want")))))
    )
    best = pairs.groupBy(*key).agg(_best(F.col("option_id"), score, F.col("pos"), F.lit(True)).alias("b"))
    return best.select(*key, F.col("b.url").alias("option_id"))


def match_child(chosen: DataFrame, labels: DataFrame, key: list[str]) -> DataFrame:
    """Child of the chosen label: exact label first, else most shared words; first among equals.

    chosen: key, label, tokens. labels: key, child, child_pos, label (one row per child label).
    """
    asked = chosen.select(*key, F.lower("label").alias("__low"), F.array_union(word_tokens(F.col("label")), F.col("tokens")).alias("__want"))
    joined = skew_join(labels.select(*key, "child", "child_pos", F.col("label").alias("__have")), asked, key)
    hits = F.array_intersect(word_tokens(F.col("__have")), F.col("__want"))
    words = joined.select(*key, "child", "child_pos", (F.lower("__have") == F.col("__low")).cast("int").alias("exact"), F.explode_outer(hits).alias("w"))
    # a word shared by several labels of a child counts once
    once = words.groupBy(*key, "child", "w").agg(F.max("exact").alias("exact"), F.min("child_pos").alias("child_pos"))
    scored = once.groupBy(*key, "child").agg(F.max("exact").alias("exact"), F.min("child_pos").alias("child_pos"), F.count("w").alias("n"))
    score = F.when(F.col("exact") == 1, F.lit(1_000_000)).otherwise(F.col("n"))
    best = scored.groupBy(*key).agg(_best(F.col("child"), score, F.col("child_pos"), F.lit(True)).alias("b"))
    return best.select(*key, F.col("b.url").alias("child"))


@F.pandas_udf(T.DoubleType())
def sorted_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """200 * LCS / total length, the LCS by bit-parallel rows."""

    def lcs(x: str, y: str) -> int:
        places: dict[str, int] = {}
        for i, ch in enumerate(x):
            places[ch] = places.get(ch, 0) | (1 << i)
        full = (1 << len(x)) - 1
        row = full
        for ch in y:
            hit = row & places.get(ch, 0)
            row = ((row + hit) | (row - hit)) & full
        return len(x) - row.bit_count()

    return pd.Series([200.0 * lcs(x, y) / (len(x) + len(y)) if x or y else 100.0 for x, y in zip(a, b)])


# Common letters that take part in the global order of the key prefixes; all others count as rare. Any order is exact.
_ORDERED = 256
# Key combinations per row and pair of length bands; the widest combination within them is the most selective.
_COMBINATIONS = 70
_WIDEST = 4


def sorted_words(c: Column) -> Column:
    words = F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def _letters(text: Column) -> Column:
    """(letter, n-th use) of every letter of a text as one number, so that equal multisets have equal numbers."""

    def numbered(chars: Column) -> Column:
        return F.transform(
            chars,
            lambda x, i: F.ascii(x).cast("bigint") * (1 << 32) + F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda y: y == x)),
        )

    return let(F.filter(F.split(text, ""), lambda x: x != ""), numbered)


def _common_letters(*sides: DataFrame) -> list[int]:
    """The commonest letter numbers of the tables (columns letters), commonest first: _ORDERED at most."""
    every = sides[0].select(F.explode("letters").alias("letter"))
    for side in sides[1:]:
        every = every.unionByName(side.select(F.explode("letters").alias("letter")))
    counted = every.groupBy("letter").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "letter").limit(_ORDERED)
    return [row["letter"] for row in counted.collect()]


def _rare_first(letters: Column, common: list[int]) -> Column:
    order = F.expr(f"array({', '.join(f'{x}L' for x in common)})").cast("array<bigint>")
    ranked = F.transform(
        letters, lambda x: F.struct(F.when(F.array_contains(order, x), -F.array_position(order, x)).otherwise(-_ORDERED - 1).alias("rank"), x.alias("letter"))
    )
    return F.transform(F.array_sort(ranked), lambda t: t["letter"])


def _band_starts() -> list[int]:
    """Least lengths of the bands: single lengths at first, then about a tenth wide."""
    starts = list(range(13))
    while starts[-1] < 1 << 30:
        starts.append(max(starts[-1] + 1, int(starts[-1] * 1.1)))
    return starts


def _band(length: Column, starts: list[int]) -> Column:
    """Index of the band of a length."""
    steps, size = [], 1
    while size <= len(starts):
        steps.insert(0, size)
        size *= 2
    bounds = F.expr(f"array({', '.join(map(str, starts))})")
    place = F.aggregate(
        F.expr(f"array({', '.join(map(str, steps))})"), F.lit(0), lambda low, step: F.when((low + step <= len(starts)) & (F.get(bounds, low + step - 1) <= length), low + step).otherwise(low)
    )
    return place - 1


def _combinations(letters: str, width: str) -> str:
    """SQL of all combinations of `width` (1 .. _WIDEST) letters in order, as arrays."""
    found = f"transform({letters}, (x, i) -> named_struct('next', i + 1, 'key', array(x)))"
    cases = []
    for w in range(1, _WIDEST + 1):
        cases.append(f"WHEN {w} THEN transform({found}, c -> c.key)")
        more = f"transform(slice({letters}, c.next + 1, size({letters})), (y, j) -> named_struct('next', c.next + j + 1, 'key', concat(c.key, array(y))))"
        found = f"flatten(transform({found}, c -> {more}))"
    return f"CASE {width} {' '.join(cases)} END"


@functools.cache
def _band_pairs(ratio: float) -> pa.Table:
    """For two bands that may hold a pair: own band, other band, least and greatest length of the other, letters per key."""

    def shared(a: int, b: int) -> int:
        return math.ceil((a + b) * (ratio / 2) - 1e-9)

    starts = _band_starts()
    bands = [(a, b - 1) for a, b in zip(starts, starts[1:])]
    fits = [(width, max(x for x in range(64) if math.comb(x + width, width) <= _COMBINATIONS)) for width in range(_WIDEST, 1, -1)]
    out = []
    for own, (low, high) in enumerate(bands[1:], 1):
        for other, (first, last) in enumerate(bands[1:], 1):
            if first * ratio > high * (2 - ratio) + 1:
                break
            if shared(low, first) <= min(high, last):
                spare = max(high - shared(high, first), last - shared(last, low))
                width = next((w for w, most in fits if spare <= most and shared(low, first) >= w), 1)
                out.append((own, other, first, last, width))
    names = ["__own", "__other", "__first", "__last", "__width"]
    return pa.table([pa.array(c, pa.int32()) for c in zip(*out, strict=True)], names)


def _keyed(df: DataFrame, text: str, letters: str, ratio: float, is_query: bool) -> DataFrame:
    """text and every key under which a partner within the ratio can be met.

    A pair needs o = ratio / 2 * (len a + len b) letters in common. Then the rarest len a - o + l letters of a and the
    rarest len b - o + l of b share l of them, whichever l is taken. Partners are met by bands of their length, where o is
    known but for the band's width; so few letters are left over that several of them, l at once, can be the key.
    """
    n = F.size(letters)
    rows = df.filter(n > 0).select(F.col(text), F.col(letters).alias("__letters"), n.alias("__n"), _band(n, _band_starts()).alias("__own"))
    table = df.sparkSession.createDataFrame(_band_pairs(ratio))
    need = F.ceil((F.col("__n") + F.col("__first")) * (ratio / 2) - 1e-9).cast("int")
    met = rows.join(F.broadcast(table), "__own").withColumn("__need", need).filter(F.col("__need") <= F.least("__n", "__last"))  # a fixed table
    chosen = f"transform(array(slice(__letters, 1, __n - __need + __width)), p -> {_combinations('p', '__width')})[0]"
    bands = (F.col("__own"), F.col("__other")) if is_query else (F.col("__other"), F.col("__own"))
    return met.withColumn("__key", F.explode(F.expr(chosen))).select(text, F.xxhash64(*bands, "__key").alias("__key"))


def title_pairs(queries: DataFrame, titles: DataFrame, ratio: float) -> DataFrame:
    """Every (q, t) pair whose letters allow a ratio of at least `ratio`; no such pair is lost."""
    sides = [df.withColumn("letters", _letters(F.col(name))) for df, name in ((queries, "q"), (titles, "t"))]
    common = _common_letters(*sides)
    ready = [materialize(side.withColumn("letters", _rare_first(F.col("letters"), common))) for side in sides]
    return _letter_pairs(ready[0].withColumnRenamed("letters", "q_letters"), ready[1].withColumnRenamed("letters", "t_letters"), ratio).select(*queries.columns, *titles.columns)


def _candidates(queries: DataFrame, titles: DataFrame, ratio: float) -> DataFrame:
    """Pairs (q, t) that share a key, once each."""
    left, right = _keyed(queries, "q", "q_letters", ratio, True), _keyed(titles, "t", "t_letters", ratio, False)
    return left.join(right, "__key").select("q", "t").distinct()


def _letter_pairs(queries: DataFrame, titles: DataFrame, ratio: float) -> DataFrame:
    pairs = _candidates(queries, titles, ratio).join(queries, "q").join(titles, "t")
    needed = F.lit(ratio / 2) * (F.size("q_letters") + F.size("t_letters")) - F.lit(1e-9)
    return pairs.filter(F.size(F.array_intersect("q_letters", "t_letters")) >= needed)


def nearest_title(
    inputs: DataFrame, index: DataFrame, title: str, index_title: str, index_order: str, threshold: float = 60.0,
    ladder: tuple[float, ...] = (85.0, 72.0),
) -> DataFrame:
    """Best index title per distinct input title by token-sort ratio >= threshold; ties keep the earlier index row.

    Output: title, matched_title, score. Works on distinct word-sorted titles: equal ones first, then down a ladder
    of ratios; each rung sees only the titles still open, so the wide low rungs stay small. Every rung is exact.
    Pairs meet under several rare letters at once, by bands of their lengths.
    """
    names = inputs.select(F.col(title).alias("title")).filter(F.col("title").isNotNull()).distinct()
    keyed = materialize(names.withColumn("q", sorted_words(F.col("title"))))
    side = index.select(sorted_words(F.col(index_title)).alias("t"), F.col(index_title).alias("matched_title"), F.col(index_order).alias("__ord"))
    first = side.groupBy("t").agg(F.min_by("matched_title", "__ord").alias("matched_title"), F.min("__ord").alias("__ord"))
    titles = first.withColumn("letters", _letters(F.col("t")))
    queries = keyed.select("q").distinct().withColumn("letters", _letters(F.col("q")))
    common = _common_letters(queries, titles)
    titles = materialize(titles.withColumn("t_letters", _rare_first(F.col("letters"), common)).drop("letters"))
    queries = materialize(queries.withColumn("q_letters", _rare_first(F.col("letters"), common)).drop("letters"))
    done = queries.join(titles.select(F.col("t").alias("q"), "matched_title"), "q").select("q", "matched_title", F.lit(100.0).alias("score"))
    still = queries.join(titles.select(F.col("t").alias("q")), "q", "left_anti")
    for rung in [*[r for r in ladder if r > threshold], threshold]:
        if still.isEmpty():
            break
        scored = _letter_pairs(still, titles, rung / 100).withColumn("score", sorted_ratio("q", "t"))
        best = materialize(
            scored.filter(F.col("score") >= rung)
            .groupBy("q")
            .agg(F.max_by(F.struct("matched_title", "score"), F.struct("score", -F.col("__ord"))).alias("b"))
            .select("q", "b.matched_title", "b.score")
        )
        done = done.unionByName(best)
        still = still.join(best, "q", "left_anti")
    return keyed.join(done, "q").select("title", "matched_title", "score")
