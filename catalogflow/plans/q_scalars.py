"""Text, code, address and size functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import fixed
from ..functions import markup as H
from ..functions import names as N
from ..functions import sizes as Z
from ..functions import text as X
from ..functions import urls as U
from ..functions.nested import map_all_strings
from .registry import big, query, text

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def re(value: str, pattern: str, new: str = "") -> str:
    """DuckDB replacement of every match."""
    quoted = pattern.replace("'", "''")
    return f"regexp_replace({value}, '{quoted}', {new or chr(39) * 2}, 'g')"


def strip(value: str) -> str:
    return f"trim({value}, {WS})"


@query("H1_upc_digits", "SELECT o_orderkey, regexp_replace(o_totalprice || '-' || o_orderkey, '[^0-9]', '', 'g') AS digits FROM orders")
def h1(t):
    return t.orders.select("o_orderkey", C.upc_digits(F.concat_ws("-", text("o_totalprice"), text("o_orderkey"))).alias("digits"))


@query(
    "H2_upc_12_13",
    """WITH c AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN lpad(CAST(o_orderkey AS VARCHAR), 12, '0') WHEN o_orderstatus = 'O' THEN lpad(CAST(o_orderkey AS VARCHAR), 13, '0')
      ELSE '1' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') END AS c FROM orders)
    SELECT o_orderkey, CASE WHEN length(c) = 12 THEN '0' || c ELSE c END AS ean, CASE WHEN length(c) = 13 AND c LIKE '0%' THEN substr(c, 2) ELSE c END AS upc FROM c""",
)
def h2(t):
    key, status = text("o_orderkey"), F.col("o_orderstatus")
    code = F.when(status == "F", F.lpad(key, 12, "0")).when(status == "O", F.lpad(key, 13, "0")).otherwise(F.concat(F.lit("1"), F.lpad(key, 12, "0")))
    return t.orders.select("o_orderkey", C.upc_12_to_13(code).alias("ean"), C.upc_13_to_12(code).alias("upc"))


@query(
    "H3_extract_upcs",
    """WITH k AS (SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS a, lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS b FROM orders)
    SELECT o_orderkey, CASE WHEN a = b THEN a ELSE least(a, b) || ',' || greatest(a, b) END AS upcs FROM k""",
)
def h3(t):
    own, other = F.lpad(text("o_orderkey"), 12, "0"), F.lpad(text("o_custkey"), 12, "0")
    shown = F.concat(F.lit("UPC "), own, F.lit(" and 0"), other, F.lit(", not 9"), own, F.lit(" nor x"), own, F.lit(";"), own)
    return t.orders.select("o_orderkey", F.array_join(C.extract_upcs(shown), ",").alias("upcs"))


_TEXT_ONLY = strip(
    "replace(replace(replace(replace(" + re(re("html", r"(?i)<\s*br\s*/?>", "chr(10)"), "<[^>]+>")
    + ", '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')"
)


@query("H4_text_only", f"SELECT page_id, {_TEXT_ONLY} AS text FROM pages")
def h4(t):
    return t.pages.select("page_id", X.text_only(F.col("html")).alias("text"))


_PLAIN = strip(re(re(re(re("html", r"(?i)<\s*br\s*/?>", "chr(10)"), "<[^>]+>", "' '"), r"[ \t\r\f\v]+", "' '"), r"\s*\n\s*", "chr(10)"))


@query("H5_plain_text", f"SELECT page_id, {_PLAIN} AS text FROM pages")
def h5(t):
    return t.pages.select("page_id", X.plain_text(F.col("html")).alias("text"))


@query("H6_squeeze_ws", f"SELECT doc_id, {strip(re('text', r'[ \t\n\r\f\v]+', chr(39) + ' ' + chr(39)))} AS text FROM documents")
def h6(t):
    return t.documents.select("doc_id", X.squeeze_ws(F.col("text")).alias("text"))


@query(
    "H7_normalize_text",
    f"""SELECT conv_id, turn, {strip(re("replace(text || ' © ' || role, '©', '(C)')", r"[ \t\n\r\f\v]+", "' '"))} AS text, '"' || role || '"' AS role FROM conversations""",
)
def h7(t):
    nested = t.conversations.select(
        "conv_id", "turn", F.struct(F.array(F.concat("text", F.lit(" © "), "role")).alias("parts"), F.concat(F.lit('\\"'), "role", F.lit('\\"  ')).alias("role")).alias("body")
    )
    out = map_all_strings(nested, X.normalize_text)
    return out.select("conv_id", "turn", F.get("body.parts", F.lit(0)).alias("text"), F.col("body.role").alias("role"))


_BULLET = re(
    "replace(replace(replace(replace(replace(replace(replace(" + strip("text")
    + ", chr(13) || chr(10), chr(10)), chr(13), chr(10)), '..', chr(10)), ';', chr(10)), '•', chr(10)), '·', chr(10)), '●', chr(10))",
    r"\n?\s*[–—-]\s+", "chr(10)",
)


@query(
    "H8_bullet_points",
    f"""WITH m AS (SELECT doc_id, list_filter(list_transform(string_split({_BULLET}, chr(10)), lambda p: trim(p, ' .•' || chr(9))), lambda p: p <> '') AS parts FROM documents),
    k AS (SELECT *, len(parts) >= 2 AND len(list_filter(parts, lambda p: length(p) <= 140)) >= greatest(2, floor(len(parts) * 0.6)) AS listed,
      list_filter(list_transform(list_transform(list_transform(parts, lambda p: {strip('p')}), lambda p: CASE WHEN p LIKE '%.' THEN {strip('p[:-2]')} ELSE p END),
        lambda p: CASE WHEN length(p) > 2 AND p = upper(p) AND p <> lower(p) THEN upper(p[1]) || lower(p[2:]) ELSE p END), lambda p: p <> '') AS items FROM m)
    SELECT doc_id, CASE WHEN listed THEN array_to_string(list_filter(items, lambda p, i: list_position(list_transform(items, lambda y: lower(y)), lower(p)) = i), '|') ELSE '' END AS bullets FROM k""",
)
def h8(t):
    return t.documents.select("doc_id", F.array_join(X.bullet_points(F.col("text")), "|").alias("bullets"))


_FIXED = strip(re("text", r"[ \t\n\r\f\v]*\.\.[ \t\n\r\f\v]*", "'. '"))


@query(
    "H9_fix_description",
    f"""WITH d AS (SELECT doc_id, {_FIXED} AS d FROM documents)
    SELECT doc_id, CASE WHEN d NOT LIKE '%.' AND len(list_filter(string_split_regex(d, '\\s+'), lambda w: w <> '')) > 8 THEN d || '.' ELSE d END AS text FROM d""",
)
def h9(t):
    return t.documents.select("doc_id", X.fix_description(F.col("text")).alias("text"))


@query(
    "H10_sizes",
    """SELECT p_partkey, CAST(p_size AS DOUBLE) AS inches, p_size * 16.0::DOUBLE AS ounces, abs((p_partkey % 50 + 1) - p_size) / (p_partkey % 50 + 1) <= 0.08 AS agree FROM part""",
)
def h10(t):
    own = F.concat(F.lit("Bone "), text("p_size"), F.lit("in x "), text("p_size"), F.lit("lb or 3 pk"))
    other = F.concat(F.lit("Bone "), (F.col("p_partkey") % 50 + 1).cast("string"), F.lit("\" long"))
    found = Z.extract_sizes(own)
    return t.part.select(
        "p_partkey", F.get(found["IN"], F.lit(0)).alias("inches"), F.get(found["OZ"], F.lit(0)).alias("ounces"),
        Z.sizes_match(found, Z.extract_sizes(other)).alias("agree"),
    )


@query(
    "H11_parse_weight",
    """WITH s AS (SELECT p_partkey, p_size * CASE WHEN p_size > 40 THEN 3 ELSE 1 END AS n, CASE WHEN p_size > 40 THEN 'OZ' ELSE p_type END AS u FROM part),
    w AS (SELECT p_partkey, n * CASE u WHEN 'STANDARD' THEN 7.5 WHEN 'LARGE' THEN 0.75 ELSE 1.0 END::DOUBLE AS w,
      CASE u WHEN 'ECONOMY' THEN 'lb' WHEN 'SMALL' THEN 'oz' WHEN 'OZ' THEN 'oz' WHEN 'MEDIUM' THEN 'kg' WHEN 'STANDARD' THEN 'lb' WHEN 'LARGE' THEN 'g' END AS unit FROM s)
    SELECT p_partkey, CASE WHEN unit IS NOT NULL THEN w END AS weight, unit,
      coalesce(CAST(round_even(w * CASE unit WHEN 'lb' THEN 453.592 WHEN 'oz' THEN 28.3495 WHEN 'kg' THEN 1000.0 WHEN 'g' THEN 1.0 END::DOUBLE, 0) AS BIGINT), 0) AS grams FROM w""",
)
def h11(t):
    kind = F.col("p_type")
    word = (
        F.when(kind == "ECONOMY", " LB").when(kind == "SMALL", "oz").when(kind == "MEDIUM", " kilograms").when(kind == "STANDARD", " gallon")
        .when(kind == "LARGE", "ML").otherwise(" EACH")
    )
    size = F.when(F.col("p_size") > 40, F.concat(F.lit("3 - "), text("p_size"), F.lit(" OZ PACKETS"))).otherwise(F.concat(text("p_size"), word))
    parsed = t.part.select("p_partkey", Z.product_weight(size, F.lit("[x]"), F.lit(None).cast("string")).alias("w"))
    return parsed.select("p_partkey", "w.weight", "w.unit", "w.grams")


@query(
    "H11b_unit_weight",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 1 THEN 0.0 ELSE (l_quantity + 0.5) / (l_linenumber - 1) END AS weight,
    CASE WHEN l_linenumber = 1 THEN 0 ELSE CAST(trunc((l_quantity + 0.5) / (l_linenumber - 1) * 453.592::DOUBLE) AS BIGINT) END AS grams, l_linenumber = 1 AS bad FROM lineitem""",
)
def h11b(t):
    cube = Z.portal_weight(F.concat(F.lit("Approx. "), (F.col("l_quantity") + 0.5).cast("string"), F.lit(" LB each")))
    w = Z.unit_weight(cube["value"], cube["unit"], F.lit("Piece"), F.col("l_linenumber") - 1, F.lit(None).cast("double"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", w.alias("w"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "w.weight", "w.grams", F.col("w.error").isNotNull().alias("bad"))


_SOFT = re(strip(re("strip_accents(lower(replace(text, 'ß', 'ss')))", r"[ \t\n\r\f\v]+", "' '")), r"[^\w\s.-]")


@query(
    "H12_canonical_key",
    f"""SELECT doc_id, md5({_SOFT}) AS normal, left({_SOFT}, 6) AS prefix, lower(replace(text, 'ß', 'ss')) = lower(text) AS folded,
    regexp_extract(source, '([0-9]+)', 1) AS number, CASE WHEN source = 'src1' THEN 'first' ELSE source END AS mapped FROM documents""",
)
def h12(t):
    body = F.col("text")
    return t.documents.select(
        "doc_id", F.md5(X.canonical_key(body, "normalize")).alias("normal"), X.canonical_key(body, "prefix:6").alias("prefix"),
        (X.canonical_key(body, "casefold") == F.lower(body)).alias("folded"), X.canonical_key(F.col("source"), "regex:([0-9]+)").alias("number"),
        X.canonical_key(F.upper("source"), "map", {"src1": "first"}).alias("mapped"),
    )


@query(
    "H12_canonical_key_any_script",
    f"SELECT doc_id, md5({_SOFT}) AS normal FROM documents",
)
def h12_any(t):
    return t.documents.select("doc_id", F.md5(X.soft_key(F.col("text"))).alias("normal"))


_WIDE = "translate(upper(p_name), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ')"


@query(
    "H12_canonical_key_scripts",
    f"""SELECT p_partkey, p_name AS wide, translate(p_name, 'aeiou', 'αειου') AS greek, translate(p_name, 'aei', 'иеі') AS cyrillic, replace(p_name, 'e', 'fi') AS ligature,
      replace(p_name, 'o', chr(4370) || chr(4449) || chr(4523)) AS hangul, translate(p_name, 'aeiou', 'άέίόύ') AS folded,
      translate(lower({_WIDE}), 'ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ', 'ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ') AS wide_folded, left(p_name, 3) AS prefix,
      CASE WHEN p_name = 'hot ring' THEN 'first' ELSE p_name END AS mapped FROM part""",
)
def h12_scripts(t):
    """Full-width, Greek, Cyrillic, ligature and Hangul spellings of the names, in every mode that folds."""
    name = F.col("p_name")
    wide = F.translate(F.upper(name), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ")
    greek = F.translate(name, "aeiou", "ΆΈΊΌΎ")
    return t.part.select(
        "p_partkey", X.canonical_key(wide, "normalize").alias("wide"), X.canonical_key(greek, "normalize").alias("greek"),
        X.canonical_key(F.translate(name, "aei", "ЙЁЇ"), "normalize").alias("cyrillic"),
        X.canonical_key(F.replace(name, F.lit("e"), F.lit("ﬁ")), "normalize").alias("ligature"),
        X.canonical_key(F.replace(name, F.lit("o"), F.lit("한")), "normalize").alias("hangul"),
        X.canonical_key(greek, "casefold").alias("folded"), X.canonical_key(wide, "casefold").alias("wide_folded"),
        X.canonical_key(wide, "prefix:3").alias("prefix"), X.canonical_key(wide, "map", {"hot ring": "first"}).alias("mapped"),
    )


@query(
    "H13_slugify",
    f"""SELECT doc_id, coalesce(nullif(left({re(re("strip_accents(text)", "[^a-zA-Z0-9._-]+", "'-'"), "^[-._]+|[-._]+$")}, 80), ''), '_') AS slug FROM documents""",
)
def h13(t):
    return t.documents.select("doc_id", X.slugify(F.col("text")).alias("slug"))


_STOP = "[" + ", ".join(f"'{w}'" for w in fixed.KEYWORD_STOP) + "]"


@query(
    "H14_keyword_set",
    f"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}_]+'),
      lambda w: length(w) >= 2 AND NOT regexp_full_match(w, '[0-9]+')), lambda w: CASE w WHEN 'equine' THEN 'horse' WHEN 'hen' THEN 'poultry' WHEN 'chicken' THEN 'poultry' ELSE w END),
      lambda w: NOT list_contains({_STOP}, w)))), ' ') AS words FROM documents""",
)
def h14(t):
    return t.documents.select("doc_id", F.array_join(F.array_sort(X.keyword_set(F.col("text"))), " ").alias("words"))


_NAME = "replace(" + re(strip(re("n", r"\s+", "' '")), fixed.MAKER_WORDS, "' '") + ", '-', '')"
for _pattern in (fixed.QUANTITY_WORDS, fixed.SIZE_WORDS, fixed.FILLER_WORDS, fixed.NAME_PUNCTUATION):
    _NAME = re(_NAME, _pattern, "' '")
_NAME = f"upper({strip(re(_NAME, r'\s+', chr(39) + ' ' + chr(39)))})"


@query(
    "H15_normalize_name",
    f"""WITH n AS (SELECT p_partkey, 'Spot ' || CASE WHEN p_size > 25 THEN 'Puppies' ELSE 'Toys' END || ' for the ' || p_name || ', ' || p_size || ' ct (' || p_type || ') 3 OZ X-Bone' AS n FROM part),
    u AS (SELECT p_partkey, string_split({_NAME}, ' ') AS w FROM n)
    SELECT p_partkey, CASE WHEN w[1] LIKE '%IES' THEN w[1][:-4] || 'Y' WHEN w[1] LIKE '%S' AND w[1] NOT LIKE '%SS' THEN w[1][:-2] ELSE w[1] END || ' ' || array_to_string(w[2:], ' ') AS name FROM u""",
)
def h15(t):
    lead = F.when(F.col("p_size") > 25, "Puppies").otherwise("Toys")
    name = F.concat(F.lit("Spot "), lead, F.lit(" for the "), "p_name", F.lit(", "), text("p_size"), F.lit(" ct ("), "p_type", F.lit(") 3 OZ X-Bone"))
    return t.part.select("p_partkey", N.normalize_name(name).alias("name"))


@query(
    "H16_attributes",
    """WITH n AS (SELECT p_partkey, CASE WHEN p_size < 10 THEN 'PB & bacon ' WHEN p_size < 20 THEN 'Play-Strong FOAMZ ' WHEN p_size < 30 THEN 'Bam-Bone kitten ' WHEN p_size < 40 THEN 'Apple dog BOWL ' ELSE '' END || upper(p_name) AS n, p_size, p_name FROM part)
    SELECT p_partkey, CASE WHEN p_size < 10 THEN 'PEANUT BUTTER,BACON' WHEN p_size < 20 THEN '' WHEN p_size < 30 THEN '' WHEN p_size < 40 THEN 'APPLE' ELSE '' END AS flavors,
    CASE WHEN p_size BETWEEN 10 AND 19 THEN 'PLAY STRONG' WHEN p_size BETWEEN 20 AND 29 THEN 'BAMBONE' ELSE '' END AS lines,
    CASE WHEN p_size BETWEEN 30 AND 39 THEN CASE WHEN p_name LIKE '%ring' THEN 'BOWL,RING' ELSE 'BOWL' END WHEN p_name LIKE '%ring' THEN 'RING' ELSE '' END AS forms,
    CASE WHEN p_size < 10 THEN '' WHEN p_size < 20 THEN 'dog' WHEN p_size < 30 THEN 'cat' WHEN p_size < 40 THEN 'dish' ELSE '' END AS taxonomy FROM n""",
)
def h16(t):
    size = F.col("p_size")
    lead = (
        F.when(size < 10, "PB & bacon ").when(size < 20, "PLAY STRONG FOAMZ ").when(size < 30, "Bam-Bone kitten ")
        .when(size < 40, "Apple dog BOWL ").otherwise("")
    )
    name = F.concat(lead, F.upper("p_name"))
    return t.part.select(
        "p_partkey", F.array_join(N.flavors(name), ",").alias("flavors"), F.array_join(N.product_lines(name), ",").alias("lines"),
        F.array_join(N.forms(name), ",").alias("forms"), N.taxonomy(name).alias("taxonomy"),
    )


@query(
    "H17_variant_tokens",
    """WITH k AS (SELECT p_partkey, list_distinct(list_concat(string_split(p_name, ' '), [lower(p_type)], CASE WHEN p_size > 25 THEN ['cow'] ELSE ['black', 'bear'] END)) AS b, p_size FROM part)
    SELECT p_partkey, array_to_string(list_sort(list_distinct(list_concat(b, CASE WHEN p_size > 25 THEN ['highland', 'cow', 'highland_cow', 'highlandcow'] ELSE ['black_bear', 'blackbear'] END))), ' ') AS tokens FROM k""",
)
def h17(t):
    label = F.when(F.col("p_size") > 25, "COW").otherwise("Black-Bear")
    return t.part.select("p_partkey", F.array_join(F.array_sort(X.variant_tokens(F.col("p_name"), F.col("p_type"), label)), " ").alias("tokens"))


@query(
    "H18_normalize_size",
    """SELECT p_partkey, CASE WHEN p_size > 30 THEN p_size || ' LB Bag' WHEN p_size > 15 THEN p_size || ' OZ ' || upper(p_type[1]) || lower(p_type[2:]) ELSE p_size || '.5 Gallon EA' END AS size FROM part""",
)
def h18(t):
    raw = (
        F.when(F.col("p_size") > 30, F.concat(text("p_size"), F.lit("lb  bag")))
        .when(F.col("p_size") > 15, F.concat(text("p_size"), F.lit(" oz "), "p_type")).otherwise(F.concat(text("p_size"), F.lit(".5 GALLON ea")))
    )
    return t.part.select("p_partkey", X.normalize_size(raw).alias("size"))


_CLEAN = re(re(re(re("html", H.ELEMENTS), "(?i)</?(?:div|span)[^>]*>"), H.ATTRIBUTES), r"\s+", "' '")
_EMPTY = "(?i)" + "|".join(rf"<{tag}>\s*</{tag}>" for tag in "html head title body style nav article header footer main section ul ol li p a b i em strong h h table tr td th".split())
_CLEAN = strip(re(re(_CLEAN, r"\s+>", "'>'"), _EMPTY))


@query("H19_clean_html", f"SELECT page_id, {_CLEAN} AS html FROM pages")
def h19(t):
    return t.pages.select("page_id", H.clean_html(F.col("html")).alias("html"))


@query(
    "H20_body_html",
    f"""WITH c AS (SELECT page_id, {_CLEAN} AS h FROM pages),
    s AS (SELECT page_id, regexp_matches(h, '(?i)<p[^>]*>') AS p, list_filter(list_transform(string_split_regex(h, '(?i)<br\\s*/?>'), lambda x: {strip('x')}), lambda x: x <> '') AS l FROM c)
    SELECT page_id, array_to_string(list_transform(l, lambda x: CASE WHEN p AND x LIKE '<%' THEN x ELSE '<p>' || x || '</p>' END), '') AS html FROM s""",
)
def h20(t):
    return t.pages.select("page_id", H.body_html(F.col("html")).alias("html"))


@query(
    "H21_alt_tags",
    """SELECT p_partkey, trim(p_name || ' #' || p_size || '_LB' || CASE WHEN p_type = 'PROMO' THEN '' ELSE '#' || p_type END) AS filter_alt,
    '#' || p_brand || CASE WHEN p_type = 'PROMO' THEN '' ELSE '#' || p_type END AS variant_alt, p_name || ' - Hero' AS hero_alt FROM part""",
)
def h21(t):
    kind = F.when(F.col("p_type") == "PROMO", "Each").otherwise(F.col("p_type"))
    alone = F.when(F.col("p_type") != "PROMO", F.col("p_type"))
    size = F.concat(text("p_size"), F.lit("-lb"))
    return t.part.select(
        "p_partkey", H.filter_alt(F.col("p_name"), size, kind, F.lit("none")).alias("filter_alt"),
        H.variant_alt(F.col("p_brand"), alone, F.lit("")).alias("variant_alt"), H.lifestyle_alt(F.col("p_name"), F.lit("Hero")).alias("hero_alt"),
    )


@query(
    "H22_urls",
    """SELECT page_id, regexp_replace(trim(url), '^http://', 'https://') AS https, regexp_replace(url, '[?#].*$', '') AS bare, regexp_replace(url, '\\?[^#]*', '') AS kept,
    'https://site.example/' || regexp_extract(url, '^https?://[^/]*/([^?#]*)', 1) AS absolute FROM pages""",
)
def h22(t):
    url = F.col("url")
    path = F.regexp_extract(url, "^https?://[^/]*(/[^?#]*)", 1)
    dotted = F.concat(F.lit("/x/./y/../.."), path)
    return t.pages.select(
        "page_id", U.https_url(F.concat(F.lit(" "), url)).alias("https"), U.strip_query(url).alias("bare"),
        U.strip_query(url, keep_fragment=True).alias("kept"), U.absolute_url(F.lit("https://site.example/"), dotted).alias("absolute"),
    )


@query(
    "H23_image_url",
    """WITH u AS (SELECT page_id, regexp_replace(regexp_replace(url, '^http:', 'https:'), '[?#].*$', '') AS b FROM pages)
    SELECT page_id, b || '/a.jpg' AS store, b || '/a.png' AS full_size, CASE WHEN page_id % 2 = 0 THEN 'https://o.example/big.png' ELSE b || '/b.png' END AS mapped FROM u""",
)
def h23(t):
    base = F.regexp_replace("url", r"[?#].*$", "")
    store = F.concat(base, F.lit("/a_320x_crop_center.webp?v=1"))
    stem = F.when(F.col("page_id") % 2 == 0, "c").otherwise("b")
    mapped = F.concat(F.regexp_replace(base, "^http:", "https:"), F.lit("/"), stem, F.lit("-150x150.png"))
    big_map = F.create_map(F.lit("c"), F.lit("/big.png"))
    return t.pages.select(
        "page_id", U.image_url(store, strip_size=True, webp=True).alias("store"),
        U.full_size_image(F.concat(F.regexp_replace(base, "^http:", "https:"), F.lit("/a-scaled.png"))).alias("full_size"),
        U.full_size_image(mapped, big_map, F.lit("https://o.example")).alias("mapped"),
    )


@query(
    "H24_srcset_best",
    """SELECT p_partkey, CASE WHEN p_size >= 20 THEN '/b' || p_partkey ELSE '/a' || p_partkey END AS widest, '/c' || p_partkey AS last FROM part""",
)
def h24(t):
    srcset = F.concat(F.lit("/a"), text("p_partkey"), F.lit(" 19w, /b"), text("p_partkey"), F.lit(" "), text("p_size"), F.lit("w, /c"), text("p_partkey"), F.lit(" 2x,"))
    return t.part.select("p_partkey", U.srcset_best(srcset).alias("widest"), U.srcset_best(srcset, last=True).alias("last"))


@query(
    "H25_unwrap_proxy",
    """SELECT page_id, 'https://images.salsify.com/' || page_id || '.png' AS proxied, 'https://o.example/my%20pic' || page_id || '.png' AS handled, regexp_replace(replace(url, 'http://', 'https://'), '[?#].*$', '') AS plain FROM pages""",
)
def h25(t):
    key = text("page_id")
    return t.pages.select(
        "page_id", U.unwrap_proxy(F.concat(F.lit("/remote.axd/images.salsify.com/"), key, F.lit(".png?w=3"))).alias("proxied"),
        U.unwrap_image_handler(F.concat(F.lit("/GetImage.ashx?w=3&image=my+pic"), key, F.lit(".png&h=2")), F.lit("https://o.example/")).alias("handled"),
        U.unwrap_image_handler(F.col("url"), F.lit("https://o.example/")).alias("plain"),
    )


@query(
    "H26_json_in_html",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE CAST(json_extract(props, '$.k') AS VARCHAR) END AS k, event_type = 'click' AS is_product,
    CASE WHEN event_type = 'error' THEN NULL ELSE 'https://x/' || event_id END AS link FROM events""",
)
def h26(t):
    props, kind = F.col("props"), F.col("event_type")
    block = F.when(kind == "view", "{broken").otherwise(props)
    typed = F.when(kind == "click", F.concat(F.lit('[{"@type": "Thing"}, {"@type": "Product", "n": 1}]'))).otherwise('{"@type": "Thing"}')
    tag = F.lit('<script type="application/ld+json">')
    data = F.when(kind == "error", "{oops").otherwise(F.concat(F.lit('{"u": &quot;http://x/'), text("event_id"), F.lit('&quot;}')))
    html = F.concat(tag, block, F.lit("</script>"), tag, typed, F.lit("</script><script>var page ="), data, F.lit(";</script>"))
    rows = t.events.select("event_id", html.alias("html"), kind.alias("kind"))
    first = H.json_ld(F.col("html"))
    return rows.select(
        "event_id", F.get_json_object(first, "$.k").alias("k"), H.json_ld(F.col("html"), "Product").isNotNull().alias("is_product"),
        F.get_json_object(H.json_variable(F.col("html"), "page"), "$.u").alias("link"),
    )


@query(
    "H28_parse_price",
    """SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS DOUBLE) AS price,
    CASE WHEN o_orderstatus = 'P' THEN '$' || o_orderkey || '.50' WHEN o_orderstatus = 'F' THEN '$' || o_orderkey || '.25' ELSE '' END AS portal FROM orders""",
)
def h28(t):
    status = F.col("o_orderstatus")
    shown = F.when(status == "P", "call us").otherwise(F.concat(F.lit("$"), F.format_number("o_totalprice", 2)))
    rate = F.when(status == "P", F.concat(text("o_orderkey"), F.lit(".5")))
    label = F.when(status == "F", F.concat(F.lit(" $ "), text("o_orderkey"), F.lit(".25 each"))).otherwise("n/a")
    return t.orders.select("o_orderkey", C.parse_price(shown).cast("double").alias("price"), C.portal_price(rate, label).alias("portal"))


@query(
    "H29_is_date",
    """SELECT o_orderkey, o_orderpriority NOT LIKE '5%' AS is_date, CASE WHEN o_orderpriority LIKE '5%' THEN CAST(o_orderkey AS VARCHAR) ELSE strftime(o_orderdate, '%Y-%m-%d 00:00:00') END AS value FROM orders""",
)
def h29(t):
    date, kind = F.col("o_orderdate"), F.col("o_orderpriority")
    shown = (
        F.when(kind.startswith("1"), F.date_format(date, "yyyy-MM-dd")).when(kind.startswith("2"), F.date_format(date, "MM/dd/yyyy"))
        .when(kind.startswith("3"), F.date_format(date, "M-d-yy")).when(kind.startswith("4"), F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(text("o_orderkey"))
    )
    return t.orders.select("o_orderkey", C.is_date(shown).alias("is_date"), C.coerce_text(shown).alias("value"))


@query("H30_split_list", "SELECT p_partkey, p_name || '|Salmon|Toffee/Onyx|' || p_type AS items FROM part")
def h30(t):
    listed = F.concat(F.lit(" , "), "p_name", F.lit(",Salmon Toffee/Onyx, "), "p_type", F.lit(" ,"))
    return t.part.select("p_partkey", F.array_join(X.split_list(listed), "|").alias("items"))
