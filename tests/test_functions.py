"""Text, code, size and address functions on the published examples."""

import html
import re
import unicodedata

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from catalogflow.functions import codes, fixed, markup, names, sizes, text, urls
from catalogflow.functions.nested import get_path, map_all_strings, set_path


def _weighed(count: int, size: float, word: str):
    """What a text of count packages of so many units weighs: the rule in plain Python."""
    unit, factor = fixed.WEIGHT_UNITS[word]
    weight = count * size * factor
    return weight, unit, round(weight * fixed.GRAMS_PER_UNIT[unit])


def _weight_cases():
    for k, word in enumerate(fixed.WEIGHT_UNITS):
        size, count = 3 + 1.37 * k, 2 + k % 5
        for form in (f"{size:g} {word}", f"{size:g}{word}", f" {size:g} {word.lower()} "):
            yield form, _weighed(1, float(f"{size:g}"), word)
        yield f"{count} - {size:g} {word} sacks", _weighed(count, float(f"{size:g}"), word)
    for form in ("EACH", None, "", "twelve LB", "7 PALLETS", "LB 4"):
        yield form, (None, None, 0)


def test_weights(spark):
    cases = list(_weight_cases())
    df = spark.createDataFrame([(form, i) for i, (form, _) in enumerate(cases)], "c string, i int")
    got = {r["i"]: r["w"] for r in df.select("i", sizes.parse_weight(F.col("c")).alias("w")).collect()}
    for i, (form, (weight, unit, grams)) in enumerate(cases):
        assert got[i]["weight"] == (pytest.approx(weight) if weight is not None else None), form
        assert (got[i]["unit"], got[i]["grams"]) == (unit, grams), form


def test_product_weight_falls_back(value):
    three = sizes.product_weight(F.lit("EACH"), F.lit("[50 lbs]"), F.lit("Feed 25-lb"))
    assert value(three)["weight"] == 50.0
    assert value(sizes.product_weight(F.lit(""), F.lit(None), F.lit("Feed 25-lb Bag")))["weight"] == 25.0


def test_unit_weight_zero_factor_is_error(value):
    def w(unit, pieces, area):
        return value(sizes.unit_weight(F.lit(3000.0), F.lit("lb"), F.lit(unit), F.lit(pieces), F.lit(area)))

    assert w("Piece", 100.0, None)["grams"] == 13607
    assert w("Kit", None, None)["weight"] == 3000.0
    assert w("Sq Ft", 1.0, 0.0)["error"].startswith("Sq Ft")
    assert w("Piece", float("nan"), 1.0)["error"] is not None


def test_sizes(value):
    assert value(sizes.extract_sizes(F.lit('12" x 3 in, 2 lb 8 oz 1 kg'))) == {"IN": [12.0, 3.0], "OZ": [32.0, 8.0], "G": [1000.0]}
    match = lambda q, p: value(sizes.sizes_match(sizes.extract_sizes(F.lit(q)), sizes.extract_sizes(F.lit(p))))
    assert match("16 oz", "1 lb")
    assert not match("12 in", "16 in")
    assert match("12 in", "3 lb")
    assert match("", "3 lb")


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("<p>a<br/>b</p>", "a\nb"), ("&amp;lt; &copy; &#39;x&#x41; &bogus; &", "&lt; © 'xA &bogus; &"), (None, ""), ("  <b> </b> ", ""),
        ("caf&eacute; &hearts;", "café ♥"),
    ],
)
def test_text_only(value, raw, expected):
    assert value(text.text_only(F.lit(raw).cast("string"))) == expected


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(["&amp;", "&lt;", "&#233;", "&quot;", "a", ";", "& ", "&#x2022;", "#", "x;"]), max_size=8))
def test_entities_equal_the_plain_rule(spark, parts):
    raw = "".join(parts)
    got = spark.range(1).select(text.unescape_entities(F.lit(raw)).alias("v")).first()["v"]
    assert got == html.unescape(raw)


def test_bullets(value):
    listed = value(text.bullet_points(F.lit("SOFT AND TOUGH.. Made here; made HERE; • washable.")))
    assert listed == ["Soft and tough", "Made here", "washable"]
    assert value(text.bullet_points(F.lit("One plain sentence"))) == []
    assert value(text.bullet_points(F.lit(None).cast("string"))) in ([], None)


def test_keywords(value):
    kw = lambda s: sorted(value(text.keyword_set(F.lit(s))))
    assert kw("Premium Dog Food") == ["dog", "premium"]
    assert kw("Equine Treats") == ["treats"]
    assert kw("A B Cat D") == ["cat"]
    assert kw("Hen 50 LB") == ["lb", "poultry"]


def test_fix_description(value):
    assert value(text.fix_description(F.lit("a .. b"))) == "a. b"
    assert value(text.fix_description(F.lit("one two three four five six seven eight nine"))).endswith("nine.")


def test_sizes_normalized(value):
    n = lambda s: value(text.normalize_size(F.lit(s)))
    assert [n(s) for s in ("50 LB", "2 GALLON", "16 OZ", "EACH", "50lb", "")] == ["50 LB", "2 Gallon", "16 OZ", "Each", "50 LB", ""]


def test_query_variants(value):
    got = value(text.query_variants(F.lit('Grizzle 2-in-1 12" 3x4')))
    assert got[0] == 'Grizzle 2-in-1 12" 3x4' and len(got) == 12
    assert len({g.lower() for g in got}) == len(got)
    assert value(text.query_variants(F.lit("Grizzle Bear"))) == ["Grizzle Bear", "grizzly Bear"]


def test_canonical_keys(value):
    k = lambda s, mode, **kw: value(text.canonical_key(F.lit(s), mode, **kw))
    assert k("Crème  Brûlée!", "normalize") == "creme brulee"
    assert k("Straße", "casefold") == "strasse"
    assert k("Crème", "prefix:3") == "cre"
    assert k("ab-12", r"regex:(\d+)") == "12"
    assert k("Crème", "map", mapping={"creme": "x"}) == "x"
    assert value(text.slugify(F.lit("  Éclair & Co. "))) == "Eclair-Co"
    assert value(text.slugify(F.lit("!!"))) == "_"


@settings(max_examples=20, deadline=None)
@given(st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x24F), max_size=12))
def test_slug_equals_the_plain_rule(spark, raw):
    plain = "".join(c for c in unicodedata.normalize("NFKD", raw) if not unicodedata.combining(c))
    plain = re.sub(r"[^a-zA-Z0-9._-]+", "-", plain).strip("-._")[:80] or "_"
    got = spark.range(1).select(text.slugify(F.lit(raw)).alias("v")).first()["v"]
    assert got == plain


def test_upcs(value):
    assert value(codes.extract_upcs(F.lit("012345678905 0123456789012 12345678901 x123456789012"))) == ["012345678905", "123456789012"]
    assert value(codes.valid_upc(F.lit("0-12345-67890-1")))
    assert value(codes.upc_12_to_13(F.lit("012345678905"))) == "0012345678905"
    assert value(codes.upc_13_to_12(F.lit("0012345678905"))) == "012345678905"
    assert value(codes.table_upc(F.lit("51115052798"))) == "051115052798"
    assert value(codes.table_upc(F.lit("nan"))) is None
    assert value(codes.table_upc(F.lit("12345678901234"))) == "12345678901234"
    assert value(codes.upc_candidates(F.lit("051115052798"))) == [
        "051115052798", "0051115052798", "00051115052798", "51115052798",
    ]
    assert value(codes.upc_candidates(F.lit(""))) == []


def test_prices_and_dates(value):
    assert str(value(codes.parse_price(F.lit("$1,234.5")))) == "1234.50"
    assert value(codes.portal_price(F.lit("448.6"), F.lit("x"))) == "$448.60"
    assert value(codes.portal_price(F.lit("n/a"), F.lit(" $ 12.30 "))) == "$12.30"
    dates = {"2024-02-03": True, "2/3/24": True, "20240203": False, "2024.02.03": True, "hello": False, "2024-13-01": False, "": False}
    for raw, expected in dates.items():
        assert value(codes.is_date(F.lit(raw))) is expected, raw
    assert str(value(codes.to_date_value(F.lit("1/2/75"))))[:10] == "1975-01-02"


def test_urls(value):
    v = lambda e: value(e)
    assert v(urls.https_url(F.lit(" //a/b"))) == "https://a/b"
    assert v(urls.strip_query(F.lit("https://e/x.jpg?v=1#s"))) == "https://e/x.jpg"
    assert v(urls.strip_query(F.lit("https://e/x.jpg?v=1#s"), keep_fragment=True)) == "https://e/x.jpg#s"
    assert v(urls.absolute_url(F.lit("https://e/"), F.lit("/a/../b/./c"))) == "https://e/b/c"
    assert v(urls.strip_store_size(F.lit("https://c/x_960x_crop_center.jpg?v=1"))) == "https://c/x.jpg"
    assert v(urls.image_url(F.lit("//c/x_320x.webp?v=1"), strip_size=True, webp=True)) == "https://c/x.jpg"
    assert v(urls.srcset_best(F.lit("/a 100w, /b 300w, /c 300w"))) == "/b"
    assert v(urls.full_size_image(F.lit("https://c/p/x-300x300.png?z"))) == "https://c/p/x.png"


def test_html(value):
    cleaned = value(markup.clean_html(F.lit('<div class="a"><script>x</script><p style="b" onclick="c">Hi <span>you</span></p><b></b></div>')))
    assert cleaned == "<p>Hi you</p>"
    assert value(markup.body_html(F.lit("a<br>b"))) == "<p>a</p><p>b</p>"
    assert value(markup.body_html(F.lit("<p>a</p><br/>b"))) == "<p>a</p><p>b</p>"
    assert value(markup.body_html(F.lit(""))) == ""
    assert value(markup.filter_alt(F.lit("Horse Feed"), F.lit("50 LB"), F.lit("EA"), F.lit("None"))) == "Horse Feed #50_LB"
    assert value(markup.variant_alt(F.lit("Blue"), F.lit(""), F.lit("Wood"))) == "#Blue#Wood"
    assert value(markup.specification_html(F.lit("d"), F.lit("a\n\n b"))) == "<p>d</p><h3>Specifications</h3><ul><li>a</li><li>b</li></ul>"


def test_names(value):
    assert value(names.normalize_name(F.lit("Spot PUPPIES for the X-Bone 3 pk"))) == "PUPPY XBONE 3"
    assert value(names.flavors(F.lit("pb & Bacon"))) == ["PEANUT BUTTER", "BACON"]
    assert value(names.forms(F.lit("XBONE tug"))) == ["XBONE", "TUG", "X-BONE"]
    assert [value(names.taxonomy(F.lit(s))) for s in ("dog bowl", "kitten toy", "puppy", "silver vine", "x")] == ["dish", "cat", "dog", "cat", ""]


def test_nested(spark):
    df = spark.createDataFrame([(" a  b ", (" c ", [" d  e "]))], "s string, n struct<x:string,y:array<string>>")
    row = map_all_strings(df, text.normalize_text).first()
    assert (row["s"], row["n"]["x"], row["n"]["y"]) == ("a b", "c", ["d e"])
    again = set_path(set_path(df, "n.x", F.lit("z")), "m.k.v", F.lit(1))
    assert again.select(get_path(again, "n.x"), get_path(again, "m.k.v"), get_path(again, "n.q")).first()[:] == ("z", 1, None)


@settings(max_examples=20, deadline=None)
@given(st.text(max_size=14))
def test_canonical_keys_equal_the_plain_rule_in_any_script(spark, raw):
    raw = raw.replace("\0", "")
    soft = "".join(c for c in unicodedata.normalize("NFKD", raw).casefold() if not unicodedata.combining(c)).strip()
    soft = re.sub(r"[^\w\s.-]", "", re.sub(r"\s+", " ", soft))
    row = spark.range(1).select(
        text.canonical_key(F.lit(raw), "normalize").alias("n"), text.canonical_key(F.lit(raw), "casefold").alias("c"), text.canonical_key(F.lit(raw), "prefix:3").alias("p")
    ).first()
    assert row.c == raw.casefold()
    if raw.isprintable() and all(unicodedata.category(c)[0] in "LPZ" for c in unicodedata.normalize("NFKD", raw)):  # \w and \s of odder kinds differ in Java
        assert (row.n, row.p) == (soft, soft[:3])


def test_slugify_of_long_texts_reads_on_only_where_needed(spark):
    from pyspark.sql import functions as F

    from catalogflow.functions.text import slugify

    texts = ["ab " * 500, "!" * 1000 + "end", "é" * 90 + " x", "a" * 79 + "-" * 400 + "b", "a" * 80 + "." * 400 + "b", "-" * 330 + "漢" * 9 + "Ω tail", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", slugify(F.col("t")).alias("s"))
    found = [r["s"] for r in df.orderBy("i").collect()]
    assert found == [("ab-" * 27)[:80], "end", "e" * 80, "a" * 79 + "-", "a" * 80, "tail", "_", "_"]
    assert "320" in df._jdf.queryExecution().analyzed().toString()  # the beginning is tried first
