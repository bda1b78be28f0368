"""Operators on small fixtures: results, laws, skew, plans."""

import collections
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Row, functions as F

from catalogflow.operators import aggregate, checks, lookup, matching, merge, order, pages, products, sets

ONE_BIG_GROUP = 40  # partitions in skew tests, so a group of hundreds is spread over many of them


def skewed(spark, n=400):
    """Two thirds of the rows in one group, unordered."""
    rows = [(("hot" if i % 3 else f"g{i % 7}"), i, i * 37 % 11) for i in range(n)]
    random.Random(1).shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, o long, v long").repartition(5)


@pytest.mark.parametrize("size", [1, 3, ONE_BIG_GROUP, 600])
def test_sequence_is_contiguous(spark, size):
    rows, df = skewed(spark)
    got = order.distributed_sequence(df, ["v", "o"], parts=size).collect()
    expected = {o: i for i, (_, o, _) in enumerate(sorted(rows, key=lambda r: (r[2], r[1])))}
    assert {r["o"]: r["seq"] for r in got} == expected


@pytest.mark.parametrize("size", [1, 3, ONE_BIG_GROUP, 600])
@pytest.mark.parametrize("run", [2, 256])
def test_running_values_over_partitions(spark, size, run, monkeypatch):
    """Also with more partitions than one run holds, and with empty partitions."""
    monkeypatch.setattr(order, "RUN", run)
    rows, df = skewed(spark)
    even = F.when(F.col("v") % 2 == 0, F.col("v"))
    got = order.running_values(
        df, ["g"], ["o"],
        [
            order.Running("pos", F.lit(1).cast("bigint")), order.Running("total", F.col("v")), order.Running("top", F.col("v"), "max"),
            order.Running("latest", even, "last"), order.Running("start", F.col("o"), "first"), order.Running("before", even, "last", exclude_current=True),
            order.Running("parity", F.col("v"), "xor"),
        ],
        size,
    ).collect()
    assert len(got) == len(rows)
    seen = {}
    expected = {}
    for g, o, v in sorted(rows, key=lambda r: (r[0], r[1])):
        s = seen.setdefault(g, {"pos": 0, "total": 0, "top": None, "latest": None, "start": o, "parity": 0})
        before = s["latest"]
        s["pos"] += 1
        s["total"] += v
        s["parity"] ^= v
        s["top"] = v if s["top"] is None else max(s["top"], v)
        s["latest"] = v if v % 2 == 0 else s["latest"]
        expected[o] = (s["pos"], s["total"], s["top"], s["latest"], s["start"], before, s["parity"])
    assert {r["o"]: (r["pos"], r["total"], r["top"], r["latest"], r["start"], r["before"], r["parity"]) for r in got} == expected


def test_null_groups_and_empty_input(spark):
    df = spark.createDataFrame([(None, i) for i in range(30)] + [("a", i) for i in range(30)], "g string, o long")
    got = order.group_position(df, ["g"], ["o"], parts=4).collect()
    assert all(r["pos"] == r["o"] + 1 for r in got)
    assert order.distributed_sequence(df.filter("false"), ["o"]).count() == 0


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), min_size=1, max_size=40), st.integers(2, 9))
def test_positions_law(spark, keys, size):
    rows = [(g, v, i) for i, (g, v) in enumerate(keys)]
    df = spark.createDataFrame(rows, "g string, v long, i long")
    got = {r["i"]: r["pos"] for r in order.group_position(df, ["g"], ["v", "i"], parts=size).collect()}
    for g in {"a", "b", None}:
        ranked = sorted((v, i) for gg, v, i in rows if gg == g)
        assert [got[i] for _, i in ranked] == list(range(1, len(ranked) + 1))


def test_no_task_sees_a_whole_table_or_a_hot_group(spark):
    """Rows reach the windows by partition; the same plan for one row and for many, without values from the driver."""
    _, df = skewed(spark)
    few, many = (order.running_values(d, ["g"], ["o"], [order.Running("n", F.lit(1))], parts=32) for d in (df.limit(1), df))
    assert all("SinglePartition" not in d._jdf.queryExecution().executedPlan().toString() for d in (few, many))
    steps = [len(d._jdf.queryExecution().optimizedPlan().toString().splitlines()) for d in (few, many)]
    assert steps[0] == steps[1]
    numbered = order.distributed_sequence(df, ["o"], parts=32)
    assert "SinglePartition" not in numbered._jdf.queryExecution().executedPlan().toString()
    assert [r.seq for r in numbered.orderBy("o").collect()] == list(range(400))


def test_batches_and_slices(spark):
    df = spark.range(120).withColumnRenamed("id", "k")
    out = order.split_batches(df, 50, ["k"], parts=11)
    assert {r["batch_label"]: r["count"] for r in out.groupBy("batch_label").count().collect()} == {"001": 50, "002": 50, "003": 20}
    assert [r["k"] for r in order.record_range(df, ["k"], 101, 103, 11).orderBy("k").collect()] == [100, 101, 102]
    assert order.record_range(df, ["k"], 0, None, 11).count() == 120


def test_nest_keeps_every_row_in_bounded_parts(spark):
    rows, df = skewed(spark)
    parts = order.nest(df, ["g"], ["o"], F.col("o"), "items", max_items=25, parts=ONE_BIG_GROUP).collect()
    assert max(len(p["items"]) for p in parts) <= 25
    hot = [o for p in sorted((p for p in parts if p["g"] == "hot"), key=lambda p: p["part"]) for o in p["items"]]
    assert hot == sorted(o for g, o, _ in rows if g == "hot")
    assert sum(len(p["items"]) for p in parts) == len(rows)


def test_skus(spark):
    empty = spark.createDataFrame([], "sku string")
    df = spark.range(5)
    first = order.allocate_skus(df, empty, ["id"], 50000)
    assert [r["sku"] for r in first.orderBy("id").collect()] == ["50000", "50001", "50002", "50003", "50004"]
    used = spark.createDataFrame([("50000",), ("50009",), ("abc",)], "sku string")
    second = order.allocate_skus(df, used, ["id"], 50000)
    assert [r["sku"] for r in second.orderBy("id").collect()][0] == "50010"
    behind = used.withColumn("next_auto_sku", F.lit(50050).cast("bigint"))
    assert order.sku_base(behind, 50000).first()[:] == (3, 50050)
    assert order.mark_used(used, first).count() == 7


@pytest.mark.parametrize("size", [4, 1000])
def test_breaker(spark, size):
    outcomes = "FFSFFFFFSFF"
    df = spark.createDataFrame([("a", i, c == "F") for i, c in enumerate(outcomes)] + [("b", i, i % 2 == 0) for i in range(12)], "s string, o long, f boolean")
    got = order.search_breaker(df, ["s"], ["o"], F.col("f"), 5, size).filter("s = 'a'").orderBy("o").collect()
    assert [r["failures"] for r in got] == [1, 2, 0, 1, 2, 3, 4, 5, 0, 1, 2]
    assert [r["disabled"] for r in got] == [False] * 8 + [True] * 3
    whole = order.search_breaker(df.filter("s = 'a'"), [], ["o"], F.col("f"), 5, size)
    assert whole.filter("disabled").count() == 3


def test_log_context(spark):
    lines = [
        "[1/2] Processing: T1 | x", "Fetching public page: u", "Collecting portal data for color: Red (product: T1)", "Fetching portal page: p1",
        "⚠ Weight not found", "[2/2] Processing: T2 | x", "Collecting portal data for color: Blue (product: T2)", "⚠ Cost not found", "Fetching portal page: p2",
    ]
    log = spark.createDataFrame([("f", i, s) for i, s in enumerate(lines)], "file string, line_no long, text string")
    text = F.col("text")
    product = F.coalesce(
        F.nullif(F.regexp_extract(text, r"Processing: (.+?) \|", 1), F.lit("")), F.nullif(F.regexp_extract(text, r"\(product: (.+?)\)", 1), F.lit(""))
    )
    color = F.nullif(F.regexp_extract(text, r"for color: (.+?) \(product", 1), F.lit(""))
    for size in (3, 1000):
        out = order.log_context(log, ["file"], ["line_no"], product, color, text.contains("Fetching portal page"), size).orderBy("line_no").collect()
        assert [r["product"] for r in out] == ["T1"] * 5 + ["T2"] * 4
        assert [r["color"] for r in out] == [None, None, "Red", "Red", None, None, "Blue", "Blue", "Blue"]
    missing = F.nullif(F.regexp_extract(text, "⚠ (.+) not found", 1), F.lit(""))
    found = aggregate.log_missing_summary(spark.createDataFrame(out), "product", "color", missing).collect()
    assert {(r["product"], r["color"], r["item"]) for r in found} == {("T1", None, "Weight"), ("T2", "Blue", "Cost")}


def test_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), (None, 1, "n")], "k string, o int, v string")
    assert {(r["k"], r["v"]) for r in aggregate.last_wins(df, ["k"], ["o"]).collect()} == {("a", "y"), (None, "n")}
    assert {(r["k"], r["v"]) for r in aggregate.first_wins(df, ["k"], ["o"]).collect()} == {("a", "x"), (None, "n")}


CATALOG = "upc string, product_url string, product_name string, brand string, description string, ingredients string, image_urls array<string>, ord int"


def test_enrich_from_catalog(spark):
    catalog = spark.createDataFrame(
        [
            ("012345678901", "https://x/old", "Old", "B", "d", None, None, 1),
            ("0-12345-67890-1", " https://x/new ", "<b>New</b>", "B", "Soft .. tough", "i", ["http://a/1.jpg", "//a/2.jpg", "http://a/1.jpg"], 2),
            (None, "u", "n", "b", "d", "i", [], 3),
        ],
        CATALOG,
    )
    rows = spark.createDataFrame([(1, None, "0-12345 678901"), (2, "", "999"), (3, None, None)], "id int, upc string, upc_updated string")
    out = {r["id"]: r for r in lookup.enrich_from_catalog(rows, catalog, ["upc", "upc_updated"], ["ord"], "https://home").collect()}
    m = out[1]["manufacturer"]
    assert (m["product_url"], m["name"], m["description"], m["media"]) == ("https://x/new", "New", "Soft. tough", ["https://a/1.jpg", "https://a/2.jpg"])
    assert m["benefits_text"] == ["Soft", "tough"]
    assert out[1]["shopify"]["media"] == ["012345678901_0.jpg", "012345678901_1.jpg"]
    for i in (2, 3):
        assert out[i]["manufacturer"]["homepage"] == "https://home" and out[i]["manufacturer"]["name"] == "" and out[i]["shopify"]["media"] == []


def test_rows_without_code_do_not_meet_in_one_task(spark):
    catalog = spark.createDataFrame([("012345678901", "u", "n", "b", "d", None, None, 1)], CATALOG)
    rows = spark.range(1000).select("id", F.when(F.col("id") == 0, "012345678901").alias("upc"), F.lit(" ").alias("upc_updated"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(kept, ("-1", "false")):
            spark.conf.set(k, v)
        out = lookup.enrich_from_catalog(rows, catalog, ["upc", "upc_updated"], ["ord"], "https://home")
        got = out.select("id", "manufacturer.name", F.spark_partition_id().alias("at")).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sorted((r["id"], r["name"]) for r in got) == [(i, "n" if i == 0 else "") for i in range(1000)]
    assert len({r["at"] for r in got if r["id"]}) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_title_lookup(spark):
    index = spark.createDataFrame([(64, "Kit", "/a"), (92, "Kit", "/b"), (10, "Stone Red", "http://o/c")], "prodid int, title string, url string")
    rows = spark.createDataFrame([("Kit", None), ("kit", None), ("Stone", "Red")], "title string, color string")
    got = lookup.lookup_title(rows, index, lookup.color_title(F.col("title"), F.col("color")), ["prodid"], "https://s").collect()
    assert {(r["title"], r["matched_url"]) for r in got} == {("Kit", "https://s/a"), ("kit", None), ("Stone", "http://o/c")}


def test_families(spark):
    items = [(7676, None), (36962, 36962.0), (33673, 36962.0), (5, 99.0), (33674, 36962.0)]
    df = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(items)], "item long, parent double, ord long")
    placed, orphans = lookup.family_join(df, "item", "parent", "ord", parts=2)
    assert [r["item"] for r in orphans.collect()] == [5]
    assert {(r["item"], r["family"], r["family_pos"]) for r in placed.collect()} == {(7676, 7676, 1), (36962, 36962, 1), (33673, 36962, 2), (33674, 36962, 3)}


def test_keyword_waterfall(spark):
    def best(description, title, found):
        inputs = spark.createDataFrame([(1, description, title)], "input_id long, description string, title string")
        rows = [(1, s, i + 1, n, f"u{i}") for i, (s, n) in enumerate(found)]
        candidates = spark.createDataFrame(rows, "input_id long, source string, pos int, name string, url string")
        return matching.match_keywords(inputs, candidates).first()[1:3]

    d, t, s = "by_description", "by_title", "second"
    assert best("Premium Horse Feed", "", [(d, "Other"), (d, "PREMIUM HORSE FEED 50 LB")]) == ("u1", 1)
    assert best("Premium Horse Feed", "", [(d, "Premium Mix"), (d, "Premium Horse Formula")]) == ("u0", 2)
    assert best("Premium Horse Feed", "Gold Treats", [(d, "Nope"), (t, "gold bits")]) == ("u1", 3)
    assert best("Premium Horse Feed", "", [(d, "Nope"), (s, "premium")]) == ("u1", 4)
    assert best("Premium Horse Feed", "", [(d, "Nope")]) == ("", 0)


def test_attribute_gates(spark):
    inputs = spark.createDataFrame([(1, "Bacon Chew Ring 12 in dog")], "input_id long, name string")
    rows = [
        (1, 1, "https://s/bacon-chew-ring-dog/", "Chew Ring 12 in dog", "apple", ""),  # flavor
        (1, 2, "https://s/bacon-chew-ring-dog/", "Bacon Chew Ring 6 in dog", "bacon", ""),  # size
        (1, 3, "https://s/bacon-chew-ring/", "Bacon Chew Ring 12 in cat", "bacon", ""),  # taxonomy
        (1, 4, "https://s/bacon-chew-ring-dog", "Bacon Chew Ring 12 in dog", "bacon", "dog"),
        (1, 5, "https://s/p5", "Bacon Chew Ring 12 in dog", "bacon", "dog"),
    ]
    candidates = spark.createDataFrame(rows, "input_id long, pos int, url string, title string, page_text string, page_taxonomy string")
    got = matching.match_attributes(inputs, candidates).collect()
    assert [(r["url"], round(r["score"], 6)) for r in got] == [("https://s/bacon-chew-ring-dog", 1.2 * 5 + 3.0 + 0.6)]


def _ratio(a, b):
    a, b = (" ".join(sorted(x.lower().split())) for x in (a, b))
    prev = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(prev[j] + 1 if x == y else max(prev[j + 1], row[j]))
        prev = row
    return 200.0 * prev[-1] / (len(a) + len(b)) if a or b else 100.0


def test_nearest_title_equals_brute_force(spark):
    rng = random.Random(5)
    words = ["harbor", "fieldstone", "xl", "kit", "3-pc.", "design", "round", "table", "onyx", "natural", "6", "9"]
    titles = [" ".join(rng.sample(words, rng.randint(1, 4))) for _ in range(60)]
    queries = [" ".join(rng.sample(words, rng.randint(1, 4))).upper() for _ in range(25)] + ["", "zzz", "qqqqq"]
    index = spark.createDataFrame([(t, i) for i, t in enumerate(titles)], "name string, ord long")
    inputs = spark.createDataFrame([(q,) for q in queries * 2], "title string")
    got = {r["title"]: (r["matched_title"], round(r["score"], 6)) for r in matching.nearest_title(inputs, index, "title", "name", "ord").collect()}
    for q in set(queries):
        scores = [(round(_ratio(q, t), 6), -i) for i, t in enumerate(titles)]
        score, i = max(scores)
        if score >= 60:
            assert got[q] == (titles[-i], score), q
        else:
            assert q not in got


def test_rank_and_style(spark):
    inputs = spark.createDataFrame([(1, "black bear toy"), (2, "")], "input_id long, query string")
    rows = [(1, 1, "Bear", "a"), (1, 2, "Black Bear Large", "b"), (1, 3, "Black Bear", "c"), (2, 1, "X", "d"), (2, 2, "Y", "e")]
    got = matching.rank_titles(inputs, spark.createDataFrame(rows, "input_id long, pos int, name string, url string")).collect()
    assert {(r["input_id"], r["url"]) for r in got} == {(1, "c"), (2, "d")}
    refs = spark.createDataFrame([(1, "14in Grizzly Bear")], "k long, reference string")
    labels = spark.createDataFrame([(1, 1, "Yeti"), (1, 2, "Grizzle Bear"), (1, 3, "Bear")], "k long, pos int, label string")
    assert matching.match_style(refs, labels, ["k"]).first()["label"] == "Grizzle Bear"


def test_merge_and_patch_laws(spark):
    original = spark.createDataFrame([("1", "a", 1), (None, "n", 2), ("2", "b", 3), ("1", "c", 4)], "id string, v string, ord long")
    augmented = spark.createDataFrame([("1", "A", 1), ("1", "AA", 2), ("9", "Z", 3), ("", "E", 4)], "id string, v string, ord long")
    merged = merge.merge_batches(original, augmented, "id", ["ord"]).collect()
    assert sorted((r["id"], r["v"]) for r in merged if r["id"]) == [("1", "AA"), ("1", "AA"), ("2", "b")] and len(merged) == 4
    assert merge.merge_report(original, augmented, "id").first()[:] == (2, 1, 1, 1, 1)
    same = merge.patch_columns(original, original, "id", "ord", overwrite=["v"])
    assert sorted(r[:] for r in same.select("id", "v", "ord", "overwrites").collect()) == [("1", "c", 1, 0), ("2", "b", 3, 0)]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, ord long, v string")
    new = spark.createDataFrame([("b", 1, "Y"), ("c", 2, "Z")], "k string, ord long, v string")
    once = merge.upsert(old, new, ["k"], "ord").drop("is_new")
    assert sorted(r[:] for r in once.collect()) == [("a", 1, "x"), ("b", 2, "Y"), ("c", 2, "Z")]
    twice = merge.upsert(once, new, ["k"], "ord").drop("is_new")
    assert sorted(r[:] for r in twice.collect()) == sorted(r[:] for r in once.collect())


def paver_rows(spark):
    nan = float("nan")
    rows = [
        ("T", "Red", 2.99, 3.99, None, None), ("T", "Red", None, nan, 5.99, 7.99), ("T", "Blue", 7.5, 8.5, 1.0, 1.0), ("T", "Green", 6.0, 7.0, nan, nan),
    ]
    full = [(i, p, "", c, f"I{i}", a, b, None, nan, d, e, 10.0, 5.0) for i, (p, c, a, b, d, e) in enumerate(rows)]
    return spark.createDataFrame(
        full,
        "ord long, portal_title string, public_title string, color string, item_no string, cost_per_piece double, price_per_piece double, "
        "cost_per_kit double, price_per_kit double, sq_ft_cost double, sq_ft_price double, pieces_per_cube double, sq_ft_per_cube double",
    )


def test_skip_and_variant_order(spark):
    rows = products.priced_rows(paver_rows(spark))
    assert [r["unit"] for r in rows.orderBy("ord").collect()] == ["Piece", "Sq Ft", "Piece", "Piece"]
    existing = spark.createDataFrame(
        [("T", 0, "Red", "Piece", "s1", True), ("T", 1, "Blue", "Piece", "s2", True)], "family string, ord long, color string, unit string, sku string, complete boolean"
    )
    marked = merge.skip_variants(rows, existing, "family")
    assert {(r["color"], r["unit"]): r["skip"] for r in marked.collect()} == {
        ("Red", "Piece"): True, ("Red", "Sq Ft"): False, ("Blue", "Piece"): True, ("Green", "Piece"): False,
    }
    fresh = spark.createDataFrame([("T", 1, "Red", "Sq Ft", "n1"), ("T", 3, "Green", "Piece", "n2"), ("T", 9, "Grey", "Kit", "n3")], "family string, ord long, color string, unit string, sku string")
    merged = merge.merge_variants(marked.select("family", "ord", "color", "unit", "skip"), existing, fresh, "family", parts=2)
    assert [r["sku"] for r in merged.orderBy("position").collect()] == ["s1", "n1", "s2", "n2", "n3"]


def test_paver_products(spark):
    rows = products.priced_rows(paver_rows(spark))
    portal = spark.createDataFrame([("T", "Red", "3000 lbs", "M1", "/s.png")], "family string, color string, weight string, model_number string, swatch string")
    images = spark.createDataFrame([("T", "Red", 1, "http://i/r.jpg?x"), ("T", "Red", 2, "http://i/R.jpg"), ("T", "Blue", 1, "/b.jpg")], "family string, color string, ord int, url string")
    shared = spark.createDataFrame([("T", "hero", 1, "/h.jpg"), ("T", "lifestyle", 1, "/H.jpg"), ("T", "lifestyle", 2, "/l.jpg")], "family string, kind string, ord int, url string")
    public = spark.createDataFrame([("T", "d", "s1\ns2")], "family string, description string, specifications string")
    built = products.PaverProducts(rows, public, portal, images, shared, spark.createDataFrame([], "sku string"), "V")
    v = built.variants.orderBy("position").collect()
    assert [(r["sku"], r["option1"], r["option2"], r["price"]) for r in v] == [
        ("50000", "Red", "Piece", "3.99"), ("50001", "Red", "Sq Ft", "7.99"), ("50002", "Blue", "Piece", "8.5"), ("50003", "Green", "Piece", "7.0"),
    ]
    assert (v[0]["weight"], v[0]["grams"]) == (300.0, 136077)
    assert v[0]["weight_unit"] == "lb"
    gallery = built.images.orderBy("position").collect()
    assert [r["src"] for r in gallery[:3]] == ["http://i/r.jpg", "/h.jpg", "/l.jpg"]
    assert gallery[0]["alt"] == "T - Product Image 1 #Red#Sq Ft" and gallery[1]["alt"] == "T - Hero #Red#Sq Ft"
    parts = built.nested.collect()
    assert len(parts) == 1 and '"title":"T"' in parts[0]["product"] and '"hide_online_price"' in parts[0]["product"]


def test_validation_rules(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "012345678901", "size", "5 LB"), (2, 1.0, "12", "size", ""), (3, 9.0, "012345678901", "color", "x"), (4, 2.0, "012345678901", "size", "x"), (4, None, "0123456789012", "size", "x")],
        "item_no long, parent double, upc_updated string, option_1 string, size string",
    )
    got = {(r["item"], r["rule"]) for r in checks.validate_input(df, required=["size"], options=["option_1"], data_columns=["size"]).collect()}
    assert got == {
        (2, "required_missing"), (2, "option_without_data"), (2, "bad_upc"), (3, "parent_missing"), (4, "parent_not_self"), (4, "duplicate_item"),
    }


def test_category_tree(spark):
    tree = (
        '[{"fullurl":"/pavers","level":"1","categories":[{"fullurl":"/pavers/a","level":"2","categories":[{"fullurl":"/pavers/a/k","level":"3"}]},{"fullurl":"/p","level":"2"}]},'
        '{"fullurl":"/accessories/x","level":"2","categories":[{"fullurl":"/accessories/x/y","level":"3"}]},{"fullurl":"/pavers/a","level":"2"}]'
    )
    got = sets.category_urls(spark.createDataFrame([(1, tree)], "id int, tree string"), "tree").orderBy("path").collect()
    assert [r["url"] for r in got] == ["/pavers/a", "/pavers/a/k"]


def test_second_source(spark):
    p = spark.createDataFrame([Row(k=1, title="T", documents=["a"], images=[Row(position=1, src="s", alt="x")])], "k long, title string, documents array<string>, images array<struct<position:bigint,src:string,alt:string>>")
    q = p.unionByName(spark.createDataFrame([(2, "U", None, [])], p.schema))
    extra = spark.createDataFrame([(1, ["b"], ["g"]), (2, ["c"], ["g1", "g2"])], "k long, documents array<string>, gallery_images array<string>")
    out = {r["k"]: r for r in lookup.merge_second_source(q, extra, ["k"]).collect()}
    assert out[1]["documents"] == ["a", "b"] and [i["src"] for i in out[1]["images"]] == ["s"]
    assert out[2]["documents"] == ["c"] and [(i["position"], i["src"], i["alt"]) for i in out[2]["images"]] == [(1, "g1", "U"), (2, "g2", "U")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_join(spark, how):
    from catalogflow.operators.skew import skew_join

    rows, df = skewed(spark)
    df = df.unionByName(spark.createDataFrame([(None, 1000 + i, 0) for i in range(30)], df.schema))
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("g1", 3), ("none", 4)], "g string, w int")
    even = skew_join(df, small, ["g"], how, rows_per_part=20)
    assert sorted(map(tuple, even.select("g", "o", "v", "w").collect()), key=str) == sorted(
        map(tuple, df.join(small, "g", how).select("g", "o", "v", "w").collect()), key=str
    )
    assert "__salt" in even._jdf.queryExecution().analyzed().toString()


def test_child_of_a_label_is_matched_in_one_join_without_salt(spark):
    """Many rows and no hot key: pairs lie by key after the join, and are read once for both rules."""
    from catalogflow.operators.skew import skew_join

    many = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("g"), "id")
    even = skew_join(many, many.select("g", F.col("id").alias("w")), ["g"], rows_per_part=20)
    assert "__salt" not in even._jdf.queryExecution().optimizedPlan().toString() and even.count() == 9000
    chosen = spark.createDataFrame([(1, "Dark Oak", ["moss"]), (2, "red", [])], "k int, label string, tokens array<string>")
    labels = spark.createDataFrame(
        [(1, "a", 0, "oak"), (1, "b", 1, "moss dark"), (1, "b", 1, "oak dark"), (1, "c", 2, "dark oak moss"), (2, "d", 1, "blue"), (2, "e", 0, "green"), (2, "f", 2, "RED")],
        "k int, child string, child_pos int, label string",
    )
    found = matching.match_child(chosen, labels, ["k"])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert {r.k: r.child for r in found.collect()} == {1: "b", 2: "f"}


def test_reference_of_a_style_is_cleaned_once(spark):
    """Not again for every word of every label."""
    refs = spark.createDataFrame([(1, "Giant Moss 2×1"), (2, None)], "k int, reference string")
    labels = spark.createDataFrame([(1, 0, "oak"), (1, 1, "Moss oak"), (1, 2, "moss"), (2, 0, "oak")], "k int, pos int, label string")
    found = matching.match_style(refs, labels, ["k"])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("[^a-z0-9") == 1
    assert {r.k: (r.label, r.score) for r in found.collect()} == {1: ("moss", 100.0), 2: ("oak", 0.0)}


def test_keywords_of_a_pair_are_scored_once(spark):
    """Whatever the tier, and words of a row asked for are not cut a third time for the second site."""
    inputs = spark.createDataFrame([(1, "blue moss", "red moss"), (2, "", "red oak"), (3, "oak", "oak"), (4, "oak", "oak")], "input_id int, description string, title string")
    found = [
        (1, "by_title", 0, "red moss", "/t"), (1, "second", 0, "blue moss", "/s"), (1, "by_description", 5, "moss pale blue", "/d"),
        (2, "second", 1, "oak red", "/s"), (2, "by_description", 0, "oak", "/d"), (3, "by_title", 0, "oak", "/t"),
    ]
    out = matching.match_keywords(inputs, spark.createDataFrame(found, "input_id int, source string, pos int, name string, url string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect(") == 1 and plan.count("\\W+") == 3
    assert {r.input_id: (r.url, r.tier, r.score) for r in out.collect()} == {1: ("/d", 2, 1.0), 2: ("/s", 4, 1.0), 3: ("", 0, 0.0), 4: ("", 0, 0.0)}


def test_arrays_need_positions_only_where_a_key_outgrows_one(spark):
    rows = [("a", 3, "z"), ("a", None, "x"), ("a", 1, "y"), (None, 1, "n"), ("b", 2, "p"), ("b", 1, "q")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    small = order.nest(df, ["k"], ["o", "v"], F.col("v"), max_items=3)
    assert "Window" not in small._jdf.queryExecution().optimizedPlan().toString() and "__part" not in small._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.k, r.part): r["items"] for r in small.collect()} == {("a", 0): ["x", "y", "z"], (None, 0): ["n"], ("b", 0): ["q", "p"]}
    large = order.nest(df, ["k"], ["o", "v"], F.col("v"), max_items=2)
    assert {(r.k, r.part): r["items"] for r in large.collect()} == {("a", 0): ["x", "y"], ("a", 1): ["z"], (None, 0): ["n"], ("b", 0): ["q", "p"]}


def test_arrays_of_numbered_rows_are_cut_by_their_numbers(spark):
    df = spark.range(1, 8).select((F.col("id") * 0).alias("k"), F.col("id").alias("n"))
    cut = order.nest(df, ["k"], ["n"], F.col("n"), max_items=3, numbered=True)
    assert {r.part: r["items"] for r in cut.collect()} == {0: [1, 2, 3], 1: [4, 5, 6], 2: [7]}


def test_skew_join_of_rows_with_maps(spark):
    from catalogflow.operators.skew import skew_join

    big = spark.createDataFrame([("hot", i, {"weight": [float(i)]}) for i in range(50)], "g string, o int, m map<string,array<double>>")
    even = skew_join(big, spark.createDataFrame([("hot", 1)], "g string, w int"), ["g"], rows_per_part=20)
    assert sorted(r["m"]["weight"][0] for r in even.collect()) == [float(i) for i in range(50)]
    assert skew_join(big.select("g", "m"), big.select("g", "o"), ["g"], rows_per_part=20).count() == 2500


def test_pages_of_one_small_file_are_parsed_by_many_tasks(spark):
    from catalogflow.plans.q_pages import tree_html
    from catalogflow.plans.registry import Tables

    pages = tree_html(Tables(spark, "/root/testdata/sf0.001"))
    assert pages.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_gallery_pages_of_one_small_file_are_parsed_by_many_tasks(spark):
    from catalogflow.plans.q_pages import gallery_html
    from catalogflow.plans.registry import Tables

    pages = gallery_html(Tables(spark, "/root/testdata/sf0.001"))
    assert pages.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_swatch_blobs_are_read_once(spark):
    import json

    from catalogflow.operators import lookup

    config = {
        "attributes": {"1": {"code": "style", "options": [{"id": "5", "label": "Red", "products": ["a"]}, {"id": "6", "label": "Blue", "products": []}]}},
        "index": {"b": {"1": "6"}}, "images": {"a": ["i"], "b": ["j"]},
    }
    widget = {"jsonConfig": config, "mediaGallery": {"a": ["m", "n"]}, "gallery": {"a": ["g"], "c": []}}
    pages = spark.createDataFrame([(1, json.dumps({"x": {lookup.SWATCH_WIDGET: widget}})), (2, "{}"), (3, None)], "page int, blob string")
    labels = lookup.swatch_labels(pages, "page", "blob")
    assert sorted(map(tuple, labels.collect())) == [(1, "a", "Red"), (1, "b", "Blue")]
    media = lookup.swatch_media(pages, "page", "blob")
    assert sorted(map(tuple, media.collect())) == [(1, "a", 0, "m"), (1, "a", 1, "n"), (1, "b", 0, "j")]
    assert "jsonConfig" not in labels._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in media._jdf.queryExecution().optimizedPlan().toString()


def test_native_operators_have_no_python_node(spark):
    rows, df = skewed(spark)
    for out in (order.group_position(df, ["g"], ["o"], parts=9), aggregate.last_wins(df, ["g"], ["o"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan


def test_parents_in_any_form(spark):
    rows = [("36962", "36962.0", 1), ("33673", "36962.0", 2), ("7", "", 3), ("8", None, 4), ("9", "99", 5)]
    families, orphans = lookup.family_join(spark.createDataFrame(rows, "item string, parent string, ord int"), "item", "parent", "ord")
    assert sorted((r.item, r.family, r.is_child) for r in families.collect()) == [("33673", "36962", 1), ("36962", "36962", 0), ("7", "7", 0), ("8", "8", 0)]
    assert [r.item for r in orphans.collect()] == ["9"]
    numbers = spark.createDataFrame([(1, "1.0", 1), (2, "1.0", 2), (3, "", 3)], "item bigint, parent string, ord int")
    families, orphans = lookup.family_join(numbers, "item", "parent", "ord")
    assert sorted((r.item, r.family) for r in families.collect()) == [(1, 1), (2, 1), (3, 3)] and orphans.count() == 0


def test_color_stands_where_its_first_row_does(spark):
    variants = spark.createDataFrame(
        [("p", "T", 1, "Red", None), ("p", "T", 2, "Blue", "Piece"), ("p", "T", 3, "Red", "Kit"), ("p", "T", 4, "Gray", None)],
        "product string, title string, ord int, color string, unit string",
    )
    none = spark.createDataFrame([], "product string, color string, ord int, url string")
    hero = spark.createDataFrame([("p", "hero", 1, "h")], "product string, kind string, ord int, url string")
    out = lookup.gallery_by_color(variants, none, hero, "product", "title").orderBy("position").collect()
    assert [r.alt.split("#")[1:] for r in out] == [["Red", "Kit"], ["Blue", "Piece"]]


def test_every_candidate_counts(spark):
    inputs = spark.createDataFrame([(1, "Premium Horse Feed", "")], "input_id bigint, description string, title string")
    names = [(1, "by_description", k, "Other Thing", f"/{k}") for k in range(20)] + [(1, "by_description", 20, "Premium Horse Feed 50 LB", "/hit")]
    found = matching.match_keywords(inputs, spark.createDataFrame(names, "input_id bigint, source string, pos int, name string, url string"))
    assert found.first()["url"] == "/hit"


def test_style_counts_the_variant_tokens(spark):
    labels = spark.createDataFrame([(1, 0, "green moss"), (1, 1, "dark oak")], "k int, pos int, label string")
    plain = spark.createDataFrame([(1, "moss blanket", None), ], "k int, reference string, tokens array<string>")
    more = spark.createDataFrame([(1, "moss blanket", ["dark", "oak"])], "k int, reference string, tokens array<string>")
    assert matching.match_style(plain, labels, ["k"]).first()["label"] == "green moss"
    assert matching.match_style(more, labels, ["k"]).first()["label"] == "dark oak"


def test_upsert_keeps_columns_and_rows_without_order(spark):
    old = spark.createDataFrame([(1, 1, "a", "x"), (2, 2, "b", "y")], "k int, ord int, v string, only_old string")
    new = spark.createDataFrame([(2, None, "c", 7), (3, 5, "d", 8)], "k int, ord int, v string, only_new int")
    out = {r.k: r for r in merge.upsert(old, new, ["k"], "ord").collect()}
    assert (out[2].v, out[2].only_old, out[2].only_new, out[2].ord, out[2].is_new) == ("c", "y", 7, 2, False)
    assert (out[1].v, out[1].only_new, out[3].v, out[3].only_old, out[3].is_new) == ("a", None, "d", None, True)


def test_product_record_with_markup(spark):
    html = '<script>x</script><script>var p = {"description": "<b>x</b>", "variants": [{"id": "1", "price": 250}]};</script>'
    row = pages.embedded_variants(spark.createDataFrame([(1, html)], "page int, html string"), "page").first()
    assert (row.variant_id, row.price) == ("1", 2.5)


def test_nearest_title_keys_lose_no_pair_and_join_few(spark):
    """Several rare letters at once: equal to brute force at every ratio, and far from all pairs at a high one."""
    rng = random.Random(2)
    words = ["".join(rng.choice("eeeaaiotnsrhldcmfpgwybvkz") for _ in range(rng.randint(3, 9))) for _ in range(150)]
    made = lambda n: [" ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) for _ in range(n)]
    titles = made(250) + ["", " ", "ß", "zz", "x" * 90]
    queries = made(200) + ["".join(rng.sample(t, len(t))) for t in titles[:40]] + [t[1:] + "q" for t in titles[:40]] + ["", "éß", "x" * 80]
    left = spark.createDataFrame([(q,) for q in set(queries)], "q string")
    right = spark.createDataFrame([(t,) for t in set(titles)], "t string")
    count = {x: collections.Counter(x) for x in {*queries, *titles}}
    for ratio in (0.85, 0.6):
        want = {
            (q, t) for q in set(queries) for t in set(titles) if q and t and 2 * (count[q] & count[t]).total() >= ratio * (len(q) + len(t)) - 1e-9
        }
        got = [(r.q, r.t) for r in matching.title_pairs(left, right, ratio).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
    common = matching._common_letters(left.withColumn("letters", matching._letters(F.col("q"))))
    sides = [df.withColumn(f"{c}_letters", matching._rare_first(matching._letters(F.col(c)), common)) for df, c in ((left, "q"), (right, "t"))]
    assert matching._candidates(*sides, 0.85).count() < 0.1 * len(set(queries)) * len(set(titles))
    keys = [matching._keyed(side, c, f"{c}_letters", 0.85, c == "q").groupBy("__key").count() for side, c in zip(sides, "qt")]
    met = keys[0].join(keys[1].withColumnRenamed("count", "n"), "__key").select((F.col("count") * F.col("n")).alias("rows"))
    most, total = met.agg(F.max("rows"), F.sum("rows")).first()
    assert most < total / 20  # no key makes a large share of the pairs


def test_paver_colors_and_gallery_count_rows_without_a_unit(spark):
    """Red first stands on a row without a unit: it leads the gallery; Gray has no unit at all: an option, but no image."""
    rows = spark.createDataFrame(
        [("T", 1, "Red", None), ("T", 2, "Blue", "Piece"), ("T", 3, "Red", "Piece"), ("T", 4, "Gray", None), ("U", 5, "Red", None)], "family string, ord bigint, color string, unit string"
    ).withColumns({c: F.lit(2.0) for c in ("unit_price", "unit_cost", "pieces_per_cube", "sq_ft_per_cube")} | {"item_no": F.col("ord")})
    portal = spark.createDataFrame([], "family string, color string, weight string, model_number string, swatch string")
    own = spark.createDataFrame([("T", "Blue", 1, "/b.png"), ("T", "Red", 1, "/r.png"), ("T", "Gray", 1, "/g.png")], "family string, color string, ord int, url string")
    shared = spark.createDataFrame([], "family string, kind string, ord int, url string")
    public = spark.createDataFrame([("T", "d", "s")], "family string, description string, specifications string")
    built = products.PaverProducts(rows, public, portal, own, shared, spark.createDataFrame([], "sku string"), "Maker")
    assert [r.src for r in built.images.orderBy("position").collect()] == ["/r.png", "/b.png"]
    options = [(r.family, r.slot, r.value) for r in built.options.orderBy("family", "slot", "value_pos").collect()]
    assert options == [("T", 1, "Red"), ("T", 1, "Blue"), ("T", 1, "Gray"), ("T", 2, "Piece")]


def test_run_tables_are_numbered_and_priced_once(spark):
    from catalogflow.plans.q_products import run_parts
    from catalogflow.plans.registry import Tables

    run = run_parts(Tables(spark, "/root/testdata/sf0.001"))
    for df in (run.inputs, run.existing, run.portal_index):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "regexp_replace" not in plan
    assert run.families.filter("status = 'skipped'").count() == run.rows.groupBy("family").agg(F.bool_and("skip").alias("s")).filter("s").count()


def test_paver_options_need_no_numbers(spark):
    rows = products.priced_rows(paver_rows(spark))
    portal = spark.createDataFrame([], "family string, color string, weight string, model_number string, swatch string")
    built = products.PaverProducts(rows, None, portal, None, None, spark.createDataFrame([], "sku string"), "V")
    got = [(r["slot"], r["value"], r["value_pos"]) for r in built.options.orderBy("slot", "value_pos").collect()]
    assert got == [(1, "Red", 1), (1, "Blue", 2), (1, "Green", 3), (2, "Piece", 1), (2, "Sq Ft", 2)]
    assert "variants" not in vars(built)
    assert not {"portal_title", "cost_per_piece", "w", "__cube"} & set(built.good.columns)


def test_lines_read_several_times_are_numbered_once(spark):
    from catalogflow.plans.q_joins import existing_variants, variant_inputs
    from catalogflow.plans.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    for df in (variant_inputs(t), existing_variants(t)):
        assert "Window" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert t.kept_lines is t.kept_lines and t.kept_lines.count() == t.lineitem.count()
