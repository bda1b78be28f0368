"""Positions, running values, sorts and set operations over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import query_variants
from ..functions.urls import dedupe_urls
from ..functions.nested import get_path, set_path
from ..operators import order as O
from ..operators import sets as S
from ..operators.images import best_image
from .registry import LINES, big, query, text


@query("E1_distributed_sequence", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS seq FROM orders")
def e1(t):
    return O.distributed_sequence(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "seq")


@query(
    "E1_group_position",
    "SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS pos FROM events",
)
def e1_group(t):
    """Few, large groups cut into many range buckets."""
    return O.group_position(t.events.select("event_id", "event_type", "ts"), ["event_type"], ["ts", "event_id"]).select("event_id", "event_type", "pos")


@query(
    "E2_allocate_skus",
    """SELECT o_orderkey, CAST(greatest(50000, (SELECT max(p_partkey) + 49000 FROM part) + 1) + row_number() OVER (ORDER BY o_orderkey) - 1 AS VARCHAR) AS sku FROM orders""",
)
def e2(t):
    registry = t.part.select((F.col("p_partkey") + 49000).cast("string").alias("sku"))
    return O.allocate_skus(t.orders.select("o_orderkey"), registry, ["o_orderkey"], 50000)


@query(
    "E3_variant_positions",
    f"""WITH {LINES} SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS position FROM lines WHERE q > 10""",
)
def e3(t):
    kept = t.lines().filter("q > 10").select("l_orderkey", "l_linenumber")
    return O.group_position(kept, ["l_orderkey"], ["l_linenumber"], "position")


@query(
    "E4_image_counters",
    f"""WITH {LINES}, f AS (SELECT l_orderkey, CASE WHEN s > 50 THEN 'lifestyle' ELSE 'portal' END AS kind, CASE WHEN s > 50 THEN '' ELSE rf END AS color,
      'img' || (p % 10) AS url, min(l_linenumber) AS ord FROM lines GROUP BY 1, 2, 3, 4)
    SELECT l_orderkey, kind, color, url, row_number() OVER (PARTITION BY l_orderkey, kind, color ORDER BY ord) AS counter FROM f""",
)
def e4(t):
    shared = F.col("s") > 50
    images = t.lines().select(
        "l_orderkey", F.when(shared, "lifestyle").otherwise("portal").alias("kind"), F.when(shared, "").otherwise(F.col("rf")).alias("color"),
        F.concat(F.lit("img"), (F.col("p") % 10).cast("string"), F.lit("?w=1")).alias("url"), F.col("l_linenumber").alias("ord"),
    )
    kept = S.dedupe_images(images, ["l_orderkey", "kind", "color"], "url", ["ord"])
    return O.group_position(kept, ["l_orderkey", "kind", "color"], ["ord"], "counter").select("l_orderkey", "kind", "color", "url", "counter")


@query(
    "E5_log_context",
    """WITH l AS (SELECT conv_id // 10 AS file, conv_id * 1000 + turn AS line, role, CASE WHEN role = 'system' THEN 'p' || conv_id END AS pm,
      CASE WHEN role = 'user' THEN 'c' || conv_id || '-' || turn END AS cm, role = 'assistant' AS used FROM conversations),
    w AS (SELECT *, last_value(pm IGNORE NULLS) OVER (PARTITION BY file ORDER BY line) AS product,
      last_value(CASE WHEN cm IS NOT NULL THEN cm WHEN used THEN '~' END IGNORE NULLS) OVER (PARTITION BY file ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM l)
    SELECT file, line, product, coalesce(cm, nullif(before, '~')) AS color FROM w""",
)
def e5(t):
    log = t.conversations.select(
        F.floor(F.col("conv_id") / 10).alias("file"), (F.col("conv_id") * 1000 + F.col("turn")).alias("line"), "role",
        text("conv_id").alias("c"), text("turn").alias("n"),
    )
    role = F.col("role")
    product = F.when(role == "system", F.concat(F.lit("p"), "c"))
    color = F.when(role == "user", F.concat(F.lit("c"), "c", F.lit("-"), "n"))
    return O.log_context(log, ["file"], ["line"], product, color, role == "assistant").select("file", "line", "product", "color")


_BREAKER = """WITH e AS (SELECT event_id, user_id, event_type = 'error' AS failed, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
 r AS (SELECT *, pos - coalesce(max(CASE WHEN NOT failed THEN pos END) OVER (PARTITION BY user_id ORDER BY pos), 0) AS failures FROM e),
 x AS (SELECT user_id, min(pos) AS trip FROM r WHERE failures >= 2 GROUP BY 1)
 SELECT event_id, r.user_id, failures, coalesce(pos > trip, false) AS disabled FROM r LEFT JOIN x USING (user_id)"""


@query("E6_search_breaker", _BREAKER)
def e6(t):
    events = t.events.select("event_id", "user_id", "ts", "event_type")
    out = O.search_breaker(events, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", 2)
    return out.select("event_id", "user_id", "failures", "disabled")


@query(
    "E7_best_image",
    f"""WITH {LINES}, m AS (SELECT l_orderkey, l_linenumber AS ord, 'u' || p AS url, p % 7 AS area, CAST(s * 3 AS DOUBLE) AS sharpness, rf = 'A' AS ph FROM lines)
    SELECT l_orderkey, first(url ORDER BY area DESC, sharpness DESC, ord) AS url, max(area) AS area, first(sharpness ORDER BY area DESC, sharpness DESC, ord) AS sharpness
    FROM m WHERE NOT ph AND sharpness >= 100 GROUP BY 1""",
)
def e7(t):
    metrics = t.lines().select(
        "l_orderkey", F.col("l_linenumber").alias("ord"), F.concat(F.lit("u"), text("p")).alias("url"), (F.col("p") % 7).alias("area"),
        (F.col("s") * 3).cast("double").alias("sharpness"), (F.col("rf") == "A").alias("is_placeholder"),
    )
    return best_image(metrics, ["l_orderkey"], "ord")


@query(
    "E8_candidate_cap",
    "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 8",
)
def e8(t):
    return O.candidate_cap(t.events.select("user_id", "event_id", "ts"), ["user_id"], [F.col("ts"), F.col("event_id")], 8).select("user_id", "event_id")


@query(
    "F1_multi_key_sort",
    """SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END, o_totalprice DESC, o_orderkey) AS rank FROM orders""",
)
def f1(t):
    """The sorted table, written and read back with its row order as rank."""
    from ..session import new_shared_path
    from ..sources.records import read_batches, write_records

    nested = t.orders.select("o_orderkey", F.struct(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), "o_totalprice").alias("head"))
    ranked = O.multi_key_sort(nested, [(get_path(nested, "head.status"), False), (get_path(nested, "head.o_totalprice"), True)], ["o_orderkey"])
    path = new_shared_path(t.spark, "f1")
    write_records(ranked, path)
    back = read_batches(t.spark, path, "o_orderkey bigint")
    return O.distributed_sequence(back, ["file", "pos"]).select("o_orderkey", (F.col("seq") + 1).alias("rank"))


@query(
    "F2_query_variants",
    """WITH b AS (SELECT DISTINCT p_name || ' Grizzle-Bear' AS s FROM part),
    v AS (SELECT s, list_distinct([s, replace(s, '-', ' '), replace(s, 'Grizzle', 'grizzly'), replace(replace(s, '-', ' '), 'Grizzle', 'grizzly')]) AS l FROM b)
    SELECT s AS base, array_to_string(list_transform(list_sort(list_transform(l, lambda x: {'o': CASE WHEN x = s THEN 0 ELSE 1 END, 'n': length(x), 't': x})), lambda r: r.t), '|') AS variants FROM v""",
)
def f2(t):
    base = t.part.select(F.concat("p_name", F.lit(" Grizzle-Bear")).alias("base")).distinct()
    return base.select("base", F.array_join(query_variants(F.col("base")), "|").alias("variants"))


@query(
    "F3_dedupe_urls",
    """SELECT page_id, h[1] || '|' || len(list_distinct(h)) AS urls FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS h FROM pages) WHERE len(h) > 0""",
)
def f3(t):
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))
    kept = t.pages.select("page_id", dedupe_urls(F.concat(F.array(F.lit("")), hrefs, hrefs)).alias("h"))
    return kept.filter(F.size("h") > 0).select("page_id", F.concat(F.get("h", F.lit(0)), F.lit("|"), F.size("h").cast("string")).alias("urls"))


@query(
    "F4_dedupe_images",
    f"""WITH {LINES} SELECT l_orderkey, first(CASE WHEN q > 25 THEN 'IMG' ELSE 'img' END || (p % 10) ORDER BY l_linenumber) AS src, min(l_linenumber) AS ord FROM lines GROUP BY l_orderkey, p % 10""",
)
def f4(t):
    name = F.concat(F.when(F.col("q") > 25, "IMG").otherwise("img"), (F.col("p") % 10).cast("string"), F.lit("?v="), text("s"))
    images = t.lines().select("l_orderkey", name.alias("src"), F.col("l_linenumber").alias("ord"))
    return S.dedupe_images(images, ["l_orderkey"], "src", ["ord"])


@query(
    "F5_append_new",
    """SELECT o_orderkey, o_orderstatus AS note FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority LIKE '1%'""",
)
def f5(t):
    a = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", F.col("o_orderstatus").alias("note"))
    return S.append_new(a, t.orders.filter("o_orderpriority like '1%'").select("o_orderkey"), ["o_orderkey"])


@query(
    "F6_extras_not_found",
    """SELECT DISTINCT c_custkey AS key, 'not_found' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
    UNION ALL SELECT DISTINCT o_custkey, 'extra' FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal IS NOT NULL)""",
)
def f6(t):
    left = t.customer.select(F.col("c_custkey").alias("key"))
    right = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("key"))
    return S.key_differences(left, right, "key")


@query(
    "F7_union_candidates",
    """WITH h AS (SELECT page_id, regexp_extract_all(html, 'href="(/[A-Z][^"]*)"', 1) AS a, regexp_extract_all(html, 'href="([^"]+)"', 1) AS b FROM pages),
    p AS (SELECT page_id, u, min(i) AS i FROM (SELECT page_id, unnest(list_concat(a, b)) AS u, unnest(range(len(a) + len(b))) AS i FROM h) GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) AS rn FROM p)
    SELECT page_id, string_agg(u, ' ' ORDER BY rn) AS urls FROM r GROUP BY 1""",
)
def f7(t):
    upper = F.regexp_extract_all("html", F.lit('href="(/[A-Z][^"]*)"'), F.lit(1))
    every = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))
    out = t.pages.select("page_id", S.union_candidates(upper, every).alias("u"))
    return out.filter(F.size("u") > 0).select("page_id", F.array_join("u", " ").alias("urls"))


@query(
    "F8_category_urls",
    f"""WITH {LINES} SELECT l_orderkey, '/' || rf || '/' || p AS url FROM lines WHERE rf <> 'A' GROUP BY 1, 2
    UNION ALL SELECT l_orderkey, '/' || rf || '/' || p || '/' || s FROM lines WHERE rf <> 'A' GROUP BY 1, 2""",
)
def f8(t):
    """A category tree per order: flag, part, supplier; the 'A' branch is the skipped one."""
    root = F.when(F.col("rf") == "A", "/accessories").otherwise(F.concat(F.lit("/"), "rf"))
    second = F.concat(root, F.lit("/"), text("p"))
    leaf = F.struct(F.concat(second, F.lit("/"), text("s")).alias("fullurl"), F.lit("3").alias("level"))
    middle = F.struct(second.alias("fullurl"), F.lit("2").alias("level"), F.array(leaf).alias("categories"))
    top = F.struct(root.alias("fullurl"), F.lit("1").alias("level"), F.array(middle).alias("categories"))
    # one order is one document, as long as it has lines
    trees = t.lines().groupBy("l_orderkey").agg(F.to_json(F.collect_list(top)).alias("tree"))
    return S.category_urls(trees, "tree").select("l_orderkey", "url")


@query("H27_get_set_path", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) + 1 AS k, event_type AS kind FROM events")
def h27(t):
    nested = t.events.select("event_id", "event_type", F.struct(F.from_json("props", "k bigint").alias("data")).alias("props"))
    written = set_path(set_path(nested, "props.data.k", get_path(nested, "props.data.k") + 1), "props.meta.kind", F.col("event_type"))
    return written.select("event_id", get_path(written, "props.data.k").alias("k"), get_path(written, "props.meta.kind").alias("kind"))
