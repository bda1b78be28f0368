"""Checks, filters and slices over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codes import effective_upc, upc_digits, valid_upc
from ..functions.urls import image_candidate, product_link
from ..operators import checks as K
from ..operators.order import record_range
from .registry import big, query, text


@query(
    "B1_record_range",
    """SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
    WHERE rn BETWEEN 101 AND 200""",
)
def b1(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return record_range(rows, ["o_orderdate", "o_orderkey"], 101, 200).select("o_orderkey", "o_custkey")


@query(
    "B2_effective_upc",
    """SELECT o_orderkey, regexp_replace(coalesce(nullif(trim(CASE WHEN o_orderpriority LIKE '1%' THEN ' ' ELSE 'U-' || o_custkey END), ''),
      CASE WHEN o_orderstatus = 'F' THEN NULL ELSE '0-' || o_orderkey END, ''), '[^0-9]', '', 'g') AS upc FROM orders""",
)
def b2(t):
    first = F.when(F.col("o_orderpriority").startswith("1"), " ").otherwise(F.concat(F.lit("U-"), text("o_custkey")))
    second = F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("0-"), text("o_orderkey")))
    return t.orders.select("o_orderkey", effective_upc(first, second).alias("upc"))


def _records(t):
    """Orders as page records with gaps: title, description, hero_image, gallery_images, cost."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    none = F.array().cast("array<string>")
    return t.orders.select(
        "o_orderkey",
        F.when(status == "P", "").otherwise(status).alias("title"),
        F.when(~priority.startswith("4"), priority).alias("description"),
        F.when(priority.startswith("2"), "").otherwise("h.jpg").alias("hero_image"),
        F.when(priority.startswith("3"), none).otherwise(F.split(priority, "-")).alias("gallery_images"),
        F.when(F.col("o_totalprice") > 400000, 0.0).otherwise(F.col("o_totalprice")).alias("cost"),
    )


_RECORDS = """r AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS title,
 CASE WHEN o_orderpriority LIKE '4%' THEN NULL ELSE o_orderpriority END AS description,
 CASE WHEN o_orderpriority LIKE '2%' THEN '' ELSE 'h.jpg' END AS hero_image,
 CASE WHEN o_orderpriority LIKE '3%' THEN CAST([] AS VARCHAR[]) ELSE string_split(o_orderpriority, '-') END AS gallery_images,
 CASE WHEN o_totalprice > 400000 THEN 0.0 ELSE o_totalprice END AS cost FROM orders)"""


@query(
    "B3_required_fields",
    f"""WITH {_RECORDS} SELECT o_orderkey, title <> '' AS is_valid, CASE WHEN title = '' THEN 'title' ELSE '' END AS missing_critical,
    concat_ws(',', CASE WHEN coalesce(description, '') = '' THEN 'description' END, CASE WHEN hero_image = '' THEN 'hero_image' END,
      CASE WHEN len(gallery_images) = 0 THEN 'gallery_images' END, CASE WHEN cost = 0 THEN 'cost' END) AS missing_important FROM r""",
)
def b3(t):
    out = K.required_fields(_records(t), ["title"], ["description", "hero_image", "gallery_images", "cost"])
    return out.select(
        "o_orderkey", "is_valid", F.array_join("missing_critical", ",").alias("missing_critical"),
        F.array_join("missing_important", ",").alias("missing_important"),
    )


@query(
    "B3_any_data",
    f"""WITH {_RECORDS} SELECT o_orderkey, NOT (len(gallery_images) = 0 AND cost = 0 AND hero_image = '') AS is_valid FROM r""",
)
def b3_any(t):
    return K.any_data(_records(t), ["gallery_images", "cost", "hero_image"]).select("o_orderkey", "is_valid")


@query(
    "B3_color_table_failures",
    """SELECT count(*) AS n_rows, count(*) FILTER (p_size < 3 OR p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE')) AS n_bad,
    count(*) = 0 OR count(*) FILTER (p_size < 3 OR p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE')) > 0 AS fails FROM part""",
)
def b3_colors(t):
    rows = t.part.select(F.when(F.col("p_size") >= 3, F.col("p_name")).alias("title"), F.array("p_brand").alias("colors"), "p_type")
    return K.color_table_failures(rows, ["title", "colors"], "p_type", ["ECONOMY", "SMALL", "LARGE"])


@query(
    "B4_data_summary",
    f"""WITH {_RECORDS} SELECT o_orderkey, title <> '' AS has_title, coalesce(description, '') <> '' AS has_description,
    hero_image <> '' AS has_hero_image, cost <> 0 AS has_cost, CAST(len(gallery_images) AS INTEGER) AS gallery_images_count FROM r""",
)
def b4(t):
    flags = ["title", "description", "hero_image", "cost"]
    out = K.data_summary(_records(t), flags, ["gallery_images"])
    return out.select("o_orderkey", *[f"has_{f}" for f in flags], "gallery_images_count")


@query(
    "B5_variant_complete",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_discount <> 0 AND l_tax <> 0 AS complete FROM lineitem""",
)
def b5(t):
    price = F.when(F.col("l_discount") == 0, "").otherwise(text("l_extendedprice"))
    cost = F.when(F.col("l_tax") != 0, F.col("l_tax"))
    done = K.variant_complete(F.col("l_partkey"), price, cost)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", done.alias("complete"))


@query(
    "B6_variant_unit",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount > 0.05 AND l_tax <> 0 THEN 'Piece'
      WHEN l_quantity > 25 THEN 'Kit' WHEN l_returnflag = 'A' THEN 'Sq Ft' END AS unit FROM lineitem""",
)
def b6(t):
    price, nan = F.col("l_extendedprice"), F.lit(float("nan"))
    prices = {
        "Piece": (F.when(F.col("l_discount") > 0.05, price), F.when(F.col("l_tax") == 0, nan).otherwise(price)),
        "Kit": (F.when(F.col("l_quantity") > 25, price).otherwise(nan), price),
        "Sq Ft": (price, F.when(F.col("l_returnflag") == "A", price)),
    }
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", K.variant_unit(prices).alias("unit"))


@query(
    "B7_validate_input",
    """WITH i AS (SELECT c_custkey AS item_no, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_custkey < 20 THEN c_custkey WHEN c_acctbal > 9500 THEN -1
        WHEN c_acctbal > 9000 THEN c_custkey - 1 ELSE c_nationkey END AS parent,
      CASE WHEN c_acctbal > 3000 THEN lpad(CAST(c_custkey AS VARCHAR), 12, '0') ELSE CAST(c_custkey AS VARCHAR) END AS upc_updated,
      CASE WHEN c_mktsegment = 'BUILDING' THEN 'color' ELSE 'size' END AS option_1,
      CASE WHEN c_acctbal > 5000 THEN '' ELSE c_mktsegment END AS size, CASE WHEN c_nationkey > 12 THEN c_mktsegment END AS color FROM customer),
    p AS (SELECT item_no AS p, parent AS pp FROM i),
    c AS (SELECT i.item_no, i.parent, p.p, p.pp FROM i LEFT JOIN p ON i.parent = p.p WHERE i.parent IS NOT NULL AND i.parent <> i.item_no)
    SELECT item_no AS item, 'required_missing' AS rule, 'size' AS detail FROM i WHERE size = ''
    UNION ALL SELECT item_no, 'bad_upc', upc_updated FROM i WHERE length(upc_updated) NOT IN (12, 13)
    UNION ALL SELECT item_no, 'option_without_data', 'option_1' FROM i WHERE (option_1 = 'size' AND size = '') OR (option_1 = 'color' AND color IS NULL)
    UNION ALL SELECT item_no, 'parent_missing', CAST(parent AS VARCHAR) FROM c WHERE p IS NULL
    UNION ALL SELECT item_no, 'parent_not_self', CAST(parent AS VARCHAR) FROM c WHERE p IS NOT NULL AND pp IS DISTINCT FROM p
    UNION ALL SELECT item_no, 'parent_circular', CAST(parent AS VARCHAR) FROM c WHERE pp = item_no
    UNION ALL SELECT coalesce(parent, item_no), 'options_disagree', '' FROM i GROUP BY 1 HAVING min(option_1) <> max(option_1)""",
)
def b7(t):
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    parent = (
        F.when(balance < 0, None).when(key < 20, key).when(balance > 9500, -1).when(balance > 9000, key - 1).otherwise(F.col("c_nationkey"))
    )
    items = t.customer.select(
        key.alias("item_no"), parent.alias("parent"),
        F.when(balance > 3000, F.lpad(key.cast("string"), 12, "0")).otherwise(key.cast("string")).alias("upc_updated"),
        F.when(F.col("c_mktsegment") == "BUILDING", "color").otherwise("size").alias("option_1"),
        F.when(balance > 5000, "").otherwise(F.col("c_mktsegment")).alias("size"),
        F.when(F.col("c_nationkey") > 12, F.col("c_mktsegment")).alias("color"),
    )
    return K.validate_input(items, required=["size"], options=["option_1"], data_columns=["size", "color"])


@query(
    "B8_valid_upc",
    """SELECT o_orderkey, length(regexp_replace(c, '[^0-9]', '', 'g')) IN (12, 13) AS ok
    FROM (SELECT o_orderkey, o_orderkey || '-' || o_custkey || '-' || o_totalprice AS c FROM orders)""",
)
def b8(t):
    code = F.concat_ws("-", text("o_orderkey"), text("o_custkey"), F.col("o_totalprice").cast("string"))
    return t.orders.select("o_orderkey", valid_upc(code).alias("ok"))


@query(
    "B9_image_candidate",
    """WITH u AS (SELECT page_id, CASE WHEN url LIKE '%/fr/%' THEN replace(url, '/fr/', '/CDN/shop/') WHEN url LIKE '%/de/%' THEN url || '/Single%20Item%20Images'
      WHEN url LIKE '%/es/%' THEN url || '/Horse-logo' ELSE url || '/feed.png' END AS u, CASE WHEN url LIKE '%#top' THEN 'In Stock ' ELSE '' END AS alt FROM pages)
    SELECT page_id, lower(u) LIKE '%/cdn/shop/%' AS store, u LIKE '%Single\\%20Item\\%20Images%' ESCAPE '\\' AND alt = '' AS catalog,
    regexp_matches(lower(u), 'product|feed|bag|amplify|equine|horse') AND NOT regexp_matches(lower(u), 'logo|icon|favicon|banner|mic-w') AS words,
    u LIKE '%example.com%' AS cdn FROM u""",
)
def b9(t):
    raw = F.col("url")
    url = (
        F.when(raw.contains("/fr/"), F.replace(raw, F.lit("/fr/"), F.lit("/CDN/shop/")))
        .when(raw.contains("/de/"), F.concat(raw, F.lit("/Single%20Item%20Images")))
        .when(raw.contains("/es/"), F.concat(raw, F.lit("/Horse-logo")))
        .otherwise(F.concat(raw, F.lit("/feed.png")))
    )
    rows = t.pages.select("page_id", url.alias("u"), F.when(raw.endswith("#top"), "In Stock ").otherwise("").alias("alt"))
    u = F.col("u")
    return rows.select(
        "page_id", image_candidate(u, "store").alias("store"),
        image_candidate(u, "catalog", alt=F.col("alt"), width=F.lit("640")).alias("catalog"),
        image_candidate(u, "words").alias("words"), image_candidate(u, "cdn", cdn="example.com").alias("cdn"),
    )


@query(
    "B10_link_filter",
    """WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages)
    SELECT page_id, href, regexp_matches(href, '^/[a-z]+') AND NOT regexp_matches(href, '/blog|/catalogsearch|/customer|/account|/cart|/privacy|/terms') AS keep FROM h""",
)
def b10(t):
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))
    links = t.pages.select("page_id", F.explode(hrefs).alias("href"))
    return links.select("page_id", "href", product_link(F.col("href"), "^/[a-z]+").alias("keep"))


@query(
    "B11_index_stale",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN true ELSE floor((epoch(TIMESTAMP '1999-06-01 12:00:00') - epoch(o_orderdate)) / 86400.0) > 7 END AS stale FROM orders""",
)
def b11(t):
    built = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    stale = K.index_stale(built, F.lit("1999-06-01 12:00:00"))
    return t.orders.select("o_orderkey", stale.alias("stale"))
