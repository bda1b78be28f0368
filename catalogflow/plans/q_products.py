"""Product builds and the whole run over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import products as B
from ..operators.lookup import family_join
from ..session import materialize
from .q_joins import FAMILIES, families
from .registry import LINES, big, query, text
from .runs import CatalogRun


def product_inputs(t):
    """Customer families in the product input form."""
    segment = F.col("c_mktsegment")
    rows = families(t)
    return rows.select(
        "item_no", "parent", "ord", F.concat(F.lit("Item "), text("item_no")).alias("description_1"),
        F.when(segment == "BUILDING", "50 LB").when(segment == "HOUSEHOLD", "2 gallon").when(segment == "MACHINERY", "EACH").otherwise("").alias("size"),
        F.lit("[16 oz]").alias("upcitemdb_size"), F.lit(None).cast("string").alias("upcitemdb_title"),
        F.concat(F.lit("$"), F.format_number(F.col("c_acctbal").cast("decimal(12,2)"), 2)).alias("sold_ext_price_adj"), F.lit("").alias("avg_price_per_unit"),
        F.when(F.col("c_nationkey") > 10, text("c_nationkey")).alias("sold_ext_cost_adj"), F.lit(None).cast("string").alias("upc"),
        F.when(F.col("c_nationkey") % 5 == 0, F.concat(F.lit("S"), text("item_no"))).alias("sku"),
        F.lpad(text("item_no"), 12, "0").alias("upc_updated"), F.col("c_nationkey").cast("bigint").alias("inventory_qty"), F.lower("c_mktsegment").alias("color"),
        F.when(F.col("c_nationkey") >= 5, "size").otherwise("").alias("option_1"), F.when(F.col("c_nationkey") >= 15, "color").otherwise("").alias("option_2"),
        F.lit("").alias("option_3"), F.lit("").alias("option_4"),
    )


def family_products(t, max_items=1000):
    placed, _ = family_join(product_inputs(t), "item_no", "parent", "ord")
    heads = t.customer.select(F.col("c_custkey").alias("family"), "c_mktsegment", "c_acctbal")
    parsed = heads.filter("c_mktsegment <> 'FURNITURE'").select(
        "family", F.concat(F.lit("Page "), text("family")).alias("title"), F.lit("Maker").alias("brand_hint"), F.lit("one<br>two").alias("description"),
        F.lit("<ul class=\"x\"><li>f</li></ul>").alias("features_benefits"), F.lit("").alias("nutrients"), F.lit(None).cast("string").alias("feeding_directions"),
        F.lit('[{"url":"/d.pdf"}]').alias("documents"), F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("M"), text("family"))).alias("model_number"),
    )
    media = heads.select(
        "family", F.lit(7).cast("bigint").alias("position"), F.lit("/s.png").alias("src"), F.lit("").alias("alt"),
        F.when(F.col("c_mktsegment") == "BUILDING", "external_video").otherwise("image").alias("media_type"), F.lit(0).cast("bigint").alias("part"),
        F.array().cast("array<string>").alias("variant_keys"),
    )
    image_map = heads.filter("c_acctbal > 2000").select("family", F.lit("50 lb").alias("key"), F.lit(9).cast("bigint").alias("image_position"))
    return B.FamilyProducts(placed, parsed, media, image_map, ["size", "color"], "Vendor", max_items)


_FAMILY_VARIANTS = FAMILIES + """, par AS (SELECT family, CASE WHEN c_nationkey >= 5 THEN 'size' WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY') THEN 'size' ELSE '' END AS o1,
   CASE WHEN c_nationkey >= 15 THEN 'color' ELSE '' END AS o2 FROM pos WHERE is_child = 0),
 v AS (SELECT pos.family, pos.family_pos AS position, CAST(pos.item_no AS VARCHAR) AS sku, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS price,
   CASE WHEN c_nationkey > 10 THEN CAST(c_nationkey AS VARCHAR) END AS cost, CASE WHEN c_nationkey % 5 = 0 THEN 'S' || pos.item_no ELSE lpad(CAST(pos.item_no AS VARCHAR), 12, '0') END AS barcode, c_nationkey AS inventory_quantity,
   CASE c_mktsegment WHEN 'BUILDING' THEN 50.0 WHEN 'HOUSEHOLD' THEN 15.0 ELSE 16.0 END::DOUBLE AS weight, CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'lb' ELSE 'oz' END AS weight_unit,
   CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 22680 WHEN 'HOUSEHOLD' THEN 6804 ELSE 454 END AS BIGINT) AS grams,
   CASE WHEN o1 = 'size' THEN CASE c_mktsegment WHEN 'BUILDING' THEN '50 LB' WHEN 'HOUSEHOLD' THEN '2 Gallon' WHEN 'MACHINERY' THEN 'Each' END END AS option1,
   CASE WHEN o2 = 'color' THEN lower(c_mktsegment) END AS option2 FROM pos JOIN par USING (family))"""


@query(
    "I1_build_shopify_products",
    f"""WITH {_FAMILY_VARIANTS} SELECT v.family, v.position, sku, price, cost, barcode, inventory_quantity, weight, weight_unit, grams, option1, option2,
    CASE WHEN option1 = '50 LB' AND c.c_acctbal > 2000 THEN 9 ELSE v.position END AS image_id,
    CASE WHEN c.c_acctbal > 5000 AND c.c_mktsegment <> 'FURNITURE' THEN 1 ELSE 0 END + CASE WHEN option1 IS NOT NULL THEN 1 ELSE 0 END AS n_metafields
    FROM v JOIN customer c ON c.c_custkey = v.family""",
)
def i1(t):
    v = family_products(t).variants
    return v.select(
        "family", "position", "sku", "price", "cost", "barcode", "inventory_quantity", "weight", "weight_unit", "grams", "option1", "option2", "image_id",
        F.size("metafields").alias("n_metafields"),
    )


@query(
    "I1_product_heads",
    f"""WITH {FAMILIES} SELECT family, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Item ' || family ELSE 'Page ' || family END AS title,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE '<p>one</p><p>two</p>' END AS description_html, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Vendor' ELSE 'Maker' END AS vendor,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE 'features=<ul><li>f</li></ul>;documentation=[{{"url":"/d.pdf"}}]' END AS metafields FROM pos WHERE is_child = 0""",
)
def i1_heads(t):
    fields = F.transform("metafields", lambda m: F.concat(m["key"], F.lit("="), m["value"]))
    return family_products(t).head.select(
        "family", "title", F.col("descriptionHtml").alias("description_html"), "vendor", F.array_join(fields, ";").alias("metafields")
    )


@query(
    "I1_nested_products",
    f"""WITH {_FAMILY_VARIANTS} SELECT v.family, (position - 1) // 40 AS part, count(*) AS n_variants, min(sku) AS first_sku, any_value(c_mktsegment = 'BUILDING') AS has_video
    FROM v JOIN customer ON c_custkey = v.family GROUP BY 1, 2""",
)
def i1_nested(t):
    """Product JSON in parts of at most 40 variants, read back."""
    nested = family_products(t, max_items=40).nested
    product = F.from_json("product", "product struct<variants:array<struct<sku:string>>,media:array<struct<alt:string>>>")
    read = nested.select("family", "part", product.alias("p"))
    skus = F.transform("p.product.variants", lambda v: v["sku"])
    return read.select(
        "family", "part", big(F.size(skus)).alias("n_variants"), F.array_min(skus).alias("first_sku"), F.col("p.product.media").isNotNull().alias("has_video")
    )


def paver_inputs(t):
    """Lines as paver rows: title = order, color = flag and line, unit by quantity."""
    q = F.col("q")
    nan = F.lit(float("nan"))
    lines = t.lines()
    return lines.select(
        (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("ord"), F.concat(F.lit(" T"), text("l_orderkey")).alias("portal_title"),
        F.concat(F.lit("P"), (F.col("l_orderkey") % 500).cast("string")).alias("public_title"),
        F.concat("rf", text("l_linenumber")).alias("color"), F.col("p").alias("item_no"),
        F.when(q > 30, q).otherwise(nan).alias("cost_per_piece"), F.when(q > 30, q + 1).alias("price_per_piece"),
        F.when(q > 15, q).alias("cost_per_kit"), F.when(q > 15, q + 2).alias("price_per_kit"),
        F.when(q > 5, q).alias("sq_ft_cost"), F.when(q > 5, q + 3).otherwise(nan).alias("sq_ft_price"),
        F.when(q == 31, 0.0).otherwise(F.col("l_linenumber").cast("double")).alias("pieces_per_cube"), F.lit(2.0).alias("sq_ft_per_cube"),
    )


def paver_rows(t):
    """The paver rows with unit, cost and price, numbered and priced once for all steps that read them."""
    priced = B.priced_rows(paver_inputs(t))
    spent = {c for pair in ("piece", "kit") for c in (f"cost_per_{pair}", f"price_per_{pair}")} | {"sq_ft_cost", "sq_ft_price", "portal_title"}
    return materialize(priced.drop(*spent))


_PAVERS = LINES + """, r AS (SELECT l_orderkey * 1000 + l_linenumber AS ord, 'T' || l_orderkey AS family, rf || l_linenumber AS color, p, q, l_linenumber,
   CASE WHEN q > 30 THEN 'Piece' WHEN q > 15 THEN 'Kit' WHEN q > 5 THEN 'Sq Ft' END AS unit FROM lines)"""


@query(
    "I2_build_paver_products",
    f"""WITH {_PAVERS}, g AS (SELECT * FROM r WHERE unit IS NOT NULL AND family NOT IN (SELECT family FROM r WHERE q = 31))
    SELECT family, row_number() OVER (PARTITION BY family ORDER BY ord) AS position, CAST(50000 + row_number() OVER (ORDER BY ord) - 1 AS VARCHAR) AS sku,
      CAST(CAST(q + CASE unit WHEN 'Piece' THEN 1 WHEN 'Kit' THEN 2 ELSE 3 END AS DOUBLE) AS VARCHAR) AS price, CAST(p AS VARCHAR) AS barcode, color AS option1, unit AS option2,
      CASE WHEN p % 2 = 0 THEN 10.0::DOUBLE / CASE unit WHEN 'Piece' THEN l_linenumber WHEN 'Kit' THEN 1 ELSE 2 END ELSE 0.0 END AS weight,
      CASE WHEN p % 2 = 0 THEN CAST(trunc(10.0::DOUBLE / CASE unit WHEN 'Piece' THEN l_linenumber WHEN 'Kit' THEN 1 ELSE 2 END * 453.592::DOUBLE) AS BIGINT) ELSE 0 END AS grams,
      CASE WHEN p % 2 = 0 THEN 3 ELSE 1 END AS n_metafields FROM g""",
)
def i2(t):
    v = paver_products(t).variants
    return v.select("family", "position", "sku", "price", "barcode", "option1", "option2", "weight", "grams", F.size("metafields").alias("n_metafields"))


def paver_products(t, max_items=1000):
    rows = paver_rows(t)
    portal = rows.filter("item_no % 2 = 0").groupBy("family", "color").agg(
        F.lit("10 lbs").alias("weight"), F.lit("m").alias("model_number"), F.lit("/sw.png").alias("swatch")
    )
    images = rows.select("family", "color", F.lit(1).alias("ord"), F.concat(F.lit("/i/"), text("item_no")).alias("url"))
    shared = rows.select("family").distinct().select("family", F.lit("hero").alias("kind"), F.lit(1).alias("ord"), F.lit("/hero.png").alias("url"))
    public = rows.select("family").distinct().select("family", F.lit("d").alias("description"), F.lit("a\n b").alias("specifications"))
    registry = t.spark.createDataFrame([], "sku string")
    return B.PaverProducts(rows, public, portal, images, shared, registry, "Maker", max_items=max_items)


@query(
    "I2_paver_errors",
    f"WITH {_PAVERS} SELECT family, ord, color, 'Piece: conversion factor is zero or missing' AS error FROM r WHERE q = 31",
)
def i2_errors(t):
    return paver_products(t).errors


@query(
    "I2_paver_options",
    f"""WITH {_PAVERS}, g AS (SELECT * FROM r WHERE unit IS NOT NULL AND family NOT IN (SELECT family FROM r WHERE q = 31)),
    u AS (SELECT DISTINCT family, unit FROM g)
    SELECT family, 1 AS slot, 'Color' AS name, color AS value, row_number() OVER (PARTITION BY family ORDER BY ord) AS value_pos FROM r WHERE family IN (SELECT family FROM g)
    UNION ALL SELECT family, 2, 'Unit of Sale', unit, row_number() OVER (PARTITION BY family ORDER BY unit = 'Sq Ft', unit = 'Kit') FROM u""",
)
def i2_options(t):
    return paver_products(t).options


def run_parts(t, mode="skip"):
    rows = paver_rows(t)
    names = t.part.select("p_partkey")
    public_index = names.select(F.concat(F.lit("P"), text("p_partkey")).alias("title"), F.concat(F.lit("/u"), text("p_partkey")).alias("url"), F.col("p_partkey").alias("ord"))
    none = F.array().cast("array<string>")
    pages = t.part.select(
        F.concat(F.lit("/u"), text("p_partkey")).alias("url"), F.when(F.col("p_size") > 10, F.col("p_name")).otherwise("").alias("title"),
        F.when(F.col("p_size") > 20, "d").otherwise("").alias("description"), F.lit(None).cast("string").alias("hero_image"), none.alias("gallery_images"),
    )
    portal_index = rows.filter("item_no % 3 = 0").select(F.concat_ws(" ", "family", "color").alias("title"), F.lit("/portal").alias("url"), "ord")
    existing = rows.filter("unit is not null and item_no % 2 = 0").select(
        "family", "ord", "color", "unit", F.concat(F.lit("old"), text("item_no")).alias("sku"), text("unit_price").alias("price"), text("unit_cost").alias("cost")
    )
    registry = t.spark.createDataFrame([], "sku string")
    return CatalogRun(rows, public_index, pages, portal_index, existing, registry, mode)


_RUN = _PAVERS + """, s AS (SELECT *, unit IS NOT NULL AND p % 2 = 0 AS skip FROM r),
 f AS (SELECT family, min(ord) AS ord, bool_and(skip) AS fs, count(*) AS n_rows, count(*) FILTER (skip) AS n_skipped, count(*) FILTER (NOT skip) AS n_colors,
   count(*) FILTER (NOT skip AND p % 3 = 0) AS n_portal, any_value(CAST(family[2:] AS BIGINT) % 500) AS k FROM s GROUP BY 1),
 j AS (SELECT f.*, p_partkey IS NULL AS no_public, p_partkey IS NOT NULL AND p_size <= 10 AS bad_page, p_partkey IS NOT NULL AND p_size <= 20 AS thin FROM f LEFT JOIN part ON p_partkey = k),
 st AS (SELECT *, CASE WHEN fs THEN 'skipped' WHEN bad_page THEN 'failed' WHEN no_public AND n_portal = 0 THEN 'failed' WHEN no_public THEN 'ok_portal_only' ELSE 'ok' END AS status FROM j)"""


@query(
    "I3_process_products",
    f"""WITH {_RUN} SELECT family, ord, n_rows, n_skipped, status, CASE WHEN status = 'failed' THEN CASE WHEN bad_page THEN 'Public data validation failed' ELSE 'Product not found on public site or portal' END END AS reason,
    CASE WHEN status LIKE 'ok%' AND (thin OR n_portal < n_colors) THEN 1 ELSE 0 END AS warnings FROM st""",
)
def i3(t):
    return run_parts(t).families


@query(
    "I3_run_summary",
    f"""WITH {_RUN} SELECT count(*) AS total, count(*) FILTER (status LIKE 'ok%') AS successful, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed,
    count(*) FILTER (status LIKE 'ok%' AND (thin OR n_portal < n_colors)) AS with_warnings, CAST(sum(n_skipped) AS BIGINT) AS variants_skipped FROM st""",
)
def i3_summary(t):
    return run_parts(t).summary


@query(
    "I3_merged_variants",
    f"""WITH {_RUN}, k AS (SELECT s.* FROM s JOIN st USING (family) WHERE status LIKE 'ok%'),
    n AS (SELECT family, ord, CAST(50000 + row_number() OVER (ORDER BY ord) - 1 AS VARCHAR) AS sku FROM k WHERE NOT skip AND unit IS NOT NULL)
    SELECT k.family, row_number() OVER (PARTITION BY k.family ORDER BY k.ord, color) AS position, CASE WHEN skip THEN 'existing' ELSE 'generated' END AS source, color, unit,
      CASE WHEN skip THEN 'old' || p ELSE n.sku END AS sku FROM k LEFT JOIN n ON k.family = n.family AND k.ord = n.ord WHERE unit IS NOT NULL""",
)
def i3_variants(t):
    return run_parts(t).variants
