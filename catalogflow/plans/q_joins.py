"""Lookups and merges over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import lookup as L
from ..operators import merge as M
from ..operators.aggregate import last_wins
from .registry import LINES, big, query, text


def part_catalog(t):
    """Parts as a catalog keyed by padded part number."""
    return t.part.select(
        F.lpad(text("p_partkey"), 12, "0").alias("upc"), F.concat(F.lit("/p/"), text("p_partkey")).alias("product_url"),
        F.concat(F.lit("<b>"), "p_name", F.lit("</b>")).alias("product_name"), F.col("p_brand").alias("brand"),
        F.concat("p_name", F.lit(" .. "), "p_type").alias("description"), F.col("p_type").alias("ingredients"),
        F.array(F.concat(F.lit("//img/"), text("p_partkey")), F.concat(F.lit("http://img/"), text("p_size"))).alias("image_urls"),
        "p_partkey",
    )


def catalog_inputs(t):
    code = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("00-"), F.lpad(text("l_partkey"), 10, "0")))
    spare = F.when(F.col("l_linestatus") == "O", F.lpad(text("l_partkey"), 12, "0"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", code.alias("upc"), spare.alias("upc_updated"))


C1_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, coalesce('/p/' || p_partkey, '') AS product_url, 'https://shop.example' AS homepage, coalesce(p_name, '') AS product_name, coalesce(p_brand, '') AS brand,
    coalesce(p_name || '. ' || p_type, '') AS description, coalesce(p_type, '') AS ingredients,
    CASE WHEN p_partkey IS NULL THEN '' ELSE 'https://img/' || p_partkey || CASE WHEN p_size = p_partkey THEN '' ELSE ' https://img/' || p_size END END AS images,
    CASE WHEN p_partkey IS NULL THEN '' ELSE lpad(CAST(p_partkey AS VARCHAR), 12, '0') || '_0.jpg'
      || CASE WHEN p_size = p_partkey THEN '' ELSE ' ' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') || '_1.jpg' END END AS media
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND (l_returnflag = 'A' OR l_linestatus = 'O')"""


def enriched_columns(df):
    m = F.col("manufacturer")
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", m["product_url"].alias("product_url"), m["homepage"].alias("homepage"),
        m["product_name"].alias("product_name"), m["brand"].alias("brand"),
        m["description"].alias("description"), m["ingredients_text"].alias("ingredients"),
        F.array_join(m["media"], " ").alias("images"), F.array_join("shopify.media", " ").alias("media"),
    )


@query("C1_enrich_from_catalog", C1_SQL)
def c1(t):
    out = L.enrich_from_catalog(catalog_inputs(t), part_catalog(t), ["upc", "upc_updated"], ["p_partkey"], "https://shop.example")
    return enriched_columns(out)


@query(
    "C2_lookup_by_url",
    """WITH c AS (SELECT url, max(page_id) AS catalog_id FROM pages GROUP BY 1)
    SELECT p.page_id, CASE WHEN p.url LIKE '%/en/%' THEN NULL ELSE c.catalog_id END AS catalog_id FROM pages p LEFT JOIN c ON p.url = c.url""",
)
def c2(t):
    inputs = t.pages.select("page_id", F.concat(F.lit(" "), "url", F.lit("  ")).alias("u"))
    catalog = t.pages.filter(~F.col("url").contains("/en/")).select("url", F.col("page_id").alias("catalog_id"))
    out = L.lookup_by_url(inputs, catalog, "u", "url", ["catalog_id"])
    return out.select("page_id", F.col("catalog.catalog_id").alias("catalog_id"))


@query(
    "C3_lookup_multi_key",
    """WITH cat AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN lpad(CAST(c_custkey AS VARCHAR), 12, '0')
      WHEN 'HOUSEHOLD' THEN lpad(CAST(c_custkey AS VARCHAR), 13, '0') WHEN 'MACHINERY' THEN CAST(c_custkey AS VARCHAR)
      ELSE 'x' || c_custkey END AS k, c_name FROM customer)
    SELECT o_orderkey, CASE WHEN k LIKE 'x%' THEN NULL ELSE k END AS matched_key, CASE WHEN k LIKE 'x%' THEN NULL ELSE c_name END AS c_name
    FROM orders LEFT JOIN cat ON o_custkey = c_custkey""",
)
def c3(t):
    segment, key = F.col("c_mktsegment"), text("c_custkey")
    form = (
        F.when(segment == "BUILDING", F.lpad(key, 12, "0")).when(segment == "HOUSEHOLD", F.lpad(key, 13, "0"))
        .when(segment == "MACHINERY", key).otherwise(F.concat(F.lit("x"), key))
    )
    catalog = t.customer.select(form.alias("code"), "c_name")
    inputs = t.orders.select("o_orderkey", F.concat(F.lit("C-"), text("o_custkey")).alias("upc"))
    return L.lookup_multi_key(inputs, ["o_orderkey"], "upc", catalog, "code", "c_name").select("o_orderkey", "matched_key", "c_name")


@query(
    "C4_apply_overrides",
    """SELECT o_orderkey, CASE WHEN c_acctbal < 0 THEN '/fixed/' || c_custkey WHEN o_orderstatus = 'F' THEN '/found/' || o_orderkey END AS url
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def c4(t):
    found = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("/found/"), text("o_orderkey")))
    rows = t.orders.select("o_orderkey", F.col("o_custkey").alias("code"), found.alias("url"))
    kept = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("code"), F.concat(F.lit("/fixed/"), text("c_custkey")).alias("fixed"))
    return L.apply_overrides(rows, kept, "code", "fixed", "url").select("o_orderkey", "url")


@query(
    "C5_lookup_title",
    """WITH i AS (SELECT p_name || ' ' || p_brand AS title, min(p_partkey) AS k, arg_min(p_size, p_partkey) AS s FROM part WHERE p_type <> 'PROMO' GROUP BY 1)
    SELECT p_partkey, CASE WHEN s > 25 THEN 'https://portal.example/part/' || k ELSE 'https://other.example/' || k END AS matched_url
    FROM part LEFT JOIN i ON p_name || ' ' || p_brand = title""",
)
def c5(t):
    path = F.when(F.col("p_size") > 25, F.concat(F.lit("/part/"), text("p_partkey"))).otherwise(F.concat(F.lit("https://other.example/"), text("p_partkey")))
    index = t.part.filter("p_type <> 'PROMO'").select(F.concat("p_name", F.lit(" "), "p_brand").alias("title"), path.alias("url"), "p_partkey")
    title = L.color_title(F.col("p_name"), F.col("p_brand"))
    return L.lookup_title(t.part.select("p_partkey", "p_name", "p_brand"), index, title, ["p_partkey"], "https://portal.example").select("p_partkey", "matched_url")


def families(t):
    """Customers as items: parents, children of the first customers, orphans and single items."""
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    parent = F.when(balance < 0, None).when(key < 25, key).when(balance > 9000, -1).otherwise(F.col("c_nationkey"))
    return t.customer.select(key.alias("item_no"), parent.cast("double").alias("parent"), F.col("c_acctbal"), "c_mktsegment", "c_nationkey", key.alias("ord"))


FAMILIES = """i AS (SELECT c_custkey AS item_no, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_custkey < 25 THEN c_custkey WHEN c_acctbal > 9000 THEN -1
 ELSE c_nationkey END AS parent, * FROM customer),
 f AS (SELECT coalesce(parent, item_no) AS family, CASE WHEN parent IS NOT NULL AND parent <> item_no THEN 1 ELSE 0 END AS is_child, * FROM i),
 k AS (SELECT * FROM f WHERE family IN (SELECT item_no FROM i WHERE parent IS NULL OR parent = item_no)),
 pos AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY is_child, item_no) AS family_pos FROM k)"""


@query(
    "C10_family_join",
    f"""WITH {FAMILIES} SELECT item_no, family, family_pos FROM pos
    UNION ALL SELECT item_no, NULL, NULL FROM f WHERE family NOT IN (SELECT item_no FROM i WHERE parent IS NULL OR parent = item_no)""",
)
def c10(t):
    placed, orphans = L.family_join(families(t), "item_no", "parent", "ord")
    none = F.lit(None).cast("bigint")
    return placed.select("item_no", "family", "family_pos").unionByName(
        orphans.select("item_no", none.alias("family"), none.alias("family_pos"))
    )


def _altered(t):
    """Augmented rows: finished orders at double price, some twice, some unknown."""
    done = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lit("new").alias("note"), F.lit(1).alias("ord"))
    again = t.orders.filter("o_orderstatus = 'F' and o_orderpriority like '1%'").select(
        "o_orderkey", (F.col("o_totalprice") * 4).alias("o_totalprice"), F.lit("again").alias("note"), F.lit(2).alias("ord")
    )
    extra = t.orders.filter("o_orderpriority like '5%'").select((-F.col("o_orderkey") - 1).alias("o_orderkey"), "o_totalprice", F.lit("extra").alias("note"), F.lit(3).alias("ord"))
    return done.unionByName(again).unionByName(extra)


@query(
    "C11_merge_batches",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice WHEN o_orderpriority LIKE '1%' THEN o_totalprice * 4 ELSE o_totalprice * 2 END AS o_totalprice,
    CASE WHEN o_orderstatus <> 'F' THEN NULL WHEN o_orderpriority LIKE '1%' THEN 'again' ELSE 'new' END AS note, o_orderstatus = 'F' AS replaced FROM orders""",
)
def c11(t):
    merged = M.merge_batches(t.orders.select("o_orderkey", "o_totalprice"), _altered(t), "o_orderkey", ["ord"])
    return merged.select("o_orderkey", "o_totalprice", "note", "replaced")


@query(
    "C11_merge_report",
    """SELECT count(*) FILTER (o_orderstatus = 'F') AS replaced, count(*) FILTER (o_orderstatus <> 'F') AS not_found,
    count(*) FILTER (o_orderpriority LIKE '5%') AS extras, count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority LIKE '1%') AS duplicate_ids,
    CAST(0 AS BIGINT) AS missing_ids FROM orders""",
)
def c11_report(t):
    out = M.merge_report(t.orders.select("o_orderkey"), _altered(t), "o_orderkey")
    return out.select(*[big(F.col(c)).alias(c) for c in out.columns])


@query(
    "C12_patch_columns",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice WHEN o_orderpriority LIKE '1%' THEN o_totalprice * 4 ELSE o_totalprice * 2 END AS o_totalprice,
      o_custkey, CASE WHEN o_orderstatus <> 'F' THEN NULL WHEN o_orderpriority LIKE '1%' THEN 'again' ELSE 'new' END AS note,
      CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS overwrites, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS adds FROM orders
    UNION ALL SELECT -o_orderkey - 1, o_totalprice, NULL, 'extra', 0, 0 FROM orders WHERE o_orderpriority LIKE '5%'""",
)
def c12(t):
    original = t.orders.select("o_orderkey", "o_totalprice", "o_custkey", F.lit(0).alias("ord"))
    out = M.patch_columns(original, _altered(t), "o_orderkey", "ord", overwrite=["o_totalprice"], add=["note"], append_new=True)
    return out.drop("ord")


@query(
    "C13_skip_existing",
    """SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) THEN 'skipped' ELSE 'todo' END AS state FROM orders""",
)
def c13(t):
    rows = t.orders.select("o_orderkey", M.product_key(F.lit(""), F.col("o_custkey")).alias("key"))
    done = t.customer.filter("c_acctbal > 0").select(M.product_key(F.lit(None), F.col("c_custkey")).alias("key"))
    todo, skipped = M.skip_existing(rows, done, ["key"])
    return todo.select("o_orderkey", F.lit("todo").alias("state")).unionByName(skipped.select("o_orderkey", F.lit("skipped").alias("state")))


def variant_inputs(t):
    """Lines as paver variants: color = return flag, unit = line status (none for 'N' flags at small quantities)."""
    unit = F.when(~((F.col("rf") == "N") & (F.col("q") < 10)), F.col("ls"))
    return t.kept_lines.select(F.col("l_orderkey").alias("product"), big(F.col("l_linenumber")).alias("ord"), F.col("rf").alias("color"), unit.alias("unit"), "p", "q")


VARIANTS = LINES + """, v AS (SELECT l_orderkey AS product, CAST(l_linenumber AS BIGINT) AS ord, rf AS color,
 CASE WHEN rf = 'N' AND q < 10 THEN NULL ELSE ls END AS unit, p, q FROM lines),
 ex AS (SELECT product, color, unit, bool_or(complete) AS complete, arg_max(sku, ord) AS sku FROM (SELECT product, ord, color, unit, q > 30 AS complete, 'old' || p AS sku
   FROM v WHERE unit IS NOT NULL AND q > 20) GROUP BY 1, 2, 3),
 sk AS (SELECT v.*, v.unit IS NOT NULL AND coalesce(ex.complete, false) AS skip FROM v LEFT JOIN ex ON v.product = ex.product AND v.color = ex.color AND v.unit = ex.unit)"""


def existing_variants(t):
    rows = variant_inputs(t).filter("unit is not null and q > 20")
    return rows.select("product", "ord", "color", "unit", (F.col("q") > 30).alias("complete"), F.concat(F.lit("old"), text("p")).alias("sku"))


@query(
    "C13_skip_variants",
    f"""WITH {VARIANTS} SELECT product, ord, skip, bool_and(skip) OVER (PARTITION BY product) AS family_skipped FROM sk""",
)
def c13_variants(t):
    return M.skip_variants(variant_inputs(t), existing_variants(t), "product").select("product", "ord", "skip", "family_skipped")


@query(
    "C14_upsert",
    """SELECT o_orderkey, o_orderkey AS ord, CASE WHEN o_orderpriority LIKE '1%' THEN o_totalprice + 1 ELSE o_totalprice END AS price, o_orderstatus <> 'F' AS is_new
    FROM orders WHERE o_orderstatus = 'F' OR o_orderpriority LIKE '1%'""",
)
def c14(t):
    old = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", F.col("o_orderkey").alias("ord"), F.col("o_totalprice").alias("price"))
    new = t.orders.filter("o_orderpriority like '1%'").select("o_orderkey", F.col("o_orderkey").alias("ord"), (F.col("o_totalprice") + 1).alias("price"))
    return M.upsert(old, new, ["o_orderkey"], "ord")


@query(
    "C15_merge_variants",
    f"""WITH {VARIANTS},
    gen AS (SELECT product, color, unit, max(ord) AS ord, arg_max('new' || p, ord) AS sku FROM sk WHERE NOT skip AND unit IS NOT NULL GROUP BY 1, 2, 3),
    keyed AS (SELECT s.product, 0 AS stage, s.ord, CASE WHEN s.skip THEN 'existing' ELSE 'generated' END AS source, s.color, s.unit,
      CASE WHEN s.skip THEN ex.sku ELSE gen.sku END AS sku FROM sk s LEFT JOIN ex USING (product, color, unit) LEFT JOIN gen USING (product, color, unit) WHERE s.unit IS NOT NULL),
    exo AS (SELECT product, color, unit, max(ord) AS ord FROM v WHERE unit IS NOT NULL AND q > 20 GROUP BY 1, 2, 3),
    spare AS (SELECT *, row_number() OVER (PARTITION BY product, color ORDER BY tier, rank, unit) AS slot FROM (
      SELECT product, color, unit, 'generated' AS source, sku, ord AS rank, 0 AS tier FROM gen
      UNION ALL SELECT product, color, unit, 'existing', sku, exo.ord, 1 FROM ex JOIN exo USING (product, color, unit)) z
      WHERE NOT EXISTS (SELECT 1 FROM keyed k WHERE k.product = z.product AND k.color = z.color AND k.unit = z.unit AND k.source = z.source)),
    less AS (SELECT product, ord, color, row_number() OVER (PARTITION BY product, color ORDER BY ord) AS slot FROM v WHERE unit IS NULL),
    every AS (SELECT * FROM keyed UNION ALL SELECT l.product, 0, l.ord, s.source, s.color, s.unit, s.sku FROM less l JOIN spare s USING (product, color, slot))
    SELECT product, row_number() OVER (PARTITION BY product ORDER BY stage, ord, color, unit) AS position, source, color, unit, sku FROM every""",
)
def c15(t):
    inputs = M.skip_variants(variant_inputs(t), existing_variants(t), "product")
    fresh = inputs.filter("not skip and unit is not null").select("product", "ord", "color", "unit", F.concat(F.lit("new"), text("p")).alias("sku"))
    return M.merge_variants(inputs.select("product", "ord", "color", "unit", "skip"), existing_variants(t), fresh, "product")


def _color_categories(t):
    names = t.part.select(F.col("p_name").alias("raw"), F.lit("x").alias("ord")).distinct()
    slashed = names.filter("raw like 'blue%'").select(F.replace("raw", F.lit(" "), F.lit("/")).alias("color"), F.lit("PREMIER COLORS").alias("category"), "ord")
    spaced = names.filter("raw like 'red%'").select(F.concat(F.lit(" "), F.upper("raw")).alias("color"), F.lit("COLOR PLUS").alias("category"), "ord")
    plain = names.filter("raw like 'small%'").select(F.col("raw").alias("color"), F.lit("STANDARD COLORS").alias("category"), "ord")
    return slashed.unionByName(spaced).unionByName(plain)


def _colored_products(t):
    kind = F.when(F.col("p_type") == "PROMO", "paving_stone").when(F.col("p_type") == "SMALL", "wall_stone").otherwise("other")
    name = F.col("p_name")
    return t.part.select(
        F.col("p_partkey").alias("order_index"), kind.alias("product_type"),
        F.array(name, F.concat(F.replace(name, F.lit(" "), F.lit("/")))).alias("colors"),
    )


_MAPPED = """m AS (SELECT p_partkey AS order_index, CASE p_type WHEN 'PROMO' THEN 'Paving Stones' WHEN 'SMALL' THEN 'Wall Stones' ELSE 'Unknown' END AS vendor_type,
 c AS color, CASE WHEN c LIKE 'blue%' THEN 'PREMIER COLORS' WHEN c LIKE 'red%' THEN 'COLOR PLUS' WHEN c LIKE 'small%' THEN 'STANDARD COLORS' END AS category
 FROM (SELECT p_partkey, p_type, unnest([p_name, replace(p_name, ' ', '/')]) AS c FROM part))"""


@query(
    "C16_map_color_category",
    f"""WITH {_MAPPED} SELECT order_index, vendor_type, color, category,
    CASE category WHEN 'STANDARD COLORS' THEN 0 WHEN 'COLOR PLUS' THEN 1 ELSE 2 END AS category_rank FROM m WHERE category IS NOT NULL""",
)
def c16(t):
    out = L.map_color_category(_colored_products(t), _color_categories(t), ["ord"], fixed.COLOR_CATEGORY_ORDER)
    return out.select("order_index", "vendor_type", "color", "category", "category_rank").orderBy("vendor_type", "order_index", "category_rank", "color")


@query("C17_unmapped_colors", f"WITH {_MAPPED} SELECT DISTINCT color FROM m WHERE category IS NULL")
def c17(t):
    return L.unmapped_colors(_colored_products(t), _color_categories(t), ["ord"]).orderBy("color")


@query(
    "C18_gallery_by_color",
    f"""WITH {LINES}, v AS (SELECT l_orderkey AS product, 'T' || l_orderkey AS title, l_linenumber AS ord, rf AS color, CASE WHEN q >= 5 THEN ls END AS unit, p, s FROM lines),
    col AS (SELECT product, color, min(ord) AS color_ord, arg_max(unit, ord) FILTER (unit IS NOT NULL) AS unit, arg_min(title, ord) AS title FROM v GROUP BY 1, 2 HAVING count(unit) > 0),
    own AS (SELECT product, color, url, row_number() OVER (PARTITION BY product, color ORDER BY ord, lower(url)) AS counter FROM (
      SELECT product, color, 'Img/' || p AS url, min(ord) AS ord FROM v GROUP BY 1, 2, 3)),
    pub AS (SELECT product, CASE WHEN ord = 1 THEN 1 ELSE 2 END AS kind, ord, CASE WHEN s > 50 THEN 'IMG/' || p ELSE 'pub/' || s END AS url FROM v),
    shr AS (SELECT product, low, first(kind ORDER BY kind, ord) AS kind, first(ord ORDER BY kind, ord) AS ord, first(url ORDER BY kind, ord) AS url
      FROM (SELECT *, lower(url) AS low FROM pub) GROUP BY 1, 2),
    shn AS (SELECT *, row_number() OVER (PARTITION BY product, kind ORDER BY ord, low) AS counter FROM shr
      WHERE NOT EXISTS (SELECT 1 FROM own WHERE own.product = shr.product AND lower(own.url) = shr.low)),
    every AS (SELECT o.product, o.url, 0 AS kind, o.counter, c.color_ord, c.color, c.unit, c.title FROM own o JOIN col c ON o.product = c.product AND o.color = c.color
      UNION ALL SELECT h.product, h.url, h.kind, h.counter, c.color_ord, c.color, c.unit, c.title FROM shn h JOIN col c ON h.product = c.product)
    SELECT product, row_number() OVER (PARTITION BY product ORDER BY color_ord, kind, counter) AS position, url AS src,
      title || ' - ' || CASE kind WHEN 0 THEN 'Product Image ' || counter WHEN 1 THEN 'Hero' ELSE 'Lifestyle ' || counter END || ' #' || color || '#' || unit AS alt FROM every""",
)
def c18(t):
    v = t.kept_lines.select(
        F.col("l_orderkey").alias("product"), F.concat(F.lit("T"), text("l_orderkey")).alias("title"), F.col("l_linenumber").alias("ord"),
        F.col("rf").alias("color"), F.when(F.col("q") >= 5, F.col("ls")).alias("unit"), "p", "s",
    )
    portal = v.select("product", "color", "ord", F.concat(F.lit("Img/"), text("p"), F.lit("?v=1")).alias("url"))
    url = F.when(F.col("s") > 50, F.concat(F.lit("IMG/"), text("p"))).otherwise(F.concat(F.lit("pub/"), text("s")))
    public = v.select("product", F.when(F.col("ord") == 1, "hero").otherwise("lifestyle").alias("kind"), "ord", url.alias("url"))
    return L.gallery_by_color(v, portal, public, "product", "title")


@query(
    "C19_variant_image_lookup",
    f"""WITH {LINES}, x AS (SELECT l_orderkey AS product, l_linenumber AS position, rf AS o1, CASE WHEN q > 25 THEN ls ELSE '' END AS o2 FROM lines),
    m AS (SELECT l_orderkey AS product, lower(rf || CASE WHEN q > 40 THEN '|' || ls WHEN q > 20 THEN '|EA|None' ELSE '' END) AS k, min(l_linenumber) * 100 AS image_id FROM lines GROUP BY 1, 2),
    c AS (SELECT product, position, unnest(CASE WHEN o2 = '' THEN [o1, o1 || '|EA|None', o1 || '|EA|', o1 || '|EA'] ELSE [o1 || '|' || o2, o1] END) AS k,
      unnest(CASE WHEN o2 = '' THEN [1, 2, 3, 4] ELSE [1, 2] END) AS pri FROM x),
    h AS (SELECT c.product, c.position, arg_min(m.image_id, pri) AS image_id FROM c JOIN m ON c.product = m.product AND lower(c.k) = m.k GROUP BY 1, 2)
    SELECT x.product, x.position, coalesce(h.image_id, x.position) AS image_id FROM x LEFT JOIN h ON x.product = h.product AND x.position = h.position""",
)
def c19(t):
    lines = t.lines()
    variants = lines.select(
        F.col("l_orderkey").alias("product"), F.col("l_linenumber").alias("position"), F.col("rf").alias("option1"),
        F.when(F.col("q") > 25, F.col("ls")).otherwise("").alias("option2"), F.lit("").alias("option3"),
    )
    key = F.concat("rf", F.when(F.col("q") > 40, F.concat(F.lit("|"), "ls")).when(F.col("q") > 20, "|EA|None").otherwise(""))
    images = lines.groupBy(F.col("l_orderkey").alias("product"), key.alias("key")).agg((F.min("l_linenumber") * 100).alias("image_position"))
    return L.variant_image_lookup(variants, images, "product", ["product", "position"], "position").select("product", "position", "image_id")


def swatch_pages(t):
    """One configuration blob per order: attribute 1 is the style, children are parts."""
    lines = t.lines()
    # one order is one document, as long as it has lines
    option = F.struct(F.col("s").cast("string").alias("id"), F.concat("rf", F.lit(" "), "ls").alias("label"), F.array(text("p")).alias("products"))
    options = lines.groupBy("l_orderkey").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", option.alias("o")))), lambda x: x["o"]).alias("options"),
        F.array_distinct(F.collect_list(text("p"))).alias("children"),
    )
    attributes = F.create_map(F.lit("1"), F.struct(F.lit("Style").alias("code"), F.col("options")))
    images = F.map_from_entries(F.transform("children", lambda c: F.struct(c, F.array(F.concat(F.lit("/i/"), c)))))
    config = F.struct(F.struct(attributes.alias("attributes"), images.alias("images")).alias("jsonConfig"))
    blob = F.to_json(F.create_map(F.lit("[data-role=swatch]"), F.create_map(F.lit(L.SWATCH_WIDGET), config)))
    return options.select(F.col("l_orderkey").alias("page"), blob.alias("blob"))


@query(
    "C20_swatch_index",
    f"""WITH {LINES} SELECT l_orderkey AS page, CAST(s AS VARCHAR) AS option_id, rf || ' ' || ls AS label, CAST(p AS VARCHAR) AS child, '/i/' || p AS media,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS INTEGER) AS option_pos FROM lines""",
)
def c20(t):
    pages = swatch_pages(t)
    options = L.swatch_options(pages, "page", "blob").filter("is_style").select("page", "option_id", "label", "child", "option_pos")
    media = L.swatch_media(pages, "page", "blob").filter("pos = 0").select("page", "child", F.col("item").alias("media"))
    return options.join(media, ["page", "child"], "left")


@query(
    "C20_swatch_labels",
    f"WITH {LINES} SELECT DISTINCT l_orderkey AS page, CAST(p AS VARCHAR) AS child, rf || ' ' || ls AS label FROM lines",
)
def c20_labels(t):
    return L.swatch_labels(swatch_pages(t), "page", "blob")


@query(
    "C22_merge_second_source",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'a' ELSE '' END || CASE WHEN c_acctbal > 0 THEN CASE o_orderstatus WHEN 'F' THEN ',' ELSE '' END || c_mktsegment ELSE '' END AS documents,
    CASE WHEN o_orderpriority LIKE '1%' THEN 'own.jpg' WHEN c_acctbal > 0 AND c_nationkey > 5 THEN c_name || '.jpg' ELSE '' END AS images
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def c22(t):
    none = F.array().cast("array<string>")
    image = F.struct(F.lit(1).cast("bigint").alias("position"), F.lit("own.jpg").alias("src"), F.lit("x").alias("alt"))
    products = t.orders.select(
        "o_orderkey", F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("title"),
        F.when(F.col("o_orderstatus") == "F", F.array(F.lit("a"))).otherwise(none).alias("documents"),
        F.when(F.col("o_orderpriority").startswith("1"), F.array(image)).alias("images"),
    )
    extra = t.customer.filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("key"), F.array("c_mktsegment").alias("documents"),
        F.when(F.col("c_nationkey") > 5, F.array(F.concat("c_name", F.lit(".jpg")))).otherwise(none).alias("gallery_images"),
    )
    out = L.merge_second_source(products, extra, ["key"])
    sources = F.array_join(F.transform(F.col("images"), lambda i: i["src"]), ",")
    return out.select("o_orderkey", F.array_join("documents", ",").alias("documents"), F.coalesce(sources, F.lit("")).alias("images"))


@query(
    "C23_fallback_route",
    """SELECT event_id, CASE WHEN event_type NOT IN ('purchase', 'click') THEN 'unmatched' WHEN value < 5 OR value > 20 THEN 'error' ELSE 'fallback' END AS route,
    CASE WHEN event_type NOT IN ('purchase', 'click') THEN 'No manufacturer match and no lookup data' WHEN value < 5 THEN 'No lookup images available'
      WHEN value > 20 THEN 'No suitable lookup images (failed quality check)' END AS reason FROM events""",
)
def c23(t):
    status = F.when(F.col("event_type").isin("purchase", "click"), "Match found").when(F.col("event_type") == "error", "Lookup failed")
    listed = F.when(F.col("value") < 5, "[]").otherwise(F.concat(F.lit("['a/"), text("event_id"), F.lit("', 'b']")))
    route = L.fallback_route(status, F.size(L.listed_urls(listed)), F.col("value") <= 20)
    return t.events.select("event_id", route.alias("r")).select("event_id", "r.route", "r.reason")


@query(
    "C23_fallback_parsed",
    """SELECT o_orderkey, 'Item ' || o_orderkey AS title, coalesce(nullif(o_orderstatus, 'P'), '') AS description, '/i/' || o_custkey AS images FROM orders WHERE o_orderpriority LIKE '1%'""",
)
def c23_parsed(t):
    rows = t.orders.select(
        "o_orderkey", F.concat(F.lit("Item "), text("o_orderkey")).alias("description_1"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("upcitemdb_description"),
    )
    best = t.orders.filter("o_orderpriority like '1%'").select("o_orderkey", F.concat(F.lit("/i/"), text("o_custkey")).alias("url"))
    parsed = L.fallback_parsed(rows, best, "o_orderkey", "Maker")
    return parsed.select("o_orderkey", "title", "description", F.array_join("gallery_images", " ").alias("images"))


@query(
    "C24_dedupe_across_sources",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'shop' ELSE 'www' END AS site, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS source_rank
    FROM orders WHERE o_orderstatus = 'F' OR o_orderpriority LIKE '1%'""",
)
def c24(t):
    first = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", F.lit("shop").alias("site"))
    second = t.orders.filter("o_orderpriority like '1%'").select("o_orderkey", F.lit("www").alias("site"))
    return L.dedupe_across_sources(first, second, ["o_orderkey"])
