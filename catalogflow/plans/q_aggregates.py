"""Grouping operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import soft_key
from ..operators import aggregate as A
from ..operators.order import sku_base
from .registry import LINES, big, query, text

_ROW = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(
    "D1_last_wins",
    """SELECT l_orderkey, r.a AS l_linenumber, r.b AS l_partkey, r.c AS l_suppkey, r.d AS l_extendedprice FROM (
      SELECT l_orderkey, max({'a': l_linenumber, 'b': l_partkey, 'c': l_suppkey, 'd': l_extendedprice}) AS r FROM lineitem GROUP BY 1)""",
)
def d1(t):
    return A.last_wins(t.lineitem.select("l_orderkey", *_ROW), ["l_orderkey"], _ROW)


@query(
    "D2_first_wins",
    """SELECT l_orderkey, r.a AS l_linenumber, r.b AS l_partkey, r.c AS l_suppkey, r.d AS l_extendedprice FROM (
      SELECT l_orderkey, min({'a': l_linenumber, 'b': l_partkey, 'c': l_suppkey, 'd': l_extendedprice}) AS r FROM lineitem GROUP BY 1)""",
)
def d2(t):
    return A.first_wins(t.lineitem.select("l_orderkey", *_ROW), ["l_orderkey"], _ROW)


@query(
    "D3_group_families",
    """SELECT p_partkey, p_name AS family, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS member_pos,
    min(p_partkey) OVER (PARTITION BY p_name) AS family_first FROM part WHERE p_type <> 'PROMO'""",
)
def d3(t):
    title = F.when(F.col("p_type") == "PROMO", " ").otherwise(F.concat("p_name", F.lit("  ")))
    rows = A.group_families(t.part.select("p_partkey", title.alias("title")), "title", ["p_partkey"])
    return rows.select("p_partkey", "family", "member_pos", F.col("family_first.p_partkey").alias("family_first"))


@query(
    "D4_id_quality",
    """WITH e AS (SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE user_id END AS id, event_id FROM events),
    f AS (SELECT id, event_id, min(event_id) OVER (PARTITION BY id) AS first_position FROM e WHERE id IS NOT NULL)
    SELECT CAST(id AS VARCHAR) AS id, first_position, event_id AS position FROM f WHERE event_id > first_position
    UNION ALL SELECT NULL, NULL, event_id FROM e WHERE id IS NULL""",
)
def d4(t):
    events = t.events.select(F.when(F.col("event_type") != "signup", F.col("user_id")).alias("id"), "event_id")
    missing, later = A.id_quality(events, "id", "event_id")
    return later.unionByName(
        missing.select(F.lit(None).cast("string").alias("id"), F.lit(None).cast("bigint").alias("first_position"), F.col("event_id").alias("position"))
    )


@query(
    "D4_duplicate_ids",
    "SELECT o_custkey AS id, min(o_orderkey) AS first_position, max(o_orderkey) AS last_position, count(*) AS uses FROM orders GROUP BY 1 HAVING count(*) > 1",
)
def d4_duplicates(t):
    return A.duplicate_ids(t.orders, "o_custkey", "o_orderkey")


_OPTIONS = LINES + """, o AS (SELECT l_orderkey AS family, 1 AS slot, 'Color' AS name, rf AS value, min(l_linenumber) AS o FROM lines GROUP BY 1, 4
 UNION ALL SELECT l_orderkey, 2, 'Unit Of Sale', ls, min(l_linenumber) FROM lines WHERE q > 10 GROUP BY 1, 4),
 op AS (SELECT *, row_number() OVER (PARTITION BY family, slot ORDER BY o, value) AS value_pos FROM o)"""


def _option_rows(t):
    slots = [
        (1, A.option_title(F.lit("color")), F.col("rf")),
        (2, A.option_title(F.lit("unit_of_sale")), F.when(F.col("q") > 10, F.col("ls"))),
    ]
    return t.lines().withColumnRenamed("l_orderkey", "family"), slots


@query("D5_product_options", f"WITH {_OPTIONS} SELECT family, slot, name, string_agg(value, ',' ORDER BY value_pos) AS vals FROM op GROUP BY 1, 2, 3")
def d5(t):
    rows, slots = _option_rows(t)
    out = A.product_options(rows, "family", "l_linenumber", slots)
    return out.select("family", "slot", "name", F.array_join("values", ",").alias("vals"))


@query("D5_option_values", f"WITH {_OPTIONS} SELECT family, slot, name, value, value_pos FROM op")
def d5_long(t):
    rows, slots = _option_rows(t)
    return A.option_values(rows, "family", "l_linenumber", slots)


@query(
    "D6_missing_report",
    """WITH m AS (SELECT p_name AS product, unnest(list_filter([CASE WHEN l_tax = 0 THEN 'weight' END, CASE WHEN l_discount = 0 THEN 'cost' END,
      CASE WHEN l_returnflag = 'A' THEN 'model_number' END, CASE WHEN l_linestatus = 'O' THEN 'color_swatch' END], lambda x: x IS NOT NULL)) AS field
      FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT product, field, count(*) AS n, CAST(GROUPING(product) * 2 + GROUPING(field) AS INTEGER) AS level FROM m GROUP BY ROLLUP (product, field)""",
)
def d6(t):
    fields = F.array(
        F.struct(F.lit("model_number").alias("key"), F.when(F.col("l_returnflag") != "A", "m").otherwise("").alias("value")),
        F.struct(F.lit("color_swatch_image").alias("key"), F.when(F.col("l_linestatus") != "O", "s").alias("value")),
    )
    cost = F.when(F.col("l_discount") == 0, "0").otherwise("5")
    lines = t.lineitem.withColumn("metafields", fields)
    missing = A.missing_fields(
        F.col("l_tax"), cost, A.metafield(F.col("metafields"), "model_number"), A.metafield(F.col("metafields"), "color_swatch_image")
    )
    variants = lines.select("l_partkey", missing.alias("missing")).join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("product")), "l_partkey"
    )
    return A.missing_report(variants, "product")


@query(
    "D6_product_gaps",
    """SELECT count(*) AS products, count(*) FILTER (p_size > 40) AS without_images, count(*) FILTER (p_type = 'PROMO') AS without_description FROM part""",
)
def d6_products(t):
    none = F.array().cast("array<string>")
    rows = t.part.select(
        F.when(F.col("p_size") > 40, none).otherwise(F.array("p_name")).alias("images"), F.when(F.col("p_type") == "PROMO", " \n").otherwise("d").alias("description")
    )
    return A.product_gaps(rows, "images", "description")


@query(
    "D7_run_summary",
    """WITH o AS (SELECT CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped' ELSE 'ok' END AS status,
      CASE WHEN event_type = 'error' THEN CASE WHEN value > 10 THEN 'no page' ELSE 'no title' END ELSE '' END AS reason FROM events)
    SELECT status, reason, count(*) AS n, CAST(GROUPING(status) * 2 + GROUPING(reason) AS INTEGER) AS level FROM o GROUP BY ROLLUP (status, reason)""",
)
def d7(t):
    kind = F.col("event_type")
    status = F.when(kind == "error", "failed").when(kind == "signup", "skipped").otherwise("ok")
    reason = F.when(kind == "error", F.when(F.col("value") > 10, "no page").otherwise("no title")).otherwise("")
    return A.run_summary(t.events.select(status.alias("status"), reason.alias("reason")), "status", "reason")


@query("D8_bucket_manifest", "SELECT source || ' ' || lang AS key, count(*) AS n FROM documents GROUP BY 1")
def d8(t):
    return A.bucket_manifest(t.documents, soft_key(F.concat_ws(" ", F.upper("source"), F.upper("lang"))))


@query(
    "D9_array_lengths",
    """SELECT CAST((SELECT max(len(embedding)) FROM embeddings) AS INTEGER) AS embedding, CAST(max(len(string_split(text, ' '))) AS INTEGER) AS words FROM documents""",
)
def d9(t):
    words = A.array_lengths(t.documents.select(F.split("text", " ").alias("words")))
    return words.withColumn("embedding", A.array_lengths(t.embeddings.select("embedding")).scalar()).select("embedding", "words")


_IMAGES = LINES + """, u AS (SELECT l_orderkey AS product, l_linenumber AS ord, rf || '|' || ls AS key, CAST(q AS BIGINT) % 4 AS position, CASE WHEN q > 10 THEN 'v' || p END AS src FROM lines),
 im AS (SELECT product, position, arg_min(src, ord) AS src, 'image' AS media_type, string_agg(key, ',' ORDER BY ord) AS variant_keys FROM u WHERE src IS NOT NULL GROUP BY 1, 2),
 md AS (SELECT l_orderkey AS product, l_linenumber AS ord, l_linenumber % 5 AS position, CASE WHEN s > 50 THEN 'video' ELSE 'image' END AS media_type, 'm' || s AS src FROM lines),
 fr AS (SELECT product, position, arg_min(src, ord) AS src, arg_min(media_type, ord) AS media_type, '' AS variant_keys FROM md
   WHERE NOT EXISTS (SELECT 1 FROM im WHERE im.product = md.product AND im.position = md.position) GROUP BY 1, 2)"""


@query("D10_variant_image_map", f"WITH {_IMAGES} SELECT product, CAST(position AS BIGINT) AS position, src, media_type, variant_keys FROM im UNION ALL SELECT product, position, src, media_type, variant_keys FROM fr")
def d10(t):
    lines = t.lines()
    src = F.when(F.col("q") > 10, F.concat(F.lit("v"), text("p")))
    variants = lines.select(
        F.col("l_orderkey").alias("product"), F.col("l_linenumber").alias("ord"), F.concat("rf", F.lit("|"), "ls").alias("key"),
        (big(F.col("q")) % 4).alias("position"), src.alias("src"), F.lit("").alias("alt"),
    )
    media = lines.select(
        F.col("l_orderkey").alias("product"), F.col("l_linenumber").alias("ord"), (big(F.col("l_linenumber")) % 5).alias("position"),
        F.when(F.col("s") > 50, "video").otherwise("image").alias("media_type"), F.concat(F.lit("m"), text("s")).alias("src"), F.lit("").alias("alt"),
    )
    out = A.variant_image_map(variants, media, "product")
    return out.select("product", "position", "src", "media_type", F.array_join("variant_keys", ",").alias("variant_keys"))


@query(
    "D11_sku_stats",
    """SELECT count(DISTINCT s) AS used_count, greatest(50000, max(TRY_CAST(s AS BIGINT)) + 1) AS next_auto_sku
    FROM (SELECT CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey + 45000 AS VARCHAR) ELSE 'x' || o_orderkey END AS s FROM orders)""",
)
def d11(t):
    sku = F.when(F.col("o_orderstatus") == "F", (F.col("o_orderkey") + 45000).cast("string")).otherwise(F.concat(F.lit("x"), text("o_orderkey")))
    return sku_base(t.orders.select(sku.alias("sku")), 50000)


@query(
    "D12_upc_consensus",
    f"""WITH {LINES}, c AS (SELECT l_orderkey, lpad(CAST(p AS VARCHAR), 12, '0') AS code FROM lines WHERE q > 20 GROUP BY 1, 2),
    n AS (SELECT l_orderkey, count(*) AS n, min(code) AS code FROM c GROUP BY 1)
    SELECT DISTINCT l.l_orderkey, coalesce(n.n, 0) AS n_codes, CASE WHEN n.n = 1 THEN n.code END AS upc,
      'MAKER-' || CASE WHEN n.n = 1 THEN n.code ELSE 'ORDER-NO-' || l.l_orderkey END AS product_key FROM lines l LEFT JOIN n ON l.l_orderkey = n.l_orderkey""",
)
def d12(t):
    url = F.concat(F.lit("https://cdn.example/"), F.when(F.col("q") > 20, F.concat(F.lit("0"), F.lpad(text("p"), 12, "0"))).otherwise(text("p")), F.lit(".jpg"))
    name = F.concat(F.lit("Order No "), text("l_orderkey"))
    return A.upc_consensus(t.lines(), ["l_orderkey"], A.url_codes(url), name, "MAKER")


@query(
    "D13_log_missing_summary",
    """SELECT DISTINCT conv_id, role AS color, item FROM (SELECT conv_id, role, unnest(list_filter([CASE WHEN contains(text, 'the') THEN 'Weight' END,
      CASE WHEN contains(text, 'de') THEN 'Cost' END], lambda x: x IS NOT NULL)) AS item FROM conversations)""",
)
def d13(t):
    found = F.array_compact(F.array(F.when(F.col("text").contains("the"), F.lit("Weight")), F.when(F.col("text").contains("de"), F.lit("Cost"))))
    lines = t.conversations.select("conv_id", F.col("role").alias("color"), F.explode(found).alias("hit"))
    return A.log_missing_summary(lines, "conv_id", "color", F.col("hit")).select("conv_id", "color", "item")
