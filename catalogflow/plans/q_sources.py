"""Sources and sinks over the driver tables."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators.order import distributed_sequence, nest, split_batches
from ..session import new_shared_path
from ..sources import records as R
from .registry import LINES, big, query, text


@query("A1_read_records", "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages")
def a1(t):
    path = new_shared_path(t.spark, "a1")
    t.pages.write.json(path)
    back = R.read_records(t.spark, path, "page_id bigint, url string, html string", fix_nan=True)
    return back.select("page_id", "url", big(F.length("html")).alias("n_chars"))


@query("A1_read_array", "SELECT doc_id, source, CAST(length(text) AS BIGINT) AS n_chars, md5(text) AS digest FROM documents WHERE text IS NOT NULL")
def a1_array(t):
    """All documents as JSON arrays of 400 in files of their own, read back in byte ranges."""
    path = new_shared_path(t.spark, "a1")
    rows = t.documents.filter("text IS NOT NULL").select("doc_id", "source", "text", F.floor(F.col("doc_id") / 400).alias("p"))
    own = Window.partitionBy("p").orderBy("doc_id", "source", "text")
    ends = F.when(F.lead(F.lit(1)).over(own).isNull(), " ]")
    line = F.concat(F.when(F.row_number().over(own) == 1, "[ ").otherwise(""), F.to_json(F.struct("doc_id", "source", "text")), ends.otherwise(","))
    placed = rows.select("p", "doc_id", "source", "text", line.alias("value")).sortWithinPartitions("p", "doc_id", "source", "text")  # as the window left them
    placed.select("p", "value").write.partitionBy("p").text(path)
    back = R.read_records(t.spark, path, "doc_id bigint, source string, text string", ndjson=False)
    return back.select("doc_id", "source", big(F.length("text")).alias("n_chars"), F.md5("text").alias("digest"))


@query(
    "A2_normalize_input",
    """WITH p AS (SELECT event_id, event_type, replace(props, ' ', '') AS j FROM events)
    SELECT event_id, CAST(0 AS INTEGER) AS index, j AS record FROM p WHERE event_type = 'view'
    UNION ALL SELECT event_id, CAST(i AS INTEGER), j FROM p, (SELECT unnest([0, 1]) AS i) WHERE event_type IN ('click', 'purchase')
    UNION ALL SELECT event_id, CAST(i AS INTEGER), '{"value":' || CASE i WHEN 0 THEN '"a"' ELSE '7' END || ',"index":' || i || '}'
      FROM p, (SELECT unnest([0, 1]) AS i) WHERE event_type = 'error'
    UNION ALL SELECT event_id, CAST(0 AS INTEGER), '{"a":[' || j || '],"b":[' || j || ']}' FROM p WHERE event_type = 'signup'""",
)
def a2(t):
    props, kind = F.col("props"), F.col("event_type")
    pair = F.concat(F.lit("["), props, F.lit(", "), props, F.lit("]"))
    doc = (
        F.when(kind == "click", pair)
        .when(kind == "purchase", F.concat(F.lit('{"n": 1, "rows": '), pair, F.lit("}")))
        .when(kind == "error", F.lit('["a", 7]'))
        .when(kind == "signup", F.concat(F.lit('{"a": ['), props, F.lit('], "b": ['), props, F.lit("]}")))
        .otherwise(props)
    )
    return R.normalize_input(t.events.select("event_id", doc.alias("doc")), "doc")


@query(
    "A3_read_table",
    """SELECT CASE WHEN p_size < 5 THEN NULL ELSE lpad(CAST(p_partkey AS VARCHAR), 12, '0') END AS upc, p_name AS name,
    CASE WHEN p_size > 40 THEN '' ELSE p_type END AS kind FROM part""",
)
def a3(t):
    path = new_shared_path(t.spark, "a3")
    code = F.when(F.col("p_size") < 5, "nan").otherwise(F.concat(F.lit(" "), text("p_partkey"), F.lit("-")))
    t.part.select(
        code.alias("upc"), F.col("p_name").alias("name"), F.when(F.col("p_size") <= 40, F.col("p_type")).alias("kind")
    ).write.option("header", True).csv(path)
    return R.read_table(t.spark, path, upc_columns=["upc"])


@query(
    "A4_read_catalog",
    """SELECT trim(p_name) || '-' || p_brand AS upc, max_by('/p/' || p_partkey, p_partkey) AS url FROM part GROUP BY 1""",
)
def a4(t):
    rows = t.part.select(
        F.floor(F.col("p_partkey") / 1000).alias("doc"), "p_partkey",
        F.concat("p_name", F.lit("-"), "p_brand").alias("upc"), F.concat(F.lit(" /p/"), text("p_partkey")).alias("url"),
    )
    docs = nest(rows, ["doc"], ["p_partkey"], F.struct("upc", "url"), "items")
    return R.catalog_entries(docs.select(F.struct("doc", "part").alias("file"), F.to_json("items").alias("value")))


@query(
    "A5_write_records",
    "SELECT event_id, event_type, props FROM events",
)
def a5(t):
    plain, table = new_shared_path(t.spark, "a5"), new_shared_path(t.spark, "a5v")
    R.write_records(t.events.select("event_id", "event_type", "props"), plain)
    R.write_version(R.read_records(t.spark, plain, "event_id bigint, event_type string, props string"), table)
    # replace the table while it is being read
    R.write_version(R.read_version(t.spark, table), table)
    return R.read_version(t.spark, table)


@query(
    "A6_split_batches",
    """SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 50 + 1 AS batch,
    lpad(CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 50 + 1 AS VARCHAR),
      greatest(3, CAST(length(CAST(CAST(ceil((SELECT count(*) FROM orders) / 50.0) AS BIGINT) AS VARCHAR)) AS INTEGER)), '0') AS batch_label
    FROM orders""",
)
def a6(t):
    return split_batches(t.orders.select("o_orderkey"), 50, ["o_orderkey"])


@query(
    "A7_read_batches",
    "SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) - 1 AS seq FROM orders",
)
def a7(t):
    path = new_shared_path(t.spark, "a7")
    R.write_batches(t.orders.select("o_orderkey", "o_orderstatus"), path, 5000, ["o_orderkey"])
    back = R.read_batches(t.spark, path, "o_orderkey bigint, o_orderstatus string")
    return distributed_sequence(back, ["file", "pos"]).drop("file", "pos")


@query(
    "A8_split_by_key",
    """WITH k AS (SELECT CASE WHEN lang = 'es' THEN '_missing' ELSE lower(source) END AS b, doc_id FROM documents),
    c AS (SELECT b, count(*) AS n FROM k GROUP BY 1 HAVING count(*) >= 3),
    r AS (SELECT k.b, (row_number() OVER (PARTITION BY k.b ORDER BY doc_id) - 1) // 10 + 1 AS part, n FROM k JOIN c USING (b)),
    g AS (SELECT b, part, max(n) AS n, count(*) AS cnt FROM r GROUP BY 1, 2)
    SELECT b AS key, cnt AS "count", 'key=' || CASE b WHEN '_missing' THEN 'missing' ELSE b END || '_part='
      || lpad(CAST(part AS VARCHAR), greatest(3, CAST(length(CAST((n + 9) // 10 AS VARCHAR)) AS INTEGER)), '0') || '_count=' || cnt || '.json' AS file
    FROM g""",
)
def a8(t):
    docs = t.documents.select("doc_id", F.when(F.col("lang") != "es", F.upper("source")).alias("source"))
    return R.split_manifest(R.split_by_key(docs, "source", ["doc_id"], min_bucket=3, max_per_file=10))


_DIMS = 64


@query(
    "A9_flatten_wide",
    "SELECT vec_id, label, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS embedding_{i}" for i in range(_DIMS)) + " FROM embeddings",
)
def a9(t):
    wide = R.flatten_wide(t.embeddings, "vec_id")
    return wide.select("vec_id", "label", *[F.col(c).cast("double").alias(c) for c in wide.columns if c.startswith("embedding_")])


@query("A10_flatten_dotted", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events")
def a10(t):
    nested = t.events.select("event_id", F.struct(F.from_json("props", "k bigint").alias("data")).alias("props"))
    return R.flatten_dotted(nested).withColumnRenamed("props.data.k", "props_k")


@query("A11_discover_keys", "SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY 1")
def a11(t):
    return R.discover_keys(t.events, "props")


@query(
    "A12_route_outputs",
    """SELECT 'products' AS output, event_id, NULL AS error_reason FROM events WHERE event_type NOT IN ('error', 'signup')
    UNION ALL SELECT 'unmatched', event_id, 'no match' FROM events WHERE event_type = 'signup'
    UNION ALL SELECT 'errors', event_id, CASE event_type WHEN 'signup' THEN 'no match' ELSE 'failed' END FROM events
      WHERE event_type IN ('error', 'signup')""",
)
def a12(t):
    kind = F.col("event_type")
    status = F.when(kind == "error", "error").when(kind == "signup", "unmatched").otherwise("ok")
    reason = F.when(kind == "error", "failed").when(kind == "signup", "no match")
    path = new_shared_path(t.spark, "a12")
    R.write_outputs(t.events.select("event_id", status.alias("status"), reason.alias("error_reason")), path)
    schema = "event_id bigint, error_reason string"
    parts = [
        t.spark.read.schema(schema).json(f"{path}/{name}").select(F.lit(name).alias("output"), "event_id", "error_reason")
        for name in ("products", "unmatched", "errors")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
