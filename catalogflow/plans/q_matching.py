"""Scored matching over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matching as M
from .registry import LINES, query, text

# A DuckDB statement of the same rule: dynamic programming over letters, one list per row.
_LCS = """list_reduce(list_transform(string_split(a, ''), lambda x: list_transform(string_split(b, ''), lambda y: CASE WHEN x = y THEN 1 ELSE 0 END)),
 lambda prev, eq: list_transform(range(1, len(eq) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda i:
   greatest(prev[i], CASE WHEN eq[i] = 1 THEN 1 + CASE WHEN i > 1 THEN prev[i - 1] ELSE 0 END ELSE 0 END)))),
 list_transform(string_split(b, ''), lambda y: 0))"""


@query(
    "C6_nearest_title",
    f"""WITH q AS (SELECT DISTINCT p_name || ' ' || lower(p_type) AS title FROM part),
    i AS (SELECT p_name || ' kit' AS m, min(p_partkey) AS ord FROM part WHERE p_name NOT LIKE 'small%' AND p_name NOT LIKE '%ring' GROUP BY 1),
    s AS (SELECT title, m, ord, array_to_string(list_sort(string_split(title, ' ')), ' ') AS a, array_to_string(list_sort(string_split(m, ' ')), ' ') AS b FROM q, i),
    r AS (SELECT title, m, ord, 200.0::DOUBLE * list_max({_LCS}) / (length(a) + length(b)) AS score FROM s)
    SELECT title, first(m ORDER BY score DESC, ord) AS matched_title, round(max(score), 6) AS score FROM r GROUP BY title HAVING max(score) >= 60""",
)
def c6(t):
    inputs = t.part.select(F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("title"))
    index = t.part.filter("p_name not like 'small%' and p_name not like '%ring'").select(F.concat("p_name", F.lit(" kit")).alias("name"), "p_partkey")
    return M.nearest_title(inputs, index, "title", "name", "p_partkey").withColumn("score", F.round("score", 6))


@query(
    "C6_length_band",
    """WITH q AS (SELECT DISTINCT p_name AS q FROM part), d AS (SELECT DISTINCT p_name || ' ' || lower(p_type) AS t FROM part),
    c AS (SELECT q, t, list_sort(string_split(q, '')) AS lq, list_sort(string_split(t, '')) AS lt FROM q, d),
    n AS (SELECT q, t, (SELECT coalesce(sum(least(x.n, y.n)), 0) FROM (SELECT ch, count(*) AS n FROM (SELECT unnest(lq) AS ch) GROUP BY 1) x
      JOIN (SELECT ch, count(*) AS n FROM (SELECT unnest(lt) AS ch) GROUP BY 1) y USING (ch)) AS shared FROM c)
    SELECT q, t FROM n WHERE shared >= 0.35 * (length(q) + length(t)) - 1e-9 AND least(length(q), length(t)) >= 0.35 * (length(q) + length(t)) - 1e-9""",
)
def c6_band(t):
    """Every pair whose letters allow a ratio of 70, as found by the prefix filter."""
    names = t.part.select(F.col("p_name").alias("q")).distinct()
    titles = t.part.select(F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("t")).distinct()
    return M.title_pairs(names, titles, 0.70)


def search_results(t):
    """Per order the names on its lines as search results; lines 1-3, 4-5 and 6-7 come from three searches."""
    n = F.col("l_linenumber")
    source = F.when(n <= 3, "by_description").when(n <= 5, "by_title").otherwise("second")
    lines = t.lines().select(F.col("l_orderkey").alias("input_id"), source.alias("source"), n.alias("pos"), "p")
    return lines.join(t.part.withColumnRenamed("p_partkey", "p"), "p").select(
        "input_id", "source", "pos", F.col("p_name").alias("name"), F.concat(F.lit("/p/"), text("p")).alias("url"), "p_size", "p_type"
    )


def wanted(t):
    """Per order the name it asks for: the part with the customer's number, and a second spelling of the next one."""
    names = t.part.select("p_partkey", "p_name", "p_size")
    first = names.select(F.col("p_partkey").alias("o_custkey"), F.col("p_name").alias("description"), F.col("p_size").alias("size"))
    second = names.select((F.col("p_partkey") - 1).alias("o_custkey"), F.concat(F.upper("p_name"), F.lit(" Horse Feed")).alias("title"))
    return t.orders.select(F.col("o_orderkey").alias("input_id"), "o_custkey").join(first, "o_custkey", "left").join(second, "o_custkey", "left")


_SEARCH = LINES + """, cand AS (SELECT l_orderkey AS input_id, CASE WHEN l_linenumber <= 3 THEN 1 WHEN l_linenumber <= 5 THEN 2 ELSE 3 END AS source, l_linenumber AS pos,
 p_name AS name, '/p/' || p AS url, p_size, p_type FROM lines JOIN part ON p = p_partkey),
 want AS (SELECT o_orderkey AS input_id, a.p_name AS description, a.p_size AS size, upper(b.p_name) || ' Horse Feed' AS title FROM orders
   LEFT JOIN part a ON a.p_partkey = o_custkey LEFT JOIN part b ON b.p_partkey = o_custkey + 1)"""


@query(
    "C7_match_keywords",
    f"""WITH {_SEARCH}, x AS (SELECT w.input_id, c.source, c.pos, c.url, lower(c.name) AS low, coalesce(w.description, '') AS q, string_split(lower(c.name), ' ') AS kw,
      CASE WHEN w.description IS NULL THEN CAST([] AS VARCHAR[]) ELSE string_split(w.description, ' ') END AS qk,
      CASE WHEN w.title IS NULL THEN CAST([] AS VARCHAR[]) ELSE string_split(lower(replace(w.title, ' Horse Feed', '')), ' ') END AS tk FROM want w JOIN cand c USING (input_id)),
    y AS (SELECT *, source = 1 AND q <> '' AND (contains(low, q) OR contains(q, low)) AS hit,
      len(list_intersect(kw, qk)) / greatest(len(qk), 1) AS s2, len(list_intersect(kw, tk)) / greatest(len(tk), 1) AS s3,
      CASE WHEN q <> '' THEN len(list_intersect(kw, qk)) / greatest(len(qk), 1) ELSE len(list_intersect(kw, tk)) / greatest(len(tk), 1) END AS s4 FROM x),
    b AS (SELECT input_id, arg_min(url, pos) FILTER (hit) AS u1,
      first(url ORDER BY s2 DESC, pos) FILTER (source = 1 AND q <> '' AND s2 >= 0.3) AS u2, max(s2) FILTER (source = 1 AND q <> '') AS m2,
      first(url ORDER BY s3 DESC, pos) FILTER (source = 2 AND s3 >= 0.3) AS u3, max(s3) FILTER (source = 2) AS m3,
      first(url ORDER BY s4 DESC, pos) FILTER (source = 3 AND s4 >= 0.3) AS u4, max(s4) FILTER (source = 3) AS m4 FROM y GROUP BY 1)
    SELECT w.input_id, coalesce(u1, u2, u3, u4, '') AS url,
      CASE WHEN u1 IS NOT NULL THEN 1 WHEN u2 IS NOT NULL THEN 2 WHEN u3 IS NOT NULL THEN 3 WHEN u4 IS NOT NULL THEN 4 ELSE 0 END AS tier,
      CAST(CASE WHEN u1 IS NOT NULL THEN 1.0 WHEN u2 IS NOT NULL THEN m2 WHEN u3 IS NOT NULL THEN m3 WHEN u4 IS NOT NULL THEN m4 ELSE 0.0 END AS DOUBLE) AS score
    FROM want w LEFT JOIN b USING (input_id)""",
)
def c7(t):
    return M.match_keywords(wanted(t), search_results(t))


@query(
    "C8_match_attributes",
    f"""WITH {_SEARCH}, x AS (SELECT w.input_id, c.pos, 'https://x.example/product/' || replace(c.name, ' ', '-') || '-' || c.p_size AS url,
      list_filter(string_split(upper(w.description) || ' ' || w.size, ' '), lambda s: s <> 'NEW') AS qt,
      list_filter(string_split(upper(c.name) || ' ' || c.p_size, ' '), lambda s: s <> 'NEW') AS tt,
      string_split(upper(replace(c.name, ' ', '-')) || '-' || c.p_size, '-') AS sl, upper(replace(c.name, ' ', '-')) || '-' || c.p_size AS slug,
      w.size AS qs, c.p_size AS ps FROM want w JOIN cand c USING (input_id) WHERE w.description IS NOT NULL),
    y AS (SELECT *, len(list_filter(qt, lambda s: list_contains(tt, s) OR list_contains(sl, s))) AS m, list_contains(qt, 'RING') AS qf, list_contains(tt, 'RING') AS tf,
      len(list_filter(qt, lambda s: contains(slug, s))) AS sh FROM x WHERE abs(ps - qs) / ps <= 0.08),
    z AS (SELECT *, m * 1.2::DOUBLE + CASE WHEN NOT qf THEN 0.0::DOUBLE WHEN tf THEN 1.5::DOUBLE ELSE -0.8::DOUBLE END + CASE WHEN sh >= 2 THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END AS score
      FROM y WHERE m >= 2 AND m / len(tt) >= 0.75 AND m / len(qt) >= 0.5)
    SELECT input_id, first(url ORDER BY score DESC, pos) AS url, round(max(score), 6) AS score FROM z GROUP BY 1""",
)
def c8(t):
    name = F.concat("description", F.lit(" "), text("size"), F.lit(" in"))
    inputs = wanted(t).filter("description is not null").select("input_id", name.alias("name"))
    results = search_results(t)
    slug = F.concat(F.replace("name", F.lit(" "), F.lit("-")), F.lit("-"), text("p_size"))
    candidates = results.select(
        "input_id", "pos", F.concat(F.lit("https://x.example/product/"), slug).alias("url"),
        F.concat("name", F.lit(" "), text("p_size"), F.lit(" inch")).alias("title"),
        F.lit("").alias("page_text"), F.lit("").alias("page_taxonomy"),
    )
    return M.match_attributes(inputs, candidates).withColumn("score", F.round("score", 6))


@query(
    "C8_match_staged",
    f"""WITH {_SEARCH}, x AS (SELECT w.input_id, c.source, c.pos, 'https://x.example/product/' || replace(c.name, ' ', '-') || '-' || c.p_size AS url,
      list_filter(CASE WHEN c.source = 1 THEN string_split(upper(w.description) || ' ' || w.size, ' ') ELSE string_split(replace(w.title, ' Horse Feed', ''), ' ') END, lambda s: s <> 'NEW' AND s <> '') AS qt,
      list_filter(string_split(upper(c.name) || ' ' || c.p_size, ' '), lambda s: s <> 'NEW') AS tt,
      string_split(upper(replace(c.name, ' ', '-')) || '-' || c.p_size, '-') AS sl, upper(replace(c.name, ' ', '-')) || '-' || c.p_size AS slug,
      w.size AS qs, c.p_size AS ps, contains(coalesce(upper(w.description), w.title), 'RING') AS qf
      FROM want w JOIN cand c USING (input_id) WHERE (c.source = 1 AND w.description IS NOT NULL) OR (c.source = 2 AND w.title IS NOT NULL)),
    y AS (SELECT *, len(list_filter(qt, lambda s: list_contains(tt, s) OR list_contains(sl, s))) AS m, list_contains(tt, 'RING') AS tf,
      len(list_filter(qt, lambda s: contains(slug, s))) AS sh FROM x WHERE qs IS NULL OR abs(ps - qs) / ps <= 0.08),
    z AS (SELECT *, m * 1.2::DOUBLE + CASE WHEN NOT qf THEN 0.0::DOUBLE WHEN tf THEN 1.5::DOUBLE ELSE -0.8::DOUBLE END + CASE WHEN sh >= 2 THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END AS score
      FROM y WHERE m >= 2 AND m / len(tt) >= CASE WHEN len(tt) <= 4 THEN 0.75 ELSE 0.6 END AND m / len(qt) >= 0.5)
    SELECT input_id, first(CASE source WHEN 1 THEN 'description' ELSE 'title' END ORDER BY source, score DESC, pos) AS stage,
      first(url ORDER BY source, score DESC, pos) AS url, round(first(score ORDER BY source, score DESC, pos), 6) AS score FROM z GROUP BY 1""",
)
def c8_staged(t):
    """Lines 1-3 come from the search by description, 4-5 by title, 6-7 by code."""
    name = F.concat("description", F.lit(" "), text("size"), F.lit(" in"))
    inputs = wanted(t).select("input_id", F.format_string("%012d", F.col("input_id")).alias("upc"), name.alias("description"), F.replace("title", F.lit(" Horse Feed")).alias("title"))
    results = search_results(t)
    slug = F.concat(F.replace("name", F.lit(" "), F.lit("-")), F.lit("-"), text("p_size"))
    stage = F.when(F.col("source") == "by_description", "description").when(F.col("source") == "by_title", "title").otherwise("code")
    candidates = results.select(
        "input_id", stage.alias("stage"), "pos", F.concat(F.lit("https://x.example/product/"), slug).alias("url"),
        F.concat("name", F.lit(" "), text("p_size"), F.lit(" inch")).alias("title"), F.lit("").alias("page_text"), F.lit("").alias("page_taxonomy"),
    )
    return M.match_staged(inputs, candidates).withColumn("score", F.round("score", 6))


@query(
    "C9_rank_titles",
    f"""WITH {_SEARCH}, x AS (SELECT w.input_id, c.pos, c.url, list_distinct(string_split(c.name || ' ' || lower(c.p_type), ' ')) AS nt, string_split(w.description, ' ') AS qt
      FROM want w JOIN cand c USING (input_id)),
    y AS (SELECT *, CASE WHEN qt IS NULL THEN 0.0::DOUBLE ELSE len(list_intersect(nt, qt)) - 0.1::DOUBLE * (len(nt) - len(list_intersect(nt, qt))) END AS score FROM x)
    SELECT input_id, first(url ORDER BY score DESC, pos) AS url, round(max(score), 6) AS score FROM y GROUP BY 1""",
)
def c9(t):
    inputs = wanted(t).select("input_id", F.col("description").alias("query"))
    candidates = search_results(t).withColumn("name", F.concat("name", F.lit(" "), F.lower("p_type")))
    return M.rank_titles(inputs, candidates).withColumn("score", F.round("score", 6))


@query(
    "C21_match_style",
    f"""WITH {_SEARCH}, x AS (SELECT w.input_id, c.pos, c.name AS label, 'Giant ' || w.description || ' 2×1' AS ref, string_split(c.name, ' ') AS lt,
      string_split(lower('giant ' || w.description || ' 2x1'), ' ') AS rt FROM want w JOIN cand c USING (input_id) WHERE w.description IS NOT NULL),
    y AS (SELECT *, CASE WHEN contains(lower(ref), label) THEN 100.0::DOUBLE ELSE len(list_intersect(lt, rt)) +
      CASE WHEN len(list_filter(lt, lambda s: contains(lower(ref), s))) > 0 THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END END AS score FROM x)
    SELECT input_id, first(label ORDER BY score DESC, pos) AS label, round(max(score), 6) AS score FROM y GROUP BY 1""",
)
def c21(t):
    references = wanted(t).filter("description is not null").select("input_id", F.concat(F.lit("Giant "), "description", F.lit(" 2×1")).alias("reference"))
    labels = search_results(t).select("input_id", "pos", F.col("name").alias("label"))
    return M.match_style(references, labels, ["input_id"]).withColumn("score", F.round("score", 6))


@query(
    "C21_match_option",
    f"""WITH {_SEARCH}, x AS (SELECT w.input_id, c.pos, c.url, lower(c.name) AS low, w.description AS want, len(list_intersect(string_split(c.name, ' '), string_split(w.description, ' '))) AS n
      FROM want w JOIN cand c USING (input_id) WHERE w.description IS NOT NULL)
    SELECT input_id, first(url ORDER BY CASE WHEN low = want THEN 1000 WHEN contains(want, low) OR contains(low, want) THEN 80 ELSE n END DESC, pos) AS option_id FROM x GROUP BY 1""",
)
def c21_option(t):
    chosen = wanted(t).filter("description is not null").select("input_id", F.col("description").alias("label"))
    options = search_results(t).select("input_id", "pos", F.col("url").alias("option_id"), F.col("name").alias("option_label"))
    return M.match_option(chosen, options, ["input_id"])


@query(
    "C21_match_child",
    f"""WITH {_SEARCH}, x AS (SELECT w.input_id, c.pos, c.url, c.name = w.description AS exact, list_intersect(string_split(c.name, ' '), list_concat(string_split(w.description, ' '), ['ring'])) AS hits
      FROM want w JOIN cand c USING (input_id) WHERE w.description IS NOT NULL),
    g AS (SELECT input_id, url, min(pos) AS pos, bool_or(exact) AS exact, len(list_distinct(flatten(list(hits)))) AS n FROM x GROUP BY 1, 2)
    SELECT input_id, first(url ORDER BY CASE WHEN exact THEN 1000000 ELSE n END DESC, pos) AS child FROM g GROUP BY 1""",
)
def c21_child(t):
    chosen = wanted(t).filter("description is not null").select("input_id", F.col("description").alias("label"), F.array(F.lit("ring")).alias("tokens"))
    labels = search_results(t).groupBy("input_id", F.col("url").alias("child"), F.col("name").alias("label")).agg(F.min("pos").alias("child_pos"))
    return M.match_child(chosen, labels, ["input_id"])
