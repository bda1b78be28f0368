"""The numbered queries over the driver's tables and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import read_table
from . import decontaminate, jaccard, language, licenses, negatives, neighbours, packing, paragraphs, personal, prefixes, quality, quality_sql, secrets, suffixes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of doc_id as text leaves 2 when divided by 4; a row without id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


@query("op1_language_id")
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    model = language.train(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    found = language.identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def joined(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffixes.remove(read_table(spark, folder, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_substring_dedup")
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.repeated(read_table(spark, folder, "documents"))


@query("op4_benchmark_decontamination")
def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, read_table(spark, folder, "benchmark")).filter(F.size("leaks") > 0)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query("op5_secret_scans")
def op5_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.scan(docs).drop("text")
    base = F.filter("secrets", lambda s: s["base"])
    counts = [counted(base, k).alias(f"n_{k}") for k in secrets.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


@query("op9_license_scans")
def op9_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(read_table(spark, folder, "documents").select("doc_id", "text")).filter(F.size("licenses") > 0)
    return found.select("doc_id", F.explode("licenses").alias("found")).select("doc_id", "found.*")


def byte_bpe() -> str:
    """The public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op10_packing")
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"), byte_bpe())


@query("op6_nearest_neighbours")
def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(read_table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar(read_table(spark, folder, "documents"))


@query("op8_personal_data")
def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = personal.detect(docs, personal.train(docs)).drop("text")
    base = F.filter("personal", lambda s: s["base"])
    counts = [counted(base, k).alias(f"n_{k}") for k in personal.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("personal")).alias("spans"))


@query("op13_quality_rules", quality_sql.SQL)
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.clean(read_table(spark, folder, "documents").select("doc_id", "text"))
    wanted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select("doc_id", *[f"quality.{c}" for c in wanted])


OP12_SQL = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * c.q[i])) AS BIGINT) AS score
  FROM r a JOIN r c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.q) = len(c.q)
),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM s WHERE same),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND p.place <= 5 AND NOT s.same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = negatives.prepared(read_table(spark, folder, "embeddings"))
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("id") % 50 == 0)


_CRC32 = """list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: list_prepend(CAST(ascii(x) AS BIGINT), CAST([-1, -1, -1, -1, -1, -1, -1, -1] AS BIGINT[]))))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)"""

_WORD = r"'[^\x20\x09-\x0D]+'"

OP11_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
  SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY turn NULLS FIRST, md5(concat(length(role), ':', role, ':', text))) AS own
  FROM t GROUP BY conv_id
),
h AS (SELECT conv_id, own, conv_id - conv_id % 20 AS base, xor({_CRC32}, 4294967295) % 4 AS h FROM own),
rebuilt AS (SELECT h.conv_id, list_concat(coalesce(b.own, [])[1:h], h.own[h + 1:]) AS seq FROM h LEFT JOIN own b ON b.conv_id = h.base),
members AS (SELECT conv_id, d, len(seq) AS n, seq[1:d] AS prefix FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT prefix, d AS depth, count(*) AS n_convs, min(conv_id) AS conv_id, CAST(max(n) = d AS INTEGER) AS leaf,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(prefix[d].t, {_WORD})) END AS saved
  FROM members GROUP BY prefix, d
),
subtrees AS (
  SELECT prefix[1:k] AS top, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT prefix, leaf, saved, unnest(range(0, depth + 1)) AS k FROM nodes) GROUP BY 1
),
children AS (SELECT prefix[1:depth - 1] AS top, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(c.n, 0) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM nodes v JOIN subtrees s ON s.top = v.prefix LEFT JOIN children c ON c.top = v.prefix
  LEFT JOIN nodes p ON v.depth > 0 AND p.prefix = v.prefix[1:v.depth - 1]
"""


@query("op11_prefix_trie", OP11_SQL)
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    own = prefixes.turns(read_table(spark, folder, "conversations"))
    c = F.col("conv_id")
    return prefixes.trie(prefixes.branched(own, c - c % 20, F.crc32(c.cast("string")) % 4, at_most=3))
