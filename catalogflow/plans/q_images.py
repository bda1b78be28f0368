"""Image operators over the driver tables: vectors serve as small gray images and as hash bits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import images as I
from .registry import query, text


def vector_images(t):
    """The 64 numbers of a vector as the pixels of an 8 x 8 gray image, in the image source's form."""
    pixel = F.transform("embedding", lambda x: F.lpad(F.hex(F.least(F.floor(F.abs(x).cast("double") * 1200), F.lit(255))), 2, "0"))
    data = F.unhex(F.array_join(pixel, ""))
    image = F.struct(
        text("vec_id").alias("origin"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"), F.lit(0).alias("mode"), data.alias("data")
    )
    return t.embeddings.select(image.alias("image"))


@query(
    "J1_image_metrics",
    """WITH p AS (SELECT vec_id, i // 8 AS r, i % 8 AS c, least(floor(abs(embedding[i + 1]::DOUBLE) * 1200), 255) AS g FROM embeddings, (SELECT unnest(range(64)) AS i)),
    b AS (SELECT vec_id, min(c) FILTER (g = 255) AS x0, min(r) FILTER (g = 255) AS y0, max(c) FILTER (g = 255) + 1 AS x1, max(r) FILTER (g = 255) + 1 AS y1 FROM p GROUP BY 1),
    k AS (SELECT vec_id, coalesce(x0, 0) AS x0, coalesce(y0, 0) AS y0, coalesce(x1, 8) AS x1, coalesce(y1, 8) AS y1 FROM b)
    SELECT CAST(vec_id AS VARCHAR) AS origin, CAST(x0 AS INTEGER) AS x0, CAST(y0 AS INTEGER) AS y0, CAST(x1 - x0 AS INTEGER) AS width, CAST(y1 - y0 AS INTEGER) AS height,
      CAST((x1 - x0) * (y1 - y0) AS BIGINT) AS area FROM k""",
)
def j1(t):
    return I.image_metrics(vector_images(t)).select("origin", "x0", "y0", "width", "height", "area")


@query(
    "J1_sharpness",
    """WITH p AS (SELECT vec_id, i // 8 AS r, i % 8 AS c, least(floor(abs(embedding[i + 1]::DOUBLE) * 800), 254) AS g FROM embeddings, (SELECT unnest(range(64)) AS i)),
    n AS (SELECT a.vec_id, a.r, a.c, -4 * any_value(a.g) + sum(b.g * CASE WHEN (a.r IN (0, 7) AND b.r <> a.r) OR (a.c IN (0, 7) AND b.c <> a.c) THEN 2 ELSE 1 END) AS lap
      FROM p a JOIN p b ON a.vec_id = b.vec_id AND abs(a.r - b.r) + abs(a.c - b.c) = 1 GROUP BY 1, 2, 3)
    SELECT CAST(vec_id AS VARCHAR) AS origin, CAST(floor(var_pop(lap) * 4096 + 0.5) AS BIGINT) AS sharpness_4096 FROM n GROUP BY 1""",
)
def j1_sharpness(t):
    """Without white pixels the crop is the whole image; its variance is a multiple of 1/4096."""
    pixel = F.transform("embedding", lambda x: F.lpad(F.hex(F.least(F.floor(F.abs(x).cast("double") * 800), F.lit(254))), 2, "0"))
    image = F.struct(
        text("vec_id").alias("origin"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"), F.lit(0).alias("mode"),
        F.unhex(F.array_join(pixel, "")).alias("data"),
    )
    return I.image_metrics(t.embeddings.select(image.alias("image"))).select("origin", F.floor(F.col("sharpness") * 4096 + 0.5).alias("sharpness_4096"))


def _weights(taps: int) -> str:
    """Lanczos weights of an image side of `taps` pixels widened to 32: place o, pixel i, weight w."""
    x = f"(i + 0.5 - (o + 0.5) * {taps} / 32.0)"
    sinc = lambda v: f"CASE WHEN {v} = 0 THEN 1.0 ELSE sin(pi() * {v}) / (pi() * {v}) END"
    return f"""SELECT o, i, v / sum(v) OVER (PARTITION BY o) AS w FROM (SELECT o, i, CASE WHEN abs({x}) < 3 THEN ({sinc(x)}) * ({sinc(f"({x} / 3.0)")}) ELSE 0.0 END AS v
      FROM (SELECT unnest(range(32)) AS o), (SELECT unnest(range({taps})) AS i))"""


@query(
    "J1_perceptual_hash",
    f"""WITH p AS (SELECT vec_id, i // 8 AS r, i % 8 AS c, least(floor(abs(embedding[i + 1]::DOUBLE) * 1200), 255) AS g FROM embeddings, (SELECT unnest(range(64)) AS i)),
    w AS (SELECT o, i, CAST(round_even(w * 4194304, 0) AS BIGINT) AS w FROM ({_weights(8)})),
    a AS (SELECT vec_id, r, o AS c, greatest(0, least(255, CAST(floor((sum(CAST(g AS BIGINT) * w) + 2097152) / 4194304::DOUBLE) AS BIGINT))) AS g FROM p JOIN w ON p.c = w.i GROUP BY 1, 2, 3),
    b AS (SELECT vec_id, o AS r, c, greatest(0, least(255, CAST(floor((sum(g * w) + 2097152) / 4194304::DOUBLE) AS BIGINT))) AS g FROM a JOIN w ON a.r = w.i GROUP BY 1, 2, 3),
    k AS (SELECT f, n, CAST(round_even(cos(pi() * (2 * n + 1) * f / 64) * 268435456, 0) AS BIGINT) AS v FROM (SELECT unnest(range(8)) AS f), (SELECT unnest(range(32)) AS n)),
    d AS (SELECT vec_id, f AS y, c, CAST(floor((sum(g * v) + 8192) / 16384::DOUBLE) AS BIGINT) AS s FROM b JOIN k ON b.r = k.n GROUP BY 1, 2, 3),
    e AS (SELECT vec_id, y, f AS x, sum(s * v) AS s FROM d JOIN k ON d.c = k.n GROUP BY 1, 2, 3),
    t AS (SELECT vec_id, list_sort(list(s)) AS l FROM e GROUP BY 1),
    m AS (SELECT e.*, l[32] + l[33] AS mid FROM e JOIN t USING (vec_id)),
    h AS (SELECT vec_id, sum(CASE WHEN 2 * s > mid THEN CAST(1 AS HUGEINT) << CAST(63 - (8 * y + x) AS INTEGER) ELSE 0 END) AS h FROM m GROUP BY 1)
    SELECT CAST(vec_id AS VARCHAR) AS origin, CAST(CASE WHEN h >= 9223372036854775808 THEN h - 18446744073709551616 ELSE h END AS BIGINT) AS phash FROM h""",
)
def j1_hash(t):
    return I.image_metrics(vector_images(t)).select("origin", "phash")


def vector_hashes(t):
    """Signs of the 64 numbers as a 64-bit hash."""
    bits = F.aggregate(
        "embedding", F.lit(0).cast("bigint"), lambda acc, x: F.shiftleft(acc, 1).bitwiseOR(F.when(x > 0, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    )
    return t.embeddings.select("vec_id", "label", bits.alias("phash"))


@query(
    "J2_placeholder_join",
    """WITH h AS (SELECT vec_id, label, CAST(array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS BIT) AS b FROM embeddings),
    k AS (SELECT arg_min(b, vec_id) AS b FROM h GROUP BY label)
    SELECT vec_id, EXISTS (SELECT 1 FROM k WHERE bit_count(xor(h.b, k.b)) <= 10) AS is_placeholder FROM h""",
)
def j2(t):
    hashes = vector_hashes(t)
    known = hashes.groupBy("label").agg(F.min_by("phash", "vec_id").alias("phash"))
    return I.mark_placeholders(hashes, known, "vec_id").select("vec_id", "is_placeholder")


@query(
    "J2_placeholder_join_wide",
    """WITH h AS (SELECT vec_id, label, CAST(array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS BIT) AS b FROM embeddings),
    k AS (SELECT arg_min(b, vec_id) AS b FROM h GROUP BY label)
    SELECT vec_id FROM h WHERE EXISTS (SELECT 1 FROM k WHERE bit_count(xor(h.b, k.b)) <= 20)""",
)
def j2_wide(t):
    hashes = vector_hashes(t)
    known = hashes.groupBy("label").agg(F.min_by("phash", "vec_id").alias("phash"))
    return I.placeholder_join(hashes, known, "vec_id", limit=20)
