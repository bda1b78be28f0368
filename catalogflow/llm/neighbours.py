"""Approximate nearest neighbours: shifted Hilbert orderings of projected vectors, windows of neighbouring keys, exact rerank."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialize
from .arrays import with_arrow

SAMPLE = 8192


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (rows of coordinates below 2**bits) on the Hilbert curve; dimensions times bits at most 63."""
    return _interleaved(_turned(cells, bits), bits, 0)


def _turned(cells: np.ndarray, bits: int) -> np.ndarray:
    """Coordinates whose interleaved bits are the place on the Hilbert curve.

    Coordinates are turned level by level from the coarsest, as each level's quadrant sets the curve's direction below
    it; the bits of all coordinates then interleave to the key.
    """
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    for level in range(bits - 1, 0, -1):
        low, bit = (1 << level) - 1, 1 << level
        for d in range(dims):
            high = (x[:, d] & bit) > 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] = np.where(high, x[:, 0] ^ low, x[:, 0] ^ swap)
            x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[:, -1] & (1 << level)) > 0, (1 << level) - 1, 0)
    return x ^ turn[:, None]


def _interleaved(x: np.ndarray, high: int, low: int) -> np.ndarray:
    """The bits of all coordinates from below `high` down to `low`, level by level."""
    key = np.zeros(len(x), np.int64)
    for level in range(high - 1, low - 1, -1):
        for d in range(x.shape[1]):
            key = (key << 1) | ((x[:, d] >> level) & 1)
    return key


class Grid:
    """Coordinates of projected vectors between 0 and 1, level with the share of a sample below them.

    So a dense group takes as much room as it has vectors, and a few long vectors none of the others'. What lies beyond
    the sample goes by the logarithm of its distance into the outer hundredths.
    """

    def __init__(self, projected: np.ndarray):
        self.knots = [np.unique(c) for c in projected.T]
        self.shares = [np.searchsorted(np.sort(c), k, side="right") / len(c) for c, k in zip(projected.T, self.knots, strict=True)]
        self.wide = [max(float(k[-1] - k[0]), float(np.abs(k).max()) * 1e-9, 1e-300) for k in self.knots]

    def at(self, projected: np.ndarray) -> np.ndarray:
        out = np.empty(projected.shape)
        for d, (knots, shares, wide) in enumerate(zip(self.knots, self.shares, self.wide, strict=True)):
            x = projected[:, d]
            with np.errstate(over="ignore"):
                beyond = np.log2(1 + np.maximum(x - knots[-1], 0) / wide) - np.log2(1 + np.maximum(knots[0] - x, 0) / wide)
            out[:, d] = 0.01 + 0.98 * np.interp(x, knots, shares) + 0.01 * np.clip(beyond / 1024, -1, 1)
        return out


def curve_keys(unit: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two words of the place on the Hilbert curve of a shifted grid: coarse, and fine within its cells."""
    bits = min(26, 63 // unit.shape[1])
    cells = ((unit * 0.75 + 0.25 * shift) * (1 << 2 * bits)).astype(np.int64)
    turned = _turned(np.clip(cells, 0, (1 << 2 * bits) - 1), 2 * bits)
    return _interleaved(turned, 2 * bits, bits), _interleaved(turned, bits, 0)


def directions(size: int, curves: int, dims: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Orthonormal directions, `dims` for each curve, and the shift of its grid."""
    rng = np.random.default_rng(seed)
    turns = []
    while len(turns) < curves:
        full = np.linalg.qr(rng.normal(size=(size, size)))[0]
        turns += [full[:, a : a + dims] for a in range(0, max(1, size - dims + 1), dims)]
    return [(t, rng.random(t.shape[1])) for t in turns[:curves]]


def _matrix(vectors: pa.Array) -> np.ndarray:
    return np.asarray(vectors.flatten()).astype(np.float64).reshape(len(vectors), -1)


def usable(vector: str) -> Column:
    """A vector without null or non-finite components and not zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _positions(rows: DataFrame, order: list[str], per_part: int, n: int) -> DataFrame:
    """Rows with their place from 0 in the order, numbered in range partitions and summed over them."""
    parts = max(1, n // per_part)
    placed = materialize(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    sums = placed.groupBy("_part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    starts = F.broadcast(sums.select("_part", before.alias("_before")))  # a row per partition
    return placed.withColumn("_within", within).join(starts, "_part").withColumn("position", F.col("_before") + F.col("_within")).drop("_part", "_within", "_before")


def search(
    rows: DataFrame, queries: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", curves: int = 16, dims: int = 6,
    window: int = 3000, block: int = 4096, seed: int = 11,
) -> DataFrame:
    """The k nearest rows found for each query row: query_id, rank from 1, vec_id, score (Euclidean distance).

    rows: every row is indexed; queries: a condition on vec_id. Each curve orders the distinct vectors by the Hilbert key
    of a random projection to `dims` dimensions on a randomly shifted grid, level with the quantiles of SAMPLE vectors
    (chosen by a hash) and of two 63-bit words, so that order within crowded cells goes by nearness too; the `window` vectors on either side of the
    query's place are candidates, reranked by exact distance in double precision. Equal vectors are one index entry with
    its k + 1 smallest ids, so copies neither crowd a window nor a task. Ties go to the smaller vec_id. The query's own
    id never is a result; a query has all candidates found if fewer than k. Rows with null id, rows repeated as a whole
    and unusable vectors (null, zero, null or non-finite components, another length than the commonest) take no part
    or count once. An empty table gives no rows. Other columns play no part.
    """
    base = rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(usable("v") & F.col("id").isNotNull())
    lengths = base.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    spark = rows.sparkSession
    out = T.StructType.fromDDL("query_id bigint, rank int, vec_id bigint, score double")
    if lengths is None:
        return spark.createDataFrame([], out)
    size = int(lengths[0])
    base = base.filter(F.size("v") == size)
    smallest = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    kept = base.distinct().withColumn("place", smallest).filter(F.col("place") <= k + 1)
    entries = materialize(kept.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("entry", F.col("ids")[0]))
    n = entries.count()
    asked = materialize(base.filter(queries).distinct().join(entries.select("v", "entry"), "v").select(F.col("id").alias("query_id"), "entry"))
    wanted = asked.select("entry").distinct()
    turns = directions(size, curves, dims, seed)
    some = entries.select("v").orderBy(F.xxhash64("v"), "v").limit(max(256, min(SAMPLE, (1 << 23) // size))).toArrow()
    some = _matrix(some["v"].combine_chunks())
    grids = [Grid(some @ turn) for turn, _ in turns]

    def keys(vectors: pa.Array) -> pa.Array:
        x = _matrix(vectors)
        both = [curve_keys(grid.at(x @ turn), shift) for (turn, shift), grid in zip(turns, grids, strict=True)]
        ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(turns))
        flat = [pa.array(np.stack([w[k] for w in both], 1).reshape(-1) if len(x) else np.zeros(0, np.int64)) for k in (0, 1)]
        return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(flat, ["key", "fine"]))

    keyed = with_arrow(entries.select("entry", "v"), "keys", [F.col("v")], "array<struct<key bigint, fine bigint>>", keys)
    spread_out = keyed.select("entry", F.col("v").cast("array<float>" if _is_float(rows, vector) else "array<double>").alias("v"), F.posexplode("keys").alias("curve", "at"))
    spread_out = spread_out.select("entry", "v", "curve", "at.key", "at.fine")
    placed = materialize(_positions(spread_out, ["curve", "key", "fine", "entry"], 50_000, n * curves))
    placed = placed.withColumn("block", F.floor(F.col("position") / block))
    low = F.greatest(F.col("curve") * F.lit(n), F.col("position") - window)
    high = F.least((F.col("curve") + 1) * F.lit(n) - 1, F.col("position") + window)
    seekers = (
        placed.join(wanted, "entry").select(F.col("entry").alias("seeker"), F.col("v").alias("at"), low.alias("low"), high.alias("high"))
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("low") / block), F.floor(F.col("high") / block))))
    )

    def rerank(_, left: pa.Table, right: pa.Table) -> pa.Table:
        """The nearest entries of one block for each query whose window reaches it (both sides are of bounded size)."""
        names = ["query", "entry", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        x, q = _matrix(left["v"].combine_chunks()), _matrix(right["at"].combine_chunks())
        at, entry = np.asarray(left["position"]), np.asarray(left["entry"])
        low, high = np.asarray(right["low"]), np.asarray(right["high"])
        most = min(len(x), k + 8)
        found = []
        for a in range(0, len(q), 256):
            part = slice(a, a + 256)
            near = (x * x).sum(1) - 2 * q[part] @ x.T
            near[(at < low[part, None]) | (at > high[part, None])] = np.inf
            best = np.argpartition(near, most - 1, axis=1)[:, :most]
            ok = np.isfinite(np.take_along_axis(near, best, 1))
            score = np.sqrt(((q[part][:, None, :] - x[best]) ** 2).sum(2))
            row = np.broadcast_to(np.asarray(right["seeker"])[part][:, None], best.shape)
            found.append((row[ok], entry[best][ok], score[ok]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names)

    near = (
        placed.select(F.col("block").alias("near"), "position", "entry", "v").groupBy("near").cogroup(seekers.groupBy("block"))
        .applyInArrow(rerank, "query bigint, entry bigint, score double")
    )
    first = F.row_number().over(Window.partitionBy("query").orderBy("score", "entry"))
    best = near.groupBy("query", "entry").agg(F.min("score").alias("score")).withColumn("place", first).filter(F.col("place") <= k + 1)
    ids = best.join(entries.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("id"))
    order = F.row_number().over(Window.partitionBy("query").orderBy("score", "id"))
    lists = (
        ids.withColumn("place", order).filter(F.col("place") <= k + 1)
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("near"))
    )
    own = asked.join(lists, asked["entry"] == lists["query"]).select("query_id", F.filter("near", lambda s: s["id"] != F.col("query_id")).alias("near"))
    flat = own.select("query_id", F.posexplode(F.slice("near", 1, k)).alias("place", "s"))
    return flat.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("s.id").alias("vec_id"), F.col("s.score").alias("score"))


def _is_float(rows: DataFrame, vector: str) -> bool:
    kind = rows.schema[vector].dataType
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
