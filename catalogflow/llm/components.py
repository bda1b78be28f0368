"""Connected components of links, and fixed-size bitmaps of keys."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import discard, materialize


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node) for every node of the links (columns a and b).

    Every link is moved to the smallest neighbour of its larger, then of its smaller end, until nothing moves; the rounds
    grow with the logarithm of a component's width. Each round is written to the shared folder. No links give no rows.
    """
    now = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = None
    while True:
        seen = now.agg(F.count("u"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if seen == mark or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
        mark = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large)
        first = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(first, "u")
        moved = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, now = now, materialize(moved.unionByName(first.select("u", F.col("m").alias("v"))).distinct())
        discard(before, large)


def bitmap(df: DataFrame, key: Column, log2: int) -> np.ndarray:
    """Bits of the lowest log2 bits of the keys (spread 64-bit values); the driver gets 2**(log2 - 6) numbers at most.

    It only spares later work: a key that is not in it is not in df. A full bitmap spares nothing and loses nothing.
    """
    spread = df.select(key.alias("k")).selectExpr(f"shiftrightunsigned(k, 6) & {(1 << (log2 - 6)) - 1} AS w", "shiftleft(1L, CAST(k & 63 AS int)) AS b")
    words = spread.groupBy("w").agg(F.expr("bit_or(b)").alias("b")).toArrow()
    out = np.zeros(1 << (log2 - 6), np.uint64)
    out[np.asarray(words["w"]).astype(np.int64)] = np.asarray(words["b"]).astype(np.int64).view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, keys: np.ndarray, step: int = 1 << 17) -> np.ndarray:
    keys = keys.view(np.uint64)
    out = np.empty(len(keys), bool)
    for a in range(0, len(keys), step):  # so that what is needed in between stays small
        part = keys[a : a + step]
        out[a : a + step] = (bits[((part >> np.uint64(6)) & np.uint64(len(bits) - 1)).astype(np.int64)] >> (part & np.uint64(63))) & np.uint64(1) > 0
    return out
