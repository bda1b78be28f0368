"""Image quality: pixel measures per image, placeholder join on hash bands, best image per product."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..functions.values import blank_text

_SCHEMA = "x0 int, y0 int, width int, height int, area bigint, sharpness double, phash bigint"


def _gray(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels).astype(np.int64)
    if channels == 1:
        return pixels[:, :, 0]
    blue, green, red = pixels[:, :, 0], pixels[:, :, 1], pixels[:, :, 2]
    return (19595 * red + 38470 * green + 7471 * blue + 32768) >> 16


def _laplacian_variance(gray: np.ndarray) -> float:
    mode = "reflect" if min(gray.shape) > 1 else "edge"
    p = np.pad(gray, 1, mode=mode)
    edges = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]
    return float(edges.var())


def _resample(size_in: int, size_out: int) -> np.ndarray:
    """Lanczos weights, widened for shrinking."""
    scale = size_in / size_out
    reach = 3.0 * max(scale, 1.0)
    centers = (np.arange(size_out) + 0.5) * scale
    x = (np.arange(size_in)[None, :] + 0.5 - centers[:, None]) / max(scale, 1.0)
    w = np.where(np.abs(x) * max(scale, 1.0) < reach, np.sinc(x) * np.sinc(x / 3.0), 0.0)
    return w / w.sum(axis=1, keepdims=True)


# Whole-number arithmetic, so that no sum depends on its order: bits of the resampling weights (as in the image library) and of the cosines.
_WEIGHT_BITS = 22
_COSINE_BITS = 28
_DROPPED_BITS = 14  # between the two cosine sums, so that the second fits 64 bits


def _shifted(sums: np.ndarray, bits: int) -> np.ndarray:
    return (sums + (1 << (bits - 1))) >> bits


def _whole_weights(size_in: int) -> np.ndarray:
    return np.rint(_resample(size_in, 32) * (1 << _WEIGHT_BITS)).astype(np.int64)


def _perceptual_hash(gray: np.ndarray) -> int:
    """64 signs of the low cosine frequencies of the 32x32 image against their median, all in whole numbers."""
    small = np.clip(_shifted(gray @ _whole_weights(gray.shape[1]).T, _WEIGHT_BITS), 0, 255)
    small = np.clip(_shifted(_whole_weights(gray.shape[0]) @ small, _WEIGHT_BITS), 0, 255)
    n = np.arange(32)
    cosines = np.rint(np.cos(np.pi * (2 * n[None, :] + 1) * n[:8, None] / 64) * (1 << _COSINE_BITS)).astype(np.int64)
    low = _shifted(cosines @ small, _DROPPED_BITS) @ cosines.T
    middle = np.sort(low, axis=None)[31:33].sum()  # twice the median
    bits = (2 * low > middle).ravel()
    return int(np.packbits(bits).view(">i8")[0])


def _white_box(gray: np.ndarray) -> tuple[int, int, int, int]:
    """Box around the pure white pixels, the whole image when there are none."""
    rows, columns = np.nonzero((gray == 255).any(axis=1))[0], np.nonzero((gray == 255).any(axis=0))[0]
    if len(rows) == 0:
        return 0, 0, gray.shape[1], gray.shape[0]
    return int(columns[0]), int(rows[0]), int(columns[-1]) + 1, int(rows[-1]) + 1


def image_metrics(images: DataFrame) -> DataFrame:
    """Crop box, size, sharpness of the crop and hash of the whole image, per row of the image source.

    Adds to `origin`; images are decoded by Spark's image source on the executors.
    """

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for origin, h, w, c, data in batch.itertuples(index=False):
                gray = _gray(h, w, c, data)
                x0, y0, x1, y1 = _white_box(gray)
                rows.append(
                    (origin, x0, y0, x1 - x0, y1 - y0, (x1 - x0) * (y1 - y0), _laplacian_variance(gray[y0:y1, x0:x1]), _perceptual_hash(gray))
                )
            yield pd.DataFrame(rows, columns=["origin", *[p.split(" ")[0] for p in _SCHEMA.split(", ")]])

    flat = images.select("image.origin", "image.height", "image.width", "image.nChannels", "image.data")
    return flat.mapInPandas(measure, f"origin string, {_SCHEMA}")


# Known hashes that one task compares with all images at once, and how often such a block is repeated to spread the work.
BLOCK = 1024
_SPREAD = 64


def hash_bands(c: Column, count: int) -> list[Column]:
    """The 64 bits cut into so many bands of nearly equal width."""
    bands, start = [], 0
    for i in range(count):
        width = (64 - start) // (count - i)
        bands.append(F.shiftrightunsigned(c, start).bitwiseAND(F.lit((1 << width) - 1)))
        start += width
    return bands


def _pair_keys(c: Column, limit: int) -> Column:
    """Every pair of limit + 2 bands with its bits: hashes within the limit differ in `limit` bands at most, so two agree."""
    bands = hash_bands(c, limit + 2)
    pairs = list(itertools.combinations(range(limit + 2), 2))
    return F.array(*[F.xxhash64(F.lit(k), bands[a], bands[b]) for k, (a, b) in enumerate(pairs)])


def _selective(limit: int) -> bool:
    """Whether keys of two bands let through a small share of unrelated hashes."""
    return math.comb(limit + 2, 2) * 2.0 ** (-128 / (limit + 2)) < 0.1


def _near(own: Column, known: Column, limit: int) -> Column:
    return F.bit_count(own.bitwiseXOR(known)) <= limit


def indexed_pairs(images: DataFrame, known: DataFrame, key: str, phash: str, limit: int) -> DataFrame:
    """key, own and known hash of the rows that share a pair of bands; a pair may come more than once."""
    left = images.select(key, F.col(phash).alias("__own"), F.explode(_pair_keys(F.col(phash), limit)).alias("__key"))
    right = known.select("__known", F.explode(_pair_keys(F.col("__known"), limit)).alias("__key"))
    return left.join(right, "__key").select(key, "__own", "__known")


def placeholder_join(
    images: DataFrame, placeholders: DataFrame, key: str, phash: str = "phash", limit: int = fixed.MAX_HAMMING, block: int = BLOCK
) -> DataFrame:
    """Keys of the images within `limit` bits of any placeholder. Exact in each of its forms.

    Up to `block` known hashes go to every task as one array (their count is checked). More are met through an index on pairs
    of agreeing bands, if the limit leaves these selective, else in blocks of about `block`, each an array of its own.

    placeholders: phash.
    """
    known = placeholders.select(F.col(phash).alias("__known")).filter("__known IS NOT NULL").distinct()
    count = known.count()
    own = F.col(phash)
    if count > block and _selective(limit):
        return indexed_pairs(images, known, key, phash, limit).filter(_near(F.col("__own"), F.col("__known"), limit)).select(key).distinct()
    blocks = max(1, -(-count // block))
    spread = _SPREAD if blocks > 1 else 1
    arrays = known.groupBy(F.pmod(F.xxhash64("__known"), F.lit(blocks)).cast("int").alias("__block")).agg(F.collect_list("__known").alias("__all"))
    left = images.select(
        key, own.alias("__own"), F.pmod(F.xxhash64(key, own), F.lit(spread)).cast("int").alias("__part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("__block")
    )
    arrays = arrays.select("__block", "__all", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("__part"))
    met = left.join(F.broadcast(arrays) if blocks == 1 else arrays, ["__block", "__part"])  # one array of `block` numbers at most
    return met.filter(F.exists("__all", lambda k: _near(F.col("__own"), k, limit))).select(key).distinct()


def mark_placeholders(images: DataFrame, placeholders: DataFrame, key: str, limit: int = fixed.MAX_HAMMING) -> DataFrame:
    hits = placeholder_join(images, placeholders, key, limit=limit).withColumn("is_placeholder", F.lit(True))
    return images.join(hits, key, "left").withColumn("is_placeholder", F.coalesce("is_placeholder", F.lit(False)))


def best_image(metrics: DataFrame, key: list[str], order: str, min_sharpness: float = fixed.MIN_SHARPNESS) -> DataFrame:
    """Best usable image per key: largest area, then sharpest, then first.

    metrics: key, order, url, area, sharpness, is_placeholder.
    """
    usable = metrics.filter(~F.col("is_placeholder") & (F.col("sharpness") >= min_sharpness) & ~blank_text(F.col("url")))
    picked = usable.groupBy(*key).agg(
        F.max_by(F.struct("url", "area", "sharpness"), F.struct(F.col("area"), F.col("sharpness"), -F.col(order))).alias("b")
    )
    return picked.select(*key, "b.url", "b.area", "b.sharpness")
