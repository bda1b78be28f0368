"""Texts as numpy arrays: slices of Arrow batches, words, shingles and 64-bit hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SLICE_BYTES = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i below n at least."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.full(size, _U(base))
            out[0] = 1
            _powers[name] = np.cumprod(out, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array end to end, and its offsets; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = texts.buffers()
    at = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes each; a longer text is a range of its own."""
    _, at = utf8(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, min(last, len(texts))
        first = last


def words(data: np.ndarray, at: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and end byte of every word (bytes other than those of `space`, ASCII white space; A-Z in lower case)."""
    out: list[tuple[np.ndarray, ...]] = []
    n, begin = len(data), 0
    cuts = np.zeros(n + 1, bool)
    cuts[at] = True
    while begin < n:
        end = min(n, begin + SLICE_BYTES)
        if end < n:  # not inside a word
            gap = np.flatnonzero(space[data[begin:end]])
            if len(gap):
                end = begin + int(gap[-1]) + 1
            else:
                ahead = end
                while ahead < n and not space[data[ahead]]:
                    more = np.flatnonzero(space[data[ahead : ahead + SLICE_BYTES]])
                    ahead = ahead + int(more[0]) if len(more) else min(n, ahead + SLICE_BYTES)
                end = ahead
        part = data[begin:end]
        ink = ~space[part]
        first = ink.copy()
        first[1:] &= space[part[:-1]] | cuts[begin + 1 : end]
        last = ink.copy()
        last[:-1] &= space[part[1:]] | cuts[begin + 1 : end]
        a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[LOWER[part]] * up[: len(part)], out=sums[1:])
        out.append((mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)), a + begin, b + begin))
        begin = end
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; of the whole sequence if it has fewer."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    out = np.full(len(hashes) - size + 1, _U(size))
    for k in range(size):
        out = mix(out * _U(_BASE) + hashes[k : len(hashes) - size + 1 + k])
    return out


def word_ranges(at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For every text the number of words before it (with the total at the end)."""
    return np.searchsorted(starts, at)


def with_arrow(df: DataFrame, name: str, inputs: list[Column], kind: str, fn: Callable[..., pa.Array]) -> DataFrame:
    """The frame with a column computed by fn from Arrow arrays. Planned once and never pushed or repeated."""
    return df.withColumn(name, F.arrow_udf(fn, kind).asNondeterministic()(*inputs))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name the frame does not have."""
    have = {c.lower() for c in df.columns}
    while wanted.lower() in have:
        wanted += "_"
    return wanted
