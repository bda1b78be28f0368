"""Benchmark passages in documents: shared q-grams counted in diagonal bands, banded alignment of what meets the bound."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrays import free_name, mix, powers, slices, utf8, with_arrow

_U = np.uint64
_TABLE = 1 << 22
FOUND = "struct<item_id: bigint, start: bigint, `end`: bigint, edits: int>"


@lru_cache(1)
def _fold() -> np.ndarray:
    """Lower case of the code points below 2**16 that stay one character; white space as a blank."""
    out = np.arange(1 << 16, dtype=np.uint32)
    for c in range(1 << 16):
        if not 0xD800 <= c < 0xE000:
            low = chr(c).lower()
            out[c] = 32 if chr(c).isspace() else ord(low) if len(low) == 1 else c
    return out


def normalize(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded code points of all texts with runs of blanks as one, the offsets of the texts, and each one's place in its text."""
    data, at = utf8(texts)
    code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    firsts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at] if len(data) else np.zeros(len(at), np.int64)
    code = np.where(code < (1 << 16), _fold()[np.minimum(code, (1 << 16) - 1)], code)
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 32) | (code[:-1] != 32)
    keep[firsts[:-1][firsts[:-1] < len(code)]] = True
    place = np.flatnonzero(keep)
    bounds = np.searchsorted(place, firsts)
    return code[keep], bounds, place - np.repeat(firsts[:-1], np.diff(bounds))


def grams(code: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q code points from each place on."""
    n = len(code) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(code) + 1)
    sums = np.zeros(len(code) + 1, np.uint64)
    np.cumsum((code.astype(np.uint64) * _U(0x9E3779B97F4A7C15) ^ _U(0x5851F42D4C957F2D)) * up[: len(code)], out=sums[1:])
    return mix((sums[q:] - sums[:n]) * down[:n])


@dataclass
class Index:
    """Segments of benchmark texts and where each of their q-grams stands."""

    q: int
    rate: float
    items: np.ndarray  # item of each segment
    segments: list[np.ndarray]
    hashes: np.ndarray
    first: np.ndarray  # of each hash in segment and place
    segment: np.ndarray
    place: np.ndarray
    near: np.ndarray  # a bit for each hash modulo its size
    exact: int  # a segment shorter than this stands for a whole short text, which is matched as it is between word borders

    def budget(self) -> np.ndarray:
        return np.array([int(len(s) * self.rate) if len(s) >= self.exact else 0 for s in self.segments], np.int64)

    def least(self) -> np.ndarray:
        """Shared q-grams of a match: each edit spoils q of them at most."""
        return np.array([len(s) + 1 - self.q for s in self.segments], np.int64) - self.q * self.budget()


def build(rows: list[tuple[int, str]], q: int, rate: float, segment_chars: int, min_chars: int) -> Index:
    items, segments = [], []
    for item, text in rows:
        code, _, _ = normalize(pa.array([text.strip()]))
        if len(code) < q:
            continue
        last = max(0, len(code) - segment_chars)
        firsts = np.linspace(0, last, 1 + -(-last * 2 // segment_chars)).astype(np.int64)  # half a segment apart at most
        segments += [code[a : a + segment_chars] for a in firsts]
        items += [item] * len(firsts)
    hashes = [grams(s, q) for s in segments]
    flat = np.concatenate([np.zeros(0, np.uint64), *hashes])
    segment = np.repeat(np.arange(len(segments)), [len(h) for h in hashes])
    place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(h)) for h in hashes]])
    order = np.argsort(flat, kind="stable")
    distinct, first = np.unique(flat[order], return_index=True)
    near = np.zeros(_TABLE, bool)
    near[(distinct & _U(_TABLE - 1)).astype(np.int64)] = True
    return Index(q, rate, np.array(items, np.int64), segments, distinct, np.append(first, len(flat)), segment[order], place[order], near, min_chars)


def align(pattern: np.ndarray, text: np.ndarray, shift: int, budget: int) -> tuple[int, int]:
    """Fewest edits between the pattern and a stretch of the text, and the stretch's end; places beyond the band are not tried.

    The band: the pattern's place i meets text places from i to i + shift. Edits beyond the budget are not told apart.
    """
    far = budget + 1
    steps = np.arange(shift + 1)
    score = np.zeros(shift + 1, np.int64)  # column k: text end at i + k
    for i in range(len(pattern)):
        at = i + steps
        inside = at < len(text)
        cost = np.where(inside, text[np.minimum(at, len(text) - 1)] != pattern[i], far)
        now = score + cost
        now[:-1] = np.minimum(now[:-1], score[1:] + 1)
        now = np.minimum.accumulate(now - steps) + steps
        score = np.minimum(now, far)
        if score.min() >= far:
            return far, 0
    k = int(score.argmin())
    return int(score[k]), min(len(pattern) + k, len(text))


def _verified(segment: np.ndarray, part: np.ndarray, budget: int) -> tuple[int, int, int] | None:
    """First place, end and edits of the segment's best match in a part of a text, or None beyond the budget."""
    size = len(segment)
    whole, wanted, same = part.tobytes(), segment.tobytes(), -1
    while (same := whole.find(wanted, same + 1)) >= 0:
        if same % 4 == 0:
            return same // 4, same // 4 + size, 0
    edits, end = align(segment, part, max(0, len(part) - size) + budget, budget)
    if edits > budget:
        return None
    _, back = align(segment[::-1], part[:end][::-1], max(0, end - size) + budget, budget)
    return max(0, end - back), end, edits


def _matches(index: Index, texts: pa.Array) -> list[list[tuple[int, int, int, int]]]:
    out: list[list] = [[] for _ in range(len(texts))]
    code, at, place = normalize(texts)
    hashes = grams(code, index.q)
    if not len(hashes) or not len(index.segments):
        return out
    near = index.near[(hashes & _U(_TABLE - 1)).astype(np.int64)]
    hit = np.flatnonzero(near)
    k = np.minimum(np.searchsorted(index.hashes, hashes[hit]), len(index.hashes) - 1)
    true = index.hashes[k] == hashes[hit]
    hit, k = hit[true], k[true]
    budget, least = index.budget(), index.least()
    sizes = np.array([len(s) for s in index.segments])
    # a match of a segment lies in size + budget places, so one of the stretches of `span` places there holds its share of hits
    span = int(sizes.min() + budget[sizes.argmin()])
    share = int((-(-least // -(-(sizes + budget) // span))).min())
    if share > 1:
        dense = hit[share - 1 :] - hit[: len(hit) - share + 1] < span if len(hit) >= share else np.zeros(0, bool)
        reach = int((sizes + budget).max())
        marks = np.zeros(len(code) + 1, np.int64)
        starts = hit[: len(hit) - share + 1][dense] if len(hit) >= share else hit[:0]
        np.add.at(marks, np.maximum(starts - reach, 0), 1)
        np.add.at(marks, np.minimum(starts + reach + span, len(code)), -1)
        keep = np.cumsum(marks)[hit] > 0
        hit, k = hit[keep], k[keep]
    many = index.first[k + 1] - index.first[k]
    total = int(many.sum())
    if not total:
        return out
    where = np.repeat(index.first[k] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(total)
    segment, diagonal = index.segment[where], np.repeat(hit, many) - index.place[where] + 4096
    width = budget[segment] + 1
    band = diagonal // width
    code_band = np.concatenate([segment * (1 << 32) + band, segment * (1 << 32) + band - 1])  # bands of two widths, one apart
    bands, n = np.unique(code_band, return_counts=True)
    good = bands[n >= least[bands >> 32]]
    seen: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for key in good.tolist():
        s, b = key >> 32, key & 0xFFFFFFFF
        e, size = int(budget[s]), len(index.segments[s])
        low, high = b * (e + 1) - 4096, (b + 2) * (e + 1) - 4096 - 1  # of the diagonals
        middle = min(max((low + high + size) // 2, 0), len(code) - 1)
        row = int(np.searchsorted(at, middle, side="right")) - 1
        for r in {row, max(row - 1, 0), min(row + 1, len(texts) - 1)}:
            a, z = max(low - e, int(at[r])), min(high + size + e, int(at[r + 1]))
            if z - a < size - e or any(a <= x and y <= z for x, y in seen.get((r, s), ())):
                continue
            part = code[a:z]
            span = _verified(index.segments[s], part, e) if size >= index.exact else _between_words(index.segments[s], code, a, z, int(at[r]), int(at[r + 1]))
            if span:
                first, end, edits = span
                seen.setdefault((r, s), []).append((a + first, a + end))
                out[r].append((int(index.items[s]), int(place[a + first]), int(place[a + end - 1]) + 1, edits))
    return [_merged(r) for r in out]


def _between_words(segment: np.ndarray, code: np.ndarray, a: int, z: int, first: int, last: int) -> tuple[int, int, int] | None:
    """As `_verified` in the places a to z of a text first to last: equal, and no letter or digit goes on before or after."""
    size = len(segment)
    for k in np.flatnonzero(code[a : z - size + 1] == segment[0]).tolist() if z - a >= size else ():
        x, y = a + k, a + k + size
        inside = (x > first and chr(code[x - 1]).isalnum() and chr(code[x]).isalnum()) or (y < last and chr(code[y]).isalnum() and chr(code[y - 1]).isalnum())
        if not inside and np.array_equal(code[x:y], segment):
            return k, k + size, 0
    return None


def _merged(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Matches of one item that overlap as one, with the most edits that any of them has."""
    out: list[tuple[int, int, int, int]] = []
    for item, a, b, edits in sorted(set(found)):
        if out and out[-1][0] == item and a < out[-1][2]:
            _, first, end, most = out.pop()
            a, b, edits = first, max(end, b), max(most, edits)
        out.append((item, a, b, edits))
    return out


def find(
    docs: DataFrame, benchmark: DataFrame, text: str | Column = "text", out: str = "leaks", q: int = 8, rate: float = 0.08, segment_chars: int = 120,
    min_chars: int = 32, block_chars: int = 1 << 22,
) -> DataFrame:
    """All rows and columns of docs with an array of benchmark passages found: item_id, start, end (code points), edits.

    Texts are compared in lower case with white space runs as one blank. A benchmark text is cut into segments of
    segment_chars (one, if shorter) that overlap by half at least, so any part copy of one and a half segments holds a whole one; a segment of
    m characters is found where a stretch of the document is within rate * m edits. The q-gram lemma leaves the diagonal
    bands with m + 1 - q - q * edits shared q-grams; banded alignment decides. Overlapping matches of one item are one,
    with the most edits of any of its segments. Benchmark texts of under min_chars characters must occur as they are,
    between word borders; those of under q characters, which are words rather than passages, null ones and null item ids
    take no part; repeated ones count once. The benchmark is taken in blocks of about block_chars characters, so what is sent to the tasks is bounded
    whatever its size. Null and empty texts give an empty array; an empty benchmark finds nothing; a column named as the
    result is replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("text")).filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    n_blocks = max(1, -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars))
    source = F.col(text) if isinstance(text, str) else text
    kind = pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])
    name, found = free_name(docs, "_leaks"), docs
    for block in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).orderBy("item_id", "text").collect()
        held = spark.sparkContext.broadcast(build([tuple(r) for r in rows], q, rate, segment_chars, min_chars))

        def fn(texts: pa.Array, held=held) -> pa.Array:
            lists = [x for a, b in slices(texts) for x in _matches(held.value, texts.slice(a, b - a))]
            return pa.array([[dict(zip(kind.names, m, strict=True)) for m in x] for x in lists], pa.list_(kind))

        found = with_arrow(found, f"{name}{block}", [source], f"array<{FOUND}>", _one(fn))
    every = F.concat(*[F.col(f"{name}{b}") for b in range(n_blocks)])
    return (found if out == text else found.drop(out)).withColumn(out, every).drop(*[f"{name}{b}" for b in range(n_blocks)])


def _one(fn):
    """The function of one argument only."""

    def call(texts: pa.Array) -> pa.Array:
        return fn(texts)

    return call
