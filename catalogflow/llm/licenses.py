"""License scans: patience alignment of texts with license notices."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrays import free_name, slices, utf8, with_arrow, word_ranges, words
from .license_texts import TEMPLATES

_U = np.uint64
_TABLE = 1 << 16
_NOT_WORD = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
FOUND = "struct<license: string, start: bigint, `end`: bigint, coverage: double>"


def _rising(values: list[int]) -> list[int]:
    """Indexes of a longest strictly rising subsequence."""
    tops: list[int] = []
    last: list[int] = []
    before = []
    for k, v in enumerate(values):
        at = bisect_left(tops, v)
        before.append(last[at - 1] if at else -1)
        if at == len(tops):
            tops.append(v)
            last.append(k)
        else:
            tops[at], last[at] = v, k
    out = []
    k = last[-1] if last else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def _common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """A longest common subsequence of a gap without anchors."""
    best = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    other = np.array(b)
    for i in range(len(a) - 1, -1, -1):
        take = np.where(other == a[i], best[i + 1, 1:] + 1, best[i + 1, :-1])
        best[i, :-1] = np.maximum.accumulate(take[::-1])[::-1]
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j] and best[i, j] == best[i + 1, j + 1] + 1:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i, j] == best[i, j + 1]:
            j += 1
        else:
            i += 1
    return out


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of places of equal words in order: words unique in both anchor, gaps are aligned in turn."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, n, j, m = work.pop()
        while i < n and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < n and j < m and a[n - 1] == b[m - 1]:
            n, m = n - 1, m - 1
            out.append((n, m))
        if i >= n or j >= m:
            continue
        one, two = Counter(a[i:n]), Counter(b[j:m])
        where = {w: k for k, w in enumerate(b[j:m], j) if two[w] == 1}
        sole = [(k, where[w]) for k, w in enumerate(a[i:n], i) if one[w] == 1 and w in where]
        if not sole:
            out += [(i + x, j + y) for x, y in _common(a[i:n], b[j:m])]
            continue
        anchors = [sole[k] for k in _rising([y for _, y in sole])]
        out += anchors
        edges = [(i - 1, j - 1), *anchors, (n, m)]
        work += [(x + 1, x2, y + 1, y2) for (x, y), (x2, y2) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def _words(text: str) -> np.ndarray:
    data, at = utf8(pa.array([text]))
    return words(data, at, _NOT_WORD)[0]


class Notices:
    """The words of the templates, how often each template has them, and its telling words."""

    def __init__(self, templates: list[tuple[str, ...]]):
        self.names = [name for name, *_ in templates]
        self.words = [_words(text) for _, text, *_ in templates]
        self.telling = [_words(" ".join(more)) for _, _, *more in templates]
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.words]))
        self.counts = np.zeros((len(self.vocabulary), len(templates)), np.int64)
        for k, w in enumerate(self.words):
            np.add.at(self.counts[:, k], np.searchsorted(self.vocabulary, w), 1)
        self.must = np.zeros(self.counts.shape, np.int64)
        for k, w in enumerate(self.telling):
            if not np.isin(w, self.words[k]).all():
                raise ValueError(f"a telling word of {self.names[k]} is not in its notice")
            self.must[np.searchsorted(self.vocabulary, w), k] = 1
        self.near = np.zeros(_TABLE, bool)
        self.near[(self.vocabulary & _U(_TABLE - 1)).astype(np.int64)] = True


def _tells(telling: list[int], template: list[int], match: list[tuple[int, int]]) -> bool:
    """Whether the telling words are matched in one piece, with nothing between them in the text."""
    m = len(telling)
    for k in range(len(match) - m + 1):
        i, j = match[k]
        if match[k + m - 1] == (i + m - 1, j + m - 1) and template[i : i + m] == telling:
            return True
    return not m


def _best(found: list[tuple[int, str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Of overlapping notices the one with most words found, then the best covered, then by name."""
    out: list[tuple[str, int, int, float]] = []
    for _, name, a, b, coverage in sorted(set(found), key=lambda m: (-m[0], -m[4], m[1], m[2])):
        if not any(a < y and x < b for _, x, y, _ in out):
            out.append((name, a, b, coverage))
    return sorted(out, key=lambda m: (m[1], m[2], m[0]))


def _scan(notices: Notices, texts: pa.Array, least: float) -> list[list[tuple[str, int, int, float]]]:
    out: list[list] = [[] for _ in range(len(texts))]
    data, at = utf8(texts)
    hashes, starts, ends = words(data, at, _NOT_WORD)
    hit = np.flatnonzero(notices.near[(hashes & _U(_TABLE - 1)).astype(np.int64)])
    if not len(hit) or not len(notices.vocabulary):
        return out
    term = np.minimum(np.searchsorted(notices.vocabulary, hashes[hit]), len(notices.vocabulary) - 1)
    true = notices.vocabulary[term] == hashes[hit]
    hit, term = hit[true], term[true]
    first = word_ranges(at, starts)
    row = np.searchsorted(first, hit, side="right") - 1
    pairs = np.unique(row * len(notices.vocabulary) + term)
    there = np.zeros((len(texts), len(notices.names)), np.int64)
    np.add.at(there, pairs // len(notices.vocabulary), notices.counts[pairs % len(notices.vocabulary)])
    told = np.zeros_like(there)
    np.add.at(told, pairs // len(notices.vocabulary), notices.must[pairs % len(notices.vocabulary)])
    need = np.array([int(np.ceil(least * len(w))) for w in notices.words])
    for r, t in zip(*np.nonzero((there >= need) & (told >= notices.must.sum(0))), strict=True):
        own = hit[(row == r) & (notices.counts[term, t] > 0)]
        reach = len(notices.words[t]) * 3 // 2 + 4
        full = np.flatnonzero(np.searchsorted(own, own + reach) - np.arange(len(own)) >= need[t])
        template = notices.words[t].tolist()
        last = -1
        for k in full:  # stretches dense enough, each taken as far as it goes
            if own[k] <= last:
                continue
            a = int(own[k])
            z = min(a + reach, int(first[r + 1]))
            match = patience(template, hashes[a:z].tolist())
            if len(match) >= need[t] and _tells(notices.telling[t].tolist(), template, match):
                begin, last = a + match[0][1], a + match[-1][1]
                base = int(at[r])
                span = [len(data[base : int(x)].tobytes().decode("utf-8", "ignore")) for x in (starts[begin], ends[last])]
                out[r].append((len(match), notices.names[t], *span, len(match) / len(template)))
    return [_best(x) for x in out]


def scan(docs: DataFrame, text: str | Column = "text", out: str = "licenses", templates: list[tuple[str, ...]] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """All rows and columns of docs with an array of notices found: license, start, end (code points), coverage.

    Whole texts are read as words of letters and digits in lower case. A notice is found where a stretch of up to one and
    a half times its length aligns with `least` of its words in order, its telling words (name, version, kind: the third entry of
    a template, if any) among them in one piece, so that notices of one wording are told apart. Of overlapping notices the one with most words
    found stays. Only stretches that hold that many of its words are aligned, as no other can reach the coverage. The
    templates are a parameter held by every task. Null and empty texts give an empty array, repeated rows equal ones, an empty table
    none; a column named as the result is replaced. Order: start, end, license.
    """
    held = docs.sparkSession.sparkContext.broadcast(Notices(templates))
    kind = pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())])

    def fn(texts: pa.Array) -> pa.Array:
        lists = [x for a, b in slices(texts) for x in _scan(held.value, texts.slice(a, b - a), least)]
        return pa.array([[dict(zip(kind.names, m, strict=True)) for m in x] for x in lists], pa.list_(kind))

    name = free_name(docs, "_licenses")
    found = with_arrow(docs, name, [F.col(text) if isinstance(text, str) else text], f"array<{FOUND}>", fn)
    return (found if out == text else found.drop(out)).withColumn(out, F.col(name)).drop(name)
