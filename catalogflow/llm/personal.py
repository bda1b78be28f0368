"""Personal data: patterns, and a character-level bidirectional LSTM with CRF transitions trained on what they label."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .arrays import free_name, slices, utf8, with_arrow

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
SPAN = "struct<kind string, start bigint, `end` bigint, base boolean, score double>"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")  # a run of digits matches from its first digit or not at all
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GATE = np.zeros(256, bool)
_GATE[[*range(48, 58), 64]] = True
_SIGNS = "@._-%+()/:,;'\"\n "
PAD, N_CLASSES = 0, 7 + len(_SIGNS)


def _luhn(digits: str) -> bool:
    odd = [int(c) for c in digits[::-1]]
    return sum(odd[::2] + [d * 2 - 9 * (d > 4) for d in odd[1::2]]) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _passes(kind: int, text: str) -> bool:
    """The check that a match of a kind has to pass."""
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))
    if kind == 2:
        digits = _digits(text)
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return kind == 0 or 9 <= len(_digits(text)) <= 15


def patterns(text: str, checked: bool = True) -> list[tuple[int, int, int]]:
    """Kind number, start and end of each match, leftmost and non-overlapping per kind.

    Failing matches are dropped; unchecked, card numbers with a wrong check digit stay (no tagger can learn that digit).
    """
    out = []
    at, free = text.find("@"), 0
    while at >= 0:  # the local part before an @ is the run of its characters
        a = at
        while a > free and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append((0, a, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if _passes(kind, m[0]) or not checked and kind == 2 and 13 <= len(_digits(m[0])) <= 19]
    return out


def classes(text: str) -> np.ndarray:
    """Class of each character: letters, digits and signs apart; 0 is padding."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full(len(code), 6, np.uint8)
    out[code >= 128] = 5
    out[(code >= 97) & (code <= 122)] = 1
    out[(code >= 65) & (code <= 90)] = 2
    out[(code >= 48) & (code <= 57)] = 3
    out[code == 48] = 4
    for k, c in enumerate(_SIGNS):
        out[code == ord(c)] = 7 + k
    return out


def windows(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First positions and padded class rows of the overlapping windows that hold a digit or an @ (no kind can do without)."""
    hit = np.flatnonzero((ids == 3) | (ids == 4) | (ids == 7))
    last = max(0, (len(ids) - STRIDE - 1) // STRIDE)
    at = np.unique(np.concatenate([hit // STRIDE, np.maximum(hit // STRIDE - 1, 0)]))
    at = np.unique(np.minimum(at, last)) * STRIDE
    padded = np.concatenate([ids, np.zeros(WINDOW, np.uint8)])
    return at, padded[at[:, None] + np.arange(WINDOW)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


@dataclass
class Tagger:
    """Weights: per direction input rows, recurrence and bias (gates in, forget, out, new), then output and transitions."""

    w: dict[str, np.ndarray]

    @staticmethod
    def fresh(hidden: int, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            w["x" + d] = rng.normal(0, 0.3, (N_CLASSES, 4 * hidden))
            w["h" + d] = rng.normal(0, 0.5 / hidden**0.5, (hidden, 4 * hidden))
            w["c" + d] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
        w["o"] = rng.normal(0, 0.2, (2 * hidden, TAGS))
        w["ob"] = np.zeros(TAGS)
        w["t"] = np.zeros((TAGS, TAGS))
        return Tagger(w)

    def _run(self, ids: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        x, u, bias = self.w["x" + d], self.w["h" + d], self.w["c" + d]
        hidden, n = len(u), len(ids)
        h, c = np.zeros((n, hidden)), np.zeros((n, hidden))
        out = np.zeros((n, ids.shape[1], hidden))
        for t in range(ids.shape[1]) if d == "f" else range(ids.shape[1] - 1, -1, -1):
            z = x[ids[:, t]] + h @ u + bias
            g = _sigmoid(z[:, : 3 * hidden])
            new = np.tanh(z[:, 3 * hidden :])
            before, held = c, h
            c = g[:, hidden : 2 * hidden] * c + g[:, :hidden] * new
            tc = np.tanh(c)
            h = g[:, 2 * hidden :] * tc
            out[:, t] = h
            if keep is not None:
                keep.append((t, g, new, before, tc, held))
        return out

    def emissions(self, ids: np.ndarray, keep: dict[str, list] | None = None) -> np.ndarray:
        both = np.concatenate([self._run(ids, d, None if keep is None else keep[d]) for d in "fb"], 2)
        if keep is not None:
            keep["both"] = both
        return both @ self.w["o"] + self.w["ob"]

    def marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of each tag at each place, expected transitions, and log of the normalizer."""
        n, steps, _ = e.shape
        t = self.w["t"]
        a, b = np.zeros_like(e), np.zeros_like(e)
        a[:, 0] = e[:, 0]
        for k in range(1, steps):
            a[:, k] = e[:, k] + _sum_exp(a[:, k - 1, :, None] + t, 1)
        for k in range(steps - 2, -1, -1):
            b[:, k] = _sum_exp(t + (e[:, k + 1] + b[:, k + 1])[:, None, :], 2)
        z = _sum_exp(a[:, -1], 1)
        pairs = np.zeros_like(t)
        for k in range(1, steps):
            pairs += np.exp(a[:, k - 1, :, None] + t + (e[:, k] + b[:, k])[:, None, :] - z[:, None, None]).sum(0)
        return np.exp(a + b - z[:, None, None]), pairs, z

    def decode(self, e: np.ndarray) -> np.ndarray:
        n, steps, _ = e.shape
        back = np.zeros(e.shape, np.int8)
        score = e[:, 0]
        for k in range(1, steps):
            all_ = score[:, :, None] + self.w["t"]
            back[:, k] = all_.argmax(1)
            score = all_.max(1) + e[:, k]
        tags = np.zeros((n, steps), np.int8)
        tags[:, -1] = score.argmax(1)
        for k in range(steps - 1, 0, -1):
            tags[:, k - 1] = back[np.arange(n), k, tags[:, k]]
        return tags

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        """Of the mean negative log likelihood of the tags."""
        keep: dict = {"f": [], "b": []}
        e = self.emissions(ids, keep)
        n, steps, _ = e.shape
        p, pairs, z = self.marginals(e)
        rows = np.arange(n)[:, None]
        gold = e[rows, np.arange(steps), tags].sum(1) + self.w["t"][tags[:, :-1], tags[:, 1:]].sum(1)
        de = p
        de[rows, np.arange(steps), tags] -= 1
        np.add.at(pairs, (tags[:, :-1], tags[:, 1:]), -1)
        de /= n
        both = keep["both"]
        out = {"t": pairs / n, "o": np.einsum("nsh,nst->ht", both, de), "ob": de.sum((0, 1))}
        dboth = de @ self.w["o"].T
        hidden = both.shape[2] // 2
        for d, dh_all in (("f", dboth[..., :hidden]), ("b", dboth[..., hidden:])):
            u = self.w["h" + d]
            dx, du, db = np.zeros_like(self.w["x" + d]), np.zeros_like(u), np.zeros(4 * hidden)
            dh, dc = np.zeros((n, hidden)), np.zeros((n, hidden))
            for t, g, new, before, tc, held in reversed(keep[d]):
                i, f, o = g[:, :hidden], g[:, hidden : 2 * hidden], g[:, 2 * hidden :]
                dh = dh + dh_all[:, t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * new * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - new * new)], 1)
                dx += np.eye(N_CLASSES)[ids[:, t]].T @ dz
                du += held.T @ dz
                db += dz.sum(0)
                dh, dc = dz @ u.T, dc * f
            out |= {"x" + d: dx, "h" + d: du, "c" + d: db}
        return out, float((z - gold).mean())


def fit(ids: np.ndarray, tags: np.ndarray, hidden: int = 16, epochs: int = 8, batch: int = 32, rate: float = 0.02, seed: int = 7) -> Tagger:
    """A tagger trained with Adam at a falling rate; the same rows in the same order give the same weights."""
    model, rng = Tagger.fresh(hidden, seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.w.items()}
    s = {k: np.zeros_like(v) for k, v in model.w.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(ids))
        for a in range(0, len(ids), batch):
            part = order[a : a + batch]
            grads, _ = model.gradients(ids[part], tags[part])
            size = sum(float((g * g).sum()) for g in grads.values()) ** 0.5
            now = rate * (1 - 0.95 * step / (epochs * -(-len(ids) // batch)))
            step += 1
            for k, g in grads.items():
                g = g * min(1, 5 / (size + 1e-9))
                m[k] += 0.1 * (g - m[k])
                s[k] += 0.01 * (g * g - s[k])
                model.w[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)
    return model


def _labels(spans: list[tuple[int, int, int]], n: int) -> np.ndarray:
    out = np.zeros(n, np.int8)
    for kind, a, b in sorted(spans, key=lambda s: (s[0] == 2, s[1])):
        if not out[a:b].any():
            out[a:b] = 2 + 2 * kind
            out[a] = 1 + 2 * kind
    return out


def _examples(text: str) -> Iterator[tuple[int, bytes, bytes]]:
    """Stratum, classes and tags of each window of a text; a phone number also without its + and country code."""
    spans = patterns(text, checked=False)
    ids, tags = classes(text), _labels(spans, len(text))
    views = [(ids, tags)]
    if short := [(a, m.end() - 1) for k, a, b in spans if k == 3 and (m := re.match(r"\+[0-9]{1,3}[ (]+[0-9]", text[a:b])) and (m := re.compile(r"\+[0-9]{1,3} *\(?").match(text, a))]:
        keep, tags2 = np.ones(len(ids), bool), tags.copy()
        for a, c in short:
            c = c if text[c] == "(" else c + 1
            keep[a:c] = False
            tags2[c] = 1 + 2 * 3
        views.append((ids[keep], tags2[keep]))
    for x, y in views:
        at, rows = windows(x)
        tail = np.concatenate([y, np.zeros(WINDOW, np.int8)])
        for k, row in zip(at, rows, strict=True):
            own = tail[k : k + WINDOW]
            yield int(own.max() + 1) // 2, row.tobytes(), own.tobytes()


def _gated(texts: pa.Array) -> Iterator[tuple[int, str]]:
    """Row number and text of those with a digit or an @."""
    for a, b in slices(texts):
        data, at = utf8(texts.slice(a, b - a))
        sums = np.concatenate([[0], np.cumsum(_GATE[data])])
        for k in np.flatnonzero(sums[at[1:]] > sums[at[:-1]]):
            yield a + int(k), data[at[k] : at[k + 1]].tobytes().decode("utf-8")


def train(docs: DataFrame, text: str = "text", windows_per_kind: int = 150, **fitting) -> Tagger:
    """A tagger trained on windows of the documents, labelled by the patterns.

    windows_per_kind bounds the sample: so many windows of each kind and twice as many without any, by smallest hash.
    Where no document holds a digit or an @ the tagger is untrained and finds nothing.
    """

    def sample(batches):
        for batch in batches:
            rows = [x for _, t in _gated(batch.column(0)) for x in _examples(t)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), [pa.int32(), pa.binary(), pa.binary()], strict=True)], ["kind", "ids", "tags"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(sample, "kind int, ids binary, tags binary")
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("ids", "tags"), "ids", "tags"))
    chosen = found.withColumn("place", place).filter(F.col("place") <= F.when(F.col("kind") == 0, 2 * windows_per_kind).otherwise(windows_per_kind))
    rows = chosen.filter(F.col("place") <= 2 * windows_per_kind).select("ids", "tags").orderBy("ids", "tags").toArrow()  # at most 6 windows_per_kind rows
    if not rows.num_rows:
        return Tagger({})
    ids = np.stack([np.frombuffer(x.as_py(), np.uint8) for x in rows["ids"]])
    tags = np.stack([np.frombuffer(x.as_py(), np.int8) for x in rows["tags"]]).astype(np.int64)
    return fit(ids, tags, **fitting)


def _spans(tags: np.ndarray) -> Iterator[tuple[int, int, int]]:
    at = 0
    while at < len(tags):
        tag = int(tags[at])
        end = at + 1
        if tag % 2:
            while end < len(tags) and tags[end] == tag + 1:
                end += 1
            yield tag // 2, at, end
        at = end


def _plausible(kind: int, text: str) -> bool:
    if kind == 0:
        return bool(re.fullmatch(r"[^\s@]+@[^\s@]+\.[^\s@.]+", text))
    if kind == 1 and not re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", text):
        return False
    return _passes(kind, text)


def reconcile(spans: dict[tuple[int, int, int], float]) -> list[tuple[int, int, int]]:
    """The set of non-overlapping spans with the greatest total weight, over the whole text."""
    order = sorted(spans, key=lambda s: (s[2], s[1], s[0]))
    ends = np.array([s[2] for s in order])
    best, take = [0.0], []
    for k, s in enumerate(order):
        j = int(np.searchsorted(ends[:k], s[1], side="right"))
        with_it = best[j] + spans[s]
        take.append((with_it > best[k], j))
        best.append(max(best[k], with_it))
    out, k = [], len(order)
    while k:
        used, j = take[k - 1]
        if used:
            out.append(order[k - 1])
        k = j if used else k - 1
    return out[::-1]


def detect_texts(model: Tagger, texts: pa.Array, sure: float) -> list[list[tuple[str, int, int, bool, float]]]:
    out: list[list] = [[] for _ in range(len(texts))]
    held = []
    for row, text in _gated(texts):
        held.append((row, text, patterns(text), *windows(classes(text))))
        if sum(len(x[4]) for x in held) >= 2048:
            _tag(model, held, out, sure)
            held = []
    if held:
        _tag(model, held, out, sure)
    return out


def _tag(model: Tagger, held: list[tuple], out: list[list], sure: float) -> None:
    tags, least = [], []
    if model.w:
        whole = np.concatenate([x[4] for x in held])
        for a in range(0, len(whole), 2048):
            e = model.emissions(whole[a : a + 2048])
            y = model.decode(e)
            tags.append(y)
            least.append(np.take_along_axis(model.marginals(e)[0], y[..., None].astype(np.int64), 2)[..., 0])
        tags, least = np.concatenate(tags), np.concatenate(least)
    first = 0
    for row, text, base, at, rows in held:
        votes: dict[tuple[int, int, int], float] = {}
        for k in range(len(at)) if model.w else ():
            for kind, a, b in _spans(tags[first + k]):
                start, end = int(at[k]) + a, int(at[k]) + b
                whole_span = (a > 0 or at[k] == 0) and (b < WINDOW or end >= len(text)) and end <= len(text)
                score = float(least[first + k, a:b].min())
                if whole_span and score >= sure and _plausible(kind, text[start:end]):
                    votes[kind, start, end] = votes.get((kind, start, end), 0.0) + score
        first += len(at)
        starts = sorted((a, b) for _, a, b in base)
        spans = [(KINDS[k], a, b, True, 1.0) for k, a, b in base]
        for kind, a, b in reconcile(votes):
            if not any(x < b and a < y for x, y in starts):
                spans.append((KINDS[kind], a, b, False, min(1.0, votes[kind, a, b])))
        out[row] = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def detect(docs: DataFrame, model: Tagger, text: str | Column = "text", out: str = "personal", sure: float = 0.98) -> DataFrame:
    """All rows and columns of docs with an array of spans: kind, start, end (code points), base, score.

    Whole texts are read. Every match of the patterns is a base span. The tagger runs over all overlapping windows that
    hold a digit or an @; its spans count where every character is at least `sure`, and the set of non-overlapping ones
    with most weight over the whole text is added where no base span lies. Ordered by kind as in KINDS, then start.
    Null and empty texts give an empty array; repeated rows equal ones; a column named as the result is replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # of a size fixed by its parameters
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])

    def fn(texts: pa.Array) -> pa.Array:
        rows = detect_texts(held.value, texts, sure)
        return pa.array([[dict(zip(kind.names, s, strict=True)) for s in r] for r in rows], pa.list_(kind))

    name = free_name(docs, "_personal")
    found = with_arrow(docs, name, [F.col(text) if isinstance(text, str) else text], f"array<{SPAN}>", fn)
    return (found if out == text else found.drop(out)).withColumn(out, F.col(name)).drop(name)
