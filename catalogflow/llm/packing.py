"""Packing of tokenized documents into fixed windows: length combinations whose repeats solve a non-negative least squares fit."""

from __future__ import annotations

import os
import sys
import unicodedata
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .arrays import mix, powers, slices, utf8, with_arrow

_U = np.uint64
_SLICE = 1 << 20
_CACHED_WORDS = 2_000_000
#: Unicode White_Space (fixed values)
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LETTER, NUMBER, OTHER, WHITE = range(4)

PIECE = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


@lru_cache(1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    out[_WHITE] = WHITE
    return out


def _word_starts(code: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where the byte-level pre-tokenizer begins a word: code points of several texts, and where each text begins."""
    n = len(code)
    kind = _classes()[code]
    edge = np.zeros(n + 1, bool)
    edge[firsts[firsts < n]] = True
    edge[n] = True
    run = edge[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    white = kind == WHITE
    start = run & white
    before_ink = np.zeros(n, bool)  # a white character followed by another kind in the same text
    before_ink[:-1] = white[:-1] & ~white[1:] & ~edge[1:n]
    start |= before_ink
    attached = np.zeros(n, bool)
    attached[1:] = before_ink[:-1] & (code[:-1] == 32)
    start |= run & ~white & ~attached
    if len(marks := np.flatnonzero((code == 39) & run & ~attached)):
        for i in marks:  # 's 't 'm 'd 're 've 'll
            if i + 1 < n and run[i + 1] and not edge[i + 1] and kind[i + 1] == LETTER:
                two = chr(code[i + 1]) + (chr(code[i + 2]) if i + 2 < n and not edge[i + 2] else "")
                size = 1 if two[0] in "stmd" else 2 if two in ("re", "ve", "ll") else 0
                if size:
                    start[i + 1] = False
                    if i + 1 + size < n:
                        start[i + 1 + size] = True
    return np.flatnonzero(start)


class Encoder:
    """Token ids of whole texts; every distinct word is tokenized once per worker.

    A byte-level BPE never merges across words, so a text's ids are those of its words one after another.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocab.values()) + 1, np.int64)
        for word, k in vocab.items():
            self.sizes[k] = len(word)  # one character for each byte
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes in order, and where each word's ids are
        self.place = np.zeros(0, np.int64)
        self.n_words = 0
        self.ids = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _add(self, hashes: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> None:
        """Words with their ids end to end and the end of each in ids."""
        n, size = self.n_words, self.used + len(ids)
        while size > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(hashes) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[self.used : size] = ids
        self.ends[n + 1 : n + 1 + len(hashes)] = self.used + ends
        order = np.argsort(hashes)
        at = np.searchsorted(self.known, hashes[order])
        self.known = np.insert(self.known, at, hashes[order])
        self.place = np.insert(self.place, at, n + order)
        self.used, self.n_words = size, n + len(hashes)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the words, -1 for new ones."""
        if not self.n_words:
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.known, hashes), self.n_words - 1)
        return np.where(self.known[at] == hashes, self.place[at], -1)

    def _learn(self, words: list[str], hashes: np.ndarray) -> None:
        joint = [k for k, w in enumerate(words) if len(w) > 1 and w[0] == " " and not w[1].isspace()]
        for a in range(0, len(joint), 2000):
            part = joint[a : a + 2000]
            ids = np.array(self.tokenizer.encode("".join(words[k] for k in part), add_special_tokens=False).ids, np.int64)
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(words[k].encode()) for k in part])) + 1
            self._add(hashes[part], ids, ends)
        if alone := sorted(set(range(len(words))) - set(joint)):
            lists = [x.ids for x in self.tokenizer.encode_batch_fast([words[k] for k in alone], add_special_tokens=False)]
            self._add(hashes[alone], np.array([i for x in lists for i in x], np.int64), np.cumsum([len(x) for x in lists]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offsets of the texts in them."""
        data, at = utf8(texts)
        whole = data.tobytes().decode("utf-8")
        if any(s in whole for s in self.special):  # they break words, so such texts go through the tokenizer itself
            lists = [self.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
            return np.array([i for x in lists for i in x], np.int64), np.cumsum([0, *map(len, lists)])
        code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        firsts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at] if len(data) else np.zeros(len(at), np.int64)
        if not len(code):
            return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
        start = _word_starts(code, firsts)
        end = np.append(start[1:], len(code))
        up, down = powers(len(code) + 1)
        sums = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(mix(code.astype(np.uint64) + _U(1)) * up[: len(code)], out=sums[1:])
        hashes = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if self.n_words > _CACHED_WORDS:
            self.clear()
        known = self._find(distinct)
        if len(new := np.flatnonzero(known < 0)):
            self._learn([whole[start[i] : end[i]] for i in first[new]], distinct[new])
            known[new] = self._find(distinct[new])
        word = known[back]
        sizes = self.ends[word + 1] - self.ends[word]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.arange(total[-1]) + np.repeat(self.ends[word] - total[:-1], sizes)]
        return ids.astype(np.int64), total[np.searchsorted(start, firsts)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def pieces(docs: DataFrame, path: str, window: int, end_id: int) -> DataFrame:
    """doc_id and, per document, full windows from its start and the tail that is left."""

    def cut(batches):
        enc = encoder(path)
        for batch in batches:
            names, texts = batch.column(0), batch.column(1)
            for a, b in slices(texts, _SLICE):
                ids, at = enc.encode(texts.slice(a, b - a))
                rows: list[tuple] = []
                for k in range(b - a):
                    own = np.append(ids[at[k] : at[k + 1]], end_id)
                    rows += [(a + k, s, min(window, len(own) - s), _crc(own[s : s + window]), len(own)) for s in range(0, len(own), window)]
                row, *rest = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(row)), *[pa.array(x, pa.int64()) for x in rest]], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.mapInArrow(cut, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {PIECE}")


def combinations(window: int, lengths: np.ndarray, depth: int = 3) -> np.ndarray:
    """All ways to fill the window with 1 to depth (at most 3) of the lengths, largest first; 0 where unused."""
    have = np.zeros(window + 1, bool)
    have[lengths[lengths <= window]] = True
    out = [[window, 0, 0]] if have[window] else []
    if depth > 1:
        out += [[window - b, b, 0] for b in range(1, window // 2 + 1) if have[b] and have[window - b]]
    if depth > 2:
        for c in range(1, window // 3 + 1):
            if have[c]:
                b = np.arange(c, (window - c) // 2 + 1)
                b = b[have[b] & have[window - c - b]]
                out += np.stack([window - c - b, b, np.full(len(b), c)], 1).tolist()
    return np.array(out, np.int64).reshape(-1, 3)


def repeats(shapes: np.ndarray, counts: np.ndarray, steps: int = 200) -> np.ndarray:
    """Repeats x >= 0 of each combination that bring the used lengths closest to the counts (least squares)."""
    if not len(shapes):
        return np.zeros(0)
    used = shapes > 0
    target = counts.astype(float)
    target[0] = 0
    fit = lambda x: np.bincount(shapes.ravel(), (used * x[:, None]).ravel(), minlength=len(counts))
    pull = lambda r: (r[shapes] * used).sum(1)
    v = np.ones(len(shapes))
    for _ in range(20):  # largest eigenvalue, for the step
        v = pull(fit(v))
        size = np.linalg.norm(v)
        v /= size
    x = y = np.zeros(len(shapes))
    t = 1.0
    for _ in range(steps):  # accelerated projected gradient
        r = target - fit(y)
        r[0] = 0
        new = np.maximum(0, y + pull(r) / (1.05 * size))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(counts: np.ndarray, window: int, depth: int = 3) -> tuple[np.ndarray, np.ndarray, int]:
    """Slots (length, first rank, number, first sequence, offset), pieces used of each length, and the number of sequences.

    The fitted repeats are rounded down and bound by what is there; rounds of single repeats follow, largest fraction first.
    """
    shapes = combinations(window, np.flatnonzero(counts), depth)
    fit = repeats(shapes, counts)
    left, slots, n_seq = counts.copy(), [], 0
    for k in np.argsort(-fit, kind="stable"):
        shape = [int(x) for x in shapes[k] if x]
        most = min(int(left[x]) // n for x, n in Counter(shape).items())
        n = min(most, max(1, int(fit[k]))) if fit[k] > 0 or len(shape) == 1 else 0
        n = most if len(shape) == 1 else n
        if n:
            offset = 0
            for x in shape:
                slots.append((x, int(counts[x] - left[x]), n, n_seq, offset))
                left[x] -= n
                offset += x
            n_seq += n
    table = np.array(slots, np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))], counts - left, n_seq


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, text: str | Column = "text", bucket_rows: int = 10_000) -> DataFrame:
    """Pieces of all documents in sequences of at most `window` tokens.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Each document is its ids and
    end_id; null and empty texts are end_id alone. Full windows stand alone; tails fill windows in combinations of up
    to three lengths, repeated as the least squares fit to the histogram says; what the fit leaves is laid end to end,
    longest first, and cut at window borders, so that one sequence at most is not full. Other columns of docs play no
    part. Repeated rows are packed as often as they stand there. An empty table gives no pieces. The driver gets the
    histogram (one number per length) and sends the plan (bounded by the number of combinations) to the tasks.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", (F.col(text) if isinstance(text, str) else text).alias("text"))
    cut = materialize(pieces(rows, tokenizer, window, end_id))
    n_buckets = max(1, cut.count() // bucket_rows)
    cut = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(n_buckets)))
    sums = materialize(cut.groupBy("length", "_bucket").count())
    counts = np.zeros(window + 1, np.int64)
    for length, n in sums.groupBy("length").agg(F.sum("count")).collect():  # a row per length
        counts[length] = n
    slots, used, n_seq = plan(counts, window)
    rest = counts - used
    lengths = np.arange(window + 1)
    ahead = np.concatenate([np.cumsum((rest * lengths)[::-1])[::-1][1:], [0]])  # tokens of longer pieces left over
    held = spark.sparkContext.broadcast((slots, used, ahead, n_seq))

    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        slots, used, ahead, n_seq = held.value
        x, r = np.asarray(length), np.asarray(rank)
        free = r >= used[x]
        at = ahead[x] + (r - used[x]) * x
        seq, offset = n_seq + at // window, at % window
        if len(slots):
            k = np.searchsorted(slots[:, 0] * (1 << 40) + slots[:, 1], x * (1 << 40) + r, side="right") - 1
            seq = np.where(free, seq, slots[k, 3] + r - slots[k, 1])
            offset = np.where(free, offset, slots[k, 4])
        return pa.StructArray.from_arrays([pa.array(seq), pa.array(offset)], ["q", "o"])

    before = F.coalesce(F.sum("count").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")) - 1
    ranked = cut.withColumn("_within", within).join(sums.select("length", "_bucket", before.alias("_before")), ["length", "_bucket"])
    placed = with_arrow(ranked, "_at", [F.col("length"), F.col("_before") + F.col("_within")], "struct<q bigint, o bigint>", place)
    placed = materialize(
        placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("_at.q").alias("sequence_id"), F.col("_at.o").alias("offset"))
    )
    across = F.col("offset") + F.col("length") > window
    crossing = materialize(placed.filter(across).groupBy("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset").count())
    texts = rows.join(crossing.select("doc_id").distinct().withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").distinct()
    parted = crossing.join(texts.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")

    names = placed.columns

    def divide(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            ids, at = enc.encode(batch.column("text"))
            for k, row in enumerate(batch.drop_columns(["text"]).to_pylist()):
                own = np.append(ids[at[k] : at[k + 1]], end_id)
                part = own[row["start"] : row["start"] + row["length"]]
                if len(own) != row["doc_tokens"] or _crc(part) != row["ids_crc32"]:
                    continue  # another text under the same doc_id
                head = window - row["offset"]
                two = [(row["start"], part[:head], row["sequence_id"], row["offset"]), (row["start"] + head, part[head:], row["sequence_id"] + 1, 0)]
                out += [(row["doc_id"], s, len(p), _crc(p), len(own), q, o) for s, p, q, o in two]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), [batch.schema.field("doc_id").type] + [pa.int64()] * 6, strict=True)], names)

    divided = parted.repartition(F.col("sequence_id")).mapInArrow(divide, placed.schema)
    return placed.filter(~across).unionByName(divided)
