"""Removal of repeated byte strings: distributed prefix doubling over positions that any repeat must hold in common."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .arrays import mix, powers, slices, utf8
from .components import bitmap, in_bitmap

_U = np.uint64
_SEEDS = np.random.default_rng(77).integers(1, 1 << 63, (2, 256), dtype=np.uint64) | _U(1)
_GRAM = 8


class Text:
    """Ranks of any substring of one text: 64-bit fingerprints, equal where the bytes are."""

    def __init__(self, data: np.ndarray):
        self.size = len(data)
        self.up, self.down = powers(len(data) + 1)
        self.data = data
        self.sums: dict[int, np.ndarray] = {}

    def rank(self, first: np.ndarray, last: np.ndarray, kind: int = 0) -> np.ndarray:
        """Of the bytes from first to before last."""
        if kind not in self.sums:
            sums = np.zeros(self.size + 1, np.uint64)
            np.cumsum(_SEEDS[kind][self.data] * self.up[: self.size], out=sums[1:])
            self.sums[kind] = sums
        return mix((self.sums[kind][last] - self.sums[kind][first]) * self.down[first])


def anchors(text: Text, length: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors and the first and last start that each stands for.

    The anchor of a start is the place with the smallest hash of the `window` places from it on (the first of equals). It
    depends on the bytes of the string alone, so equal strings have their anchors at equal distances.
    """
    n = text.size - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    places = np.arange(n + window - 1)
    best = (text.rank(places, places + _GRAM) >> _U(32) << _U(32)) | places.astype(np.uint64)
    have = 1
    while have < window:
        step = min(have, window - have)
        best = np.minimum(best[: len(best) - step], best[step:])
        have += step
    at = (best & _U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], first, np.append(first[1:], n) - 1


def _texts(texts: pa.Array) -> Iterator[tuple[int, Text]]:
    for a, b in slices(texts):
        data, at = utf8(texts.slice(a, b - a))
        for k in range(b - a):
            yield a + k, Text(data[at[k] : at[k + 1]])


def _context(text: Text, at: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Rank of all strings that an anchor stands for."""
    offset = ((at - first).astype(np.uint64) << _U(32)) + (last - first).astype(np.uint64)
    return mix(text.rank(first, last + length) + mix(offset + _U(1)))


def _quarters(text: Text, at: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, window: int) -> list[tuple[np.ndarray, ...]]:
    """Per quarter of the distances between a start and its anchor: the anchors that stand for such starts, the first
    and last of these, and the rank of what all strings of that quarter share. It lies at a fixed distance from the
    anchor, so strings that repeat have partners in the same quarter."""
    step = -(-window // 4)
    out = []
    for low in range(0, window, step):
        a, z = np.maximum(first, at - low - step + 1), np.minimum(last, at - low)
        own = np.flatnonzero(a <= z)
        begin = at[own] - low
        out.append((own, a[own], z[own], mix(text.rank(begin, begin + length - step + 1) + _U(low))))
    return out


def _where(context: np.ndarray, doc: np.ndarray, mark: np.ndarray, first: np.ndarray) -> np.ndarray:
    doc, mark, first = (x.astype(np.int64).view(np.uint64) for x in (doc, mark, first))
    return mix(context.view(np.uint64) ^ mix(doc + _U(3)) ^ mix((mark << _U(32)) ^ first))


def _ids(column: pa.Array) -> np.ndarray:
    return np.asarray(column).astype(np.int64)


def _again(rows: DataFrame, ranks: list[str]) -> DataFrame:
    """The rows whose ranks occur more than once. A bitmap of the first rank spares most others the shuffle."""
    again = materialize(rows.groupBy(*ranks).count().filter("count > 1").select(*ranks))
    held = rows.sparkSession.sparkContext.broadcast(bitmap(again, F.col(ranks[0]), 25))

    def known(rank: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(held.value, _ids(rank)))

    return rows.filter(F.arrow_udf(known, "boolean")(ranks[0])).join(again, ranks, "left_semi")


def repeats(rows: DataFrame, length: int, window: int) -> DataFrame:
    """doc, mark, first and last start of strings of `length` bytes that start elsewhere too (rows: doc, mark, text).

    Prefix doubling over anchors: the rank of the first half of what all of an anchor's strings share, then the pair of
    that rank and the rank half as far on; after each round Spark groups the ranks and drops what is unique. The last
    round doubles to the whole length: anchors with equal contexts repeat with all their starts; where a rank has several
    contexts, one anchor of each is opened: first by quarters of its starts, then, where a quarter's rank is not unique,
    the ranks of single starts are grouped.
    """
    spark = rows.sparkSession
    shared = length - window + 1
    half = (shared + 1) // 2

    def ranked(batches):
        for batch in batches:
            doc, mark = _ids(batch.column(0)), _ids(batch.column(1))
            out: list[list[np.ndarray]] = []
            for k, text in _texts(batch.column(2)):
                at, first, last = anchors(text, length, window)
                if len(at):
                    pair = text.rank(at, at + half), text.rank(at + shared - half, at + shared)
                    many = np.full(len(at), 1)
                    out.append([*pair, _context(text, at, first, last, length), many * doc[k], many * mark[k], first, last - first])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)], names)

    names = ["r0", "r1", "context", "doc", "mark", "first", "more"]
    left = materialize(rows.mapInArrow(ranked, ", ".join(f"{c} bigint" for c in names)))
    for ranks in (["r0"], ["r0", "r1"]):  # the offset doubles
        left = materialize(_again(left, ranks))
    contexts = left.groupBy("r0", "r1", "context").agg(F.count(F.lit(1)).alias("many"), F.min(F.struct("doc", "mark", "first")).alias("one"))
    contexts = materialize(contexts)
    several = contexts.groupBy("r0", "r1").count().filter("count > 1").select("r0", "r1")
    opened = contexts.join(several, ["r0", "r1"], "left_semi").select("context", "one.*")

    def placed(batches):
        for batch in batches:
            c = [_ids(x) for x in batch.columns]
            yield pa.RecordBatch.from_arrays([pa.array(_where(*c).view(np.int64)), pa.array(_doc_key(c[1], c[2]))], ["place", "whole"])

    keys = materialize(opened.mapInArrow(placed, "place bigint, whole bigint"))
    held = spark.sparkContext.broadcast((bitmap(keys, F.col("place"), 24), bitmap(keys, F.col("whole"), 22)))

    def opened_in(batch: pa.RecordBatch) -> Iterator[tuple]:
        """doc, mark, the text and the quarters of its anchors that are to be opened."""
        places, wholes = held.value
        doc, mark = _ids(batch.column(0)), _ids(batch.column(1))
        ok = np.flatnonzero(in_bitmap(wholes, _doc_key(doc, mark)))
        for k, text in _texts(batch.column(2).take(pa.array(ok))):
            at, first, last = anchors(text, length, window)
            if len(at):
                d, m = doc[ok[k]], mark[ok[k]]
                many = np.full(len(at), 1)
                use = in_bitmap(places, _where(_context(text, at, first, last, length).view(np.int64), many * d, many * m, first).view(np.int64))
                if use.any():
                    yield d, m, text, _quarters(text, at[use], first[use], last[use], length, window)

    def quarters(batches):
        for batch in batches:
            found = [rank for *_, parts in opened_in(batch) for *_, rank in parts]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["rank"])

    shared_ranks = rows.mapInArrow(quarters, "rank bigint").groupBy("rank").count().filter("count > 1")
    worth = spark.sparkContext.broadcast(bitmap(shared_ranks, F.col("rank"), 25))

    def singles(batches):
        for batch in batches:
            for d, m, text, parts in opened_in(batch):
                kept = [(a[hit], z[hit]) for _, a, z, rank in parts for hit in [in_bitmap(worth.value, rank)]]
                first, last = (np.concatenate(x) for x in zip(*kept, strict=True))
                size = last - first + 1
                if not len(size):
                    continue
                start = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                full = [text.rank(start, start + length, kind).view(np.int64) for kind in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*full, np.full(len(start), d), np.full(len(start), m), start)], ["f0", "f1", "doc", "mark", "first"])

    single = materialize(rows.mapInArrow(singles, "f0 bigint, f1 bigint, doc bigint, mark bigint, first bigint"))
    found = _again(single, ["f0", "f1"]).select("doc", "mark", "first", F.col("first").alias("last"))
    equal = left.join(contexts.filter("many > 1").select("r0", "r1", "context"), ["r0", "r1", "context"], "left_semi")
    return found.unionByName(equal.select("doc", "mark", "first", (F.col("first") + F.col("more")).alias("last")))


def _doc_key(doc: np.ndarray, mark: np.ndarray) -> np.ndarray:
    return mix(mix(doc.view(np.uint64) + _U(5)) ^ mark.view(np.uint64)).view(np.int64)


def remove(docs: DataFrame, length: int = 400, window: int = 128, doc_id: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """doc_id, n_bytes, spans (start, end in bytes of the maximal removed runs) and kept (the remaining bytes) of every row.

    Every byte covered by a string of `length` bytes that also starts anywhere else in the table, same document included,
    is removed; matches never cross documents and are judged on the input. Null text is empty. Rows that repeat a text
    repeat each other's strings. Rows are told apart by doc_id and a hash of the text, so a doc_id may be null or occur
    with several texts. Texts shorter than `length` stay whole; an empty table stays empty; other columns play no part.
    Strings are told apart by 64 bits where candidates are dropped as unique and by 128 bits where single starts are
    compared.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    named = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"))
    keyed = named.withColumn("doc", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))).withColumn("mark", F.hash("text").cast("bigint"))
    found = repeats(keyed.select("doc", "mark", "text"), length, window)
    spans = materialize(found.groupBy("doc", "mark").agg(F.collect_list(F.struct("first", "last")).alias("starts")))  # of one document

    def keys(doc: pa.Array, mark: pa.Array) -> pa.Array:
        return pa.array(_doc_key(_ids(doc), _ids(mark)))

    key = F.arrow_udf(keys, "bigint")("doc", "mark")
    held = spark.sparkContext.broadcast(bitmap(spans.select(key.alias("key")), F.col("key"), 22))

    def touched(doc: pa.Array, mark: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(held.value, _doc_key(_ids(doc), _ids(mark))))

    marked = keyed.withColumn("touched", F.arrow_udf(touched, "boolean")("doc", "mark"))
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    same = marked.filter("NOT touched").select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), none.alias("spans"), F.encode("text", "UTF-8").alias("kept"))

    def cut(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for a, b in slices(batch.column(1)):
                data, at = utf8(batch.column(1).slice(a, b - a))
                size, spans, kept = [], [], []
                for k, starts in enumerate(batch.column(2).slice(a, b - a)):
                    own = data[at[k] : at[k + 1]]
                    change = np.zeros(len(own) + 1, np.int64)
                    if starts.is_valid and len(starts):
                        flat = starts.values
                        np.add.at(change, np.asarray(flat.field("first")), 1)
                        np.add.at(change, np.asarray(flat.field("last")) + length, -1)
                    gone = np.cumsum(change)[:-1] > 0
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                    size.append(len(own))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
                    kept.append(own[~gone].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(size, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"]
                )

    joined = marked.filter("touched").join(spans, ["doc", "mark"], "left").select("doc_id", "text", "starts")
    return same.unionByName(joined.mapInArrow(cut, same.schema))
