"""Substring dedup: paragraphs meet in MinHash bands, exact Jaccard verifies, components decide what is removed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import discard, materialize
from .arrays import mix, slices, utf8, words
from .components import in_bitmap
from .jaccard import cluster
from .passages import outside

_U = np.uint64
_BITS = 128
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


def tune(threshold: float, recall: float, most: int = 64) -> tuple[int, int]:
    """Bands and rows with the fewest hashes: of the widest rows whose recall at the threshold still holds with 6 bands at most."""
    best = (most, 1)
    for rows in range(1, 9):
        bands = next((b for b in range(1, most + 1) if 1 - (1 - threshold**rows) ** b >= recall), most)
        if bands <= 6:
            best = (bands, rows)
    return best


def cut(texts: pa.Array, size: int, min_words: int) -> dict[str, np.ndarray]:
    """All paragraphs of some texts that have min_words words.

    A paragraph is a line, cut further at those ends of sentences whose last word has an even hash. The cuts depend on
    the words alone, so a passage set into another text has the same ones inside. Returns per paragraph: text (row),
    first and last (bytes in the text), word (the first one's number in the text), order among the text's, n_words, inside
    (1 if it begins inside a line, and 2 more if it ends inside one); and the distinct shingles (hashes in order,
    shingle_of: paragraph).
    """
    data, at = utf8(texts)
    hashes, starts, ends = words(data, at)
    n = len(hashes)
    row = np.searchsorted(at, starts, side="right") - 1 if n else np.zeros(0, np.int64)
    lines = np.concatenate([[0], np.cumsum(data == 10)]) if len(data) else np.zeros(1, np.int64)
    last = np.zeros(n, bool)
    if n:
        last[-1] = True
        last[:-1] = (lines[starts[1:]] > lines[ends[:-1]]) | (row[1:] != row[:-1])
        line = last.copy()
        last |= _STOP[data[ends - 1]] & ((hashes & _U(1)) == 0)
    group = np.concatenate([[0], np.cumsum(last)[:-1]]) if n else np.zeros(0, np.int64)
    many = np.bincount(group) if n else np.zeros(0, np.int64)
    begin = np.concatenate([[0], np.cumsum(many)[:-1]]) if n else np.zeros(0, np.int64)
    keep = many >= max(min_words, size)
    m = max(0, n - size + 1)
    out = np.full(m, _U(size))
    for k in range(size if m else 0):
        out = mix(out * _U(0x9E3779B97F4A7C15) + hashes[k : m + k])
    inside = (group[:m] == group[size - 1 :]) & keep[group[:m]] if m else np.zeros(0, bool)
    number = np.cumsum(keep) - 1
    owner, out = number[group[:m][inside]], out[inside]
    order = np.lexsort((out, owner))
    owner, out = owner[order], out[order]
    if len(out):
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (out[1:] != out[:-1])])
        owner, out = owner[new], out[new]
    first = begin[keep]
    text = row[first] if n else np.zeros(0, np.int64)
    place = np.arange(len(first)) - np.searchsorted(text, text)
    final = first + many[keep] - 1
    inside = 2 * ~line[final] + ~np.concatenate([[True], line])[first] if n else first
    return {"text": text, "inside": inside, "first": starts[first] - at[text], "last": ends[final] - at[text], "word": first - np.searchsorted(starts, at[text]), "order": place, "n_words": many[keep], "shingles": out, "shingle_of": owner}


def _names(found: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where each paragraph's shingles begin, and the 64-bit names of the sets."""
    begin = np.searchsorted(found["shingle_of"], np.arange(len(found["text"])))
    if not len(begin):
        return begin, np.zeros(0, np.int64)
    sizes = np.diff(np.append(begin, len(found["shingles"]))).astype(np.uint64)
    return begin, mix(np.add.reduceat(mix(found["shingles"] + _U(0x51)), begin) + sizes).view(np.int64)


def repeated(
    docs: DataFrame, doc_id: str = "doc_id", text: str | Column = "text", size: int = 5, num: int = 80, den: int = 100, min_words: int = 8,
    passage_words: int = 25, recall: float = 0.99, rest_words: int = 10,
) -> DataFrame:
    """A row for each paragraph, and each other run of words, that stands elsewhere too in a passage of passage_words at least.

    doc_id, start, end (bytes of the whole text), n_words, class_doc_id and class_start (the class's smallest occurrence),
    removed (false for that one). Paragraphs (see cut) are sets of distinct shingles of `size` words; those with
    den * |common| >= num * |union| are linked, classes are components of links. Bands and rows of the MinHash keys are
    tuned to the recall at the threshold. Neighbouring paragraphs with copies make a passage; shorter passages and
    paragraphs of under min_words words are not reported.

    Every run of passage_words words and more that stands twice word for word, wherever in a line or across lines it
    begins and ends, is reported as far as no reported paragraph covers it (see passages.outside): its words outside of
    these, in stretches of rest_words and more where the paragraph ends with its line; a stretch that begins at a paragraph's end begins with the blank there.
    class_start then is where the whole run starts in its smallest occurrence.

    Null and empty texts have no paragraphs. A document given twice
    under one doc_id is one document; rows without doc_id are compared and reported with a null doc_id. Other columns
    play no part; an empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.col(text) if isinstance(text, str) else text).alias("text"))
    bands, wide = tune(num / den, recall)

    def features(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                found = cut(batch.column(1).slice(a, b - a), size, min_words)
                begin, names = _names(found)
                if not len(names):
                    continue
                keys = []
                for k in range(bands):
                    key = np.full(len(begin), _U(k))
                    for r in range(wide):
                        key = mix(key * _U(31) + np.minimum.reduceat(mix(found["shingles"] ^ mix(np.array([k * wide + r + 1], np.uint64))), begin))
                    keys.append(key)
                flat = pa.array(np.stack(keys, 1).reshape(-1).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(begin) + 1, dtype=np.int32) * bands), flat)
                n = np.diff(np.append(begin, len(found["shingles"])))
                bit = found["shingle_of"] * _BITS + (found["shingles"] & _U(_BITS - 1)).astype(np.int64)
                odd = (np.bincount(bit, minlength=len(n) * _BITS) & 1).astype(np.uint8)
                words_ = _BITS // 64
                bits = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * words_), pa.array(np.packbits(odd).view(np.int64)))
                plain = [pa.array(found[c].astype(np.int64)) for c in ("first", "last", "word", "inside", "order", "n_words")]
                names_ = ["doc_id", "start", "end", "word", "inside", "order", "n_words", "n", "h", "bits", "keys"]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(found["text"] + a)), *plain, pa.array(n), pa.array(names), bits, lists], names_)

    def items(texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
        found = cut(texts, size, min_words)
        begin, names = _names(found)
        return names, np.split(found["shingles"], begin[1:]) if len(begin) else []

    kind = docs.schema[doc_id].dataType.simpleString()
    known = materialize(rows.mapInArrow(features, f"doc_id {kind}, start bigint, `end` bigint, word bigint, inside bigint, `order` bigint, n_words bigint, n bigint, h bigint, bits array<bigint>, keys array<bigint>"))
    places = materialize(known.drop("keys", "bits"))

    def keyed(held: Broadcast | None = None) -> DataFrame:
        """The few keys of each paragraph, from the table."""

        def kept(batches):
            for batch in batches:
                h, key = np.repeat(np.asarray(batch.column(0)), bands), np.asarray(batch.column(1).flatten())
                ok = in_bitmap(held.value, key)
                yield pa.RecordBatch.from_arrays([pa.array(h[ok]), pa.array(key[ok])], ["h", "key"])

        stored = known.select("h", "keys")
        return stored.select("h", F.explode("keys").alias("key")) if held is None else stored.mapInArrow(kept, "h bigint, key bigint")

    groups = cluster(rows, known, keyed, items, num, den, _BITS // 64, known)
    placed = places.join(groups, "h", "left").withColumn("class", F.coalesce("component", "h")).drop("component").distinct()
    placed = materialize(placed)
    discard(places)
    least = placed.groupBy("class").agg(F.min(F.struct("doc_id", "start")).alias("least"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    shared = placed.join(least, "class")
    near = Window.partitionBy("doc_id").orderBy("order", "start", "end")
    islands = shared.withColumn("island", F.col("order") - F.row_number().over(near))
    whole = islands.withColumn("passage", F.sum("n_words").over(Window.partitionBy("doc_id", "island"))).filter(F.col("passage") >= passage_words)
    own = F.struct("doc_id", "start") == F.col("least")
    whole = materialize(whole.select(
        "doc_id", "start", "end", "n_words", F.col("least.doc_id").alias("class_doc_id"), F.col("least.start").alias("class_start"), (~own).alias("removed"), "word", "inside"
    ))
    discard(placed)
    return whole.drop("word", "inside").unionByName(outside(rows, whole, passage_words, rest_words))
