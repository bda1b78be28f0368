"""Language ID: letter n-grams looked up in bit-sliced Bloom filters."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .arrays import free_name, mix, slices, utf8, with_arrow

UNKNOWN = "und"
SIZES = (3, 4, 5)
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_U = np.uint64


@dataclass
class LanguageModel:
    """A slot holds one bit per language; a language has an n-gram when its bit is set in all the n-gram's slots."""

    names: list[str]
    slots: np.ndarray  # (number of slots, words of 64 languages)
    probes: int
    commonest: int

    def wrong(self) -> np.ndarray:
        """Per language, the share of absent n-grams that its filter claims to hold."""
        bits = [(self.slots[:, k // 64] >> _U(k % 64)) & _U(1) for k in range(len(self.names))]
        return np.array([float(b.mean()) ** self.probes for b in bits])


def _grams(data: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per size, the n-grams (bytes of letters in lower case, words in single blanks, none across a blank) and their text."""
    n = len(at) - 1
    lengths = np.diff(at) + 2
    ends = np.cumsum(lengths)
    padded = np.full(int(ends[-1]) if n else 0, 32, np.uint8)
    row = np.repeat(np.arange(n), lengths)
    inside = np.ones(len(padded), bool)
    inside[ends - 1] = False
    inside[ends - lengths] = False
    padded[inside] = _FOLD[data]
    blank = padded == 32
    keep = np.ones(len(padded), bool)
    keep[1:] = ~(blank[1:] & blank[:-1] & (row[1:] == row[:-1]))
    padded, row = padded[keep], row[keep]
    wide = padded.astype(np.uint64)
    out = []
    for size in SIZES:
        m = len(wide) - size + 1
        if m <= 0:
            continue
        code = np.full(m, _U(size))
        for k in range(size):
            code = (code << _U(8)) | wide[k : k + m]
        ok = row[:m] == row[size - 1 :]
        for k in range(1, size - 1):
            ok &= padded[k : k + m] != 32
        out.append((code[ok], row[:m][ok]))
    return out


def _slots(codes: np.ndarray, n_slots: int, probes: int) -> np.ndarray:
    return np.stack([(mix(codes + _U(0x51ED27 * (k + 1))) % _U(n_slots)).astype(np.int64) for k in range(probes)])


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", rows_per_language: int = 2000, share: float = 0.5, least: int = 3,
    slots_log2: int = 19, probes: int = 3,
) -> LanguageModel:
    """Filters learned from labelled rows; rows with null text or label are left out.

    rows_per_language bounds the sample (the expected number of rows of each language, chosen by a hash of the text).
    An n-gram belongs to each language where it is at least `share` as frequent as where it is most frequent, and was
    seen `least` times. The model has 2**slots_log2 slots whatever the input. Ties and repeated rows count as they are.
    An empty table gives a model without languages. The driver gets one row per language and the slots, nothing else.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r[0]: r[1] for r in docs.select(F.col(lang).alias("lang")).filter("lang IS NOT NULL").groupBy("lang").count().collect()}
    names = sorted(counts)
    width = max(1, -(-len(names) // 64))
    if not names:
        return LanguageModel([], np.zeros((1 << slots_log2, width), np.uint64), probes, 0)
    chosen = spark.createDataFrame(
        [(name, k, min(1.0, rows_per_language / counts[name])) for k, name in enumerate(names)], "lang string, k int, part double"
    )
    sample = rows.join(F.broadcast(chosen), "lang").filter(F.expr("pmod(xxhash64(text), 1000000) < part * 1000000")).select("text", "k")

    def count(batches):
        for batch in batches:
            for a, b in slices(batch.column(0)):
                data, at = utf8(batch.column(0).slice(a, b - a))
                kinds = np.asarray(batch.column(1).slice(a, b - a))
                for codes, row in _grams(data, at):
                    kind = kinds[row]
                    for k in np.unique(kind):
                        code, n = np.unique(codes[kind == k], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(code), k, np.int32)), pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64))], ["k", "code", "n"]
                        )

    grams = sample.mapInArrow(count, "k int, code bigint, n bigint").groupBy("k", "code").agg(F.sum("n").alias("n"))
    size = F.expr("CASE WHEN code < (4L << 24) THEN 3 WHEN code < (5L << 32) THEN 4 ELSE 5 END")
    grams = grams.withColumn("size", size)
    totals = grams.groupBy("k", "size").agg(F.sum("n").alias("total"))
    rated = grams.join(F.broadcast(totals), ["k", "size"]).withColumn("rate", F.col("n") / F.col("total"))
    best = F.max("rate").over(Window.partitionBy("code"))
    members = rated.withColumn("best", best).filter((F.col("rate") >= share * F.col("best")) & (F.col("n") >= least))
    n_slots = 1 << slots_log2

    def place(batches):
        for batch in batches:
            codes = np.asarray(batch.column(1)).astype(np.uint64)
            k = np.asarray(batch.column(0)).astype(np.int64)
            at = _slots(codes, n_slots, probes)
            bit = (_U(1) << (k % 64).astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.reshape(-1)), pa.array(np.tile(k // 64, probes)), pa.array(np.tile(bit, probes))], ["slot", "word", "bits"]
            )

    filled = (
        members.select("k", "code").mapInArrow(place, "slot bigint, word bigint, bits bigint").groupBy("slot", "word").agg(F.expr("bit_or(bits)").alias("bits"))
    ).toArrow()  # at most 2**slots_log2 rows for 64 languages
    slots = np.zeros((n_slots, width), np.uint64)
    slots[np.asarray(filled["slot"]), np.asarray(filled["word"])] = np.asarray(filled["bits"]).astype(np.uint64)
    return LanguageModel(names, slots, probes, names.index(max(names, key=lambda x: (counts[x], x))))


def _predict(model: LanguageModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Index of the language (-1: unknown) and score of each text."""
    n, n_lang = len(texts), len(model.names)
    data, at = utf8(texts)
    found = np.zeros((n_lang, n))
    total = np.zeros(n)
    if n_lang and len(data):
        for codes, row in _grams(data, at):
            total += np.bincount(row, minlength=n)
            where = _slots(codes, len(model.slots), model.probes)
            for word in range(model.slots.shape[1]):
                table = model.slots[:, word]
                bits = table[where[0]]
                for probe in where[1:]:
                    bits &= table[probe]
                for k in range(64 * word, min(64 * word + 64, n_lang)):
                    found[k] += np.bincount(row, (bits >> _U(k % 64)) & _U(1), minlength=n)
    best, score = np.full(n, -1), np.zeros(n)
    if n_lang:
        wrong = model.wrong()[:, None]
        true = np.maximum(0, (found - total * wrong) / np.maximum(1 - wrong, 1e-9))
        best = true.argmax(0)
        top = true.max(0)
        best[top <= 0] = model.commonest
        score = np.divide(top, true.sum(0), out=np.zeros(n), where=top > 0)
    letter = np.zeros(n, bool)
    for i in range(n):
        part = data[at[i] : at[i + 1]]
        folded = _FOLD[part]
        letter[i] = bool(((folded >= 97) & (folded < 123)).any()) or (bool((part >= 128).any()) and _has_letter(part.tobytes().decode("utf-8", "ignore")))
    best[~letter] = -1
    score[best < 0] = 0
    return best, score


def identify(docs: DataFrame, model: LanguageModel, text: str | Column = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All rows and columns of docs with the predicted language and a score from 0 to 1.

    Only the whole text is read. The language with the most n-grams, less the false claims its filter is expected to
    make, wins; ties go to the first name. `und` with score 0: null text, no letter, or a model without languages.
    A text with letters but no known n-gram gets the commonest language with score 0. Columns named like the results
    are replaced. Repeated rows get equal results; an empty table stays empty.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # of a size fixed by the model's parameters

    def fn(texts: pa.Array) -> pa.Array:
        model = held.value
        names, best, value = [*model.names, UNKNOWN], [], []
        for a, b in slices(texts):
            k, s = _predict(model, texts.slice(a, b - a))
            best += [names[x] for x in k]
            value.append(s)
        return pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(np.concatenate(value) if value else np.zeros(0))], ["p", "s"])

    rest = docs.drop(pred, score) if isinstance(text, Column) or text not in (pred, score) else docs
    name = free_name(docs, "_lang")
    out = with_arrow(rest, name, [F.col(text) if isinstance(text, str) else text], "struct<p string, s double>", fn)
    return out.withColumns({pred: F.col(name)["p"], score: F.col(name)["s"]}).drop(name)
