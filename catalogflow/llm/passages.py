"""Exact repeats inside lines: every run of words that stands twice, wherever it begins and ends."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import discard, materialize
from .arrays import mix, powers, slices, utf8, words
from .components import bitmap, in_bitmap

_U = np.uint64
INNER = 13


def _ranges(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[0] .. first[0] + many[0] - 1, first[1] .. and so on, end to end."""
    begin = np.cumsum(many) - many
    return np.arange(int(many.sum())) + np.repeat(first - begin, many)


def anchors(texts: pa.Array, size: int) -> dict[str, np.ndarray]:
    """All runs of `size` words of some texts, grouped by their anchor.

    The anchor of a run is the smallest hash of INNER words in it (the first of equal ones), so equal runs have equal
    anchors. Runs one after the other with one anchor in one place are a group. Per group: text (row), q (first run, as
    the number of its first word in the text), n (runs), anchor, whole (hash of all words of the group and the anchor's
    place); per run, group after group: gram (hash), start and end (bytes in the text).
    """
    data, at = utf8(texts)
    hashes, starts, ends = words(data, at)
    inner = min(INNER, size)
    many = len(hashes) - size + 1
    empty = np.zeros(0, np.int64)
    if many < 1:
        return {c: empty for c in ("text", "q", "n", "start", "end")} | {c: empty.astype(np.uint64) for c in ("anchor", "whole", "gram")}
    row = np.searchsorted(at, starts, side="right") - 1
    up, down = powers(len(hashes) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)])])

    def run(first: np.ndarray, n) -> np.ndarray:
        return mix((sums[first + n] - sums[first]) * down[first] + np.asarray(n).astype(np.uint64))

    small = run(np.arange(len(hashes) - inner + 1), inner)
    place = np.arange(many)
    place = place + np.lib.stride_tricks.sliding_window_view(small, size - inner + 1).argmin(1)
    grams = np.flatnonzero(row[:many] == row[size - 1 :])
    if not len(grams):
        return anchors(texts.slice(0, 0), size)
    p = place[grams]
    first = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (np.diff(grams) != 1)]))
    n = np.diff(np.append(first, len(grams)))
    q, p = grams[first], p[first]
    text = row[q]
    before = np.searchsorted(starts, at[text])
    whole = mix(run(q, n + size - 1) + (p - q).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    return {
        "text": text, "q": q - before, "n": n, "anchor": small[p], "whole": whole,
        "gram": run(grams, size), "start": starts[grams] - at[row[grams]], "end": ends[grams + size - 1] - at[row[grams]],
    }


def _stretches(found: DataFrame) -> DataFrame:
    """anchor, whole and an array of i, n, cd, cq, cs: runs (anchor, whole, i, cd, cq, cs) that follow each other in both places as one."""
    listed = found.groupBy("anchor", "whole").agg(F.sort_array(F.collect_list(F.struct("i", "cd", "cq", "cs"))).alias("runs"))

    def follows(x: Column, k: Column) -> Column:
        before = F.get("runs", k - 1)
        return (before["i"] + 1).eqNullSafe(x["i"]) & before["cd"].eqNullSafe(x["cd"]) & (before["cq"] + 1).eqNullSafe(x["cq"])

    marked = F.transform("runs", lambda x, k: F.struct(k.alias("k"), x.alias("run"), follows(x, k).alias("on")))
    heads = listed.select("anchor", "whole", F.size("runs").alias("many"), F.filter(marked, lambda y: ~y["on"]).alias("heads"))

    def stretch(y: Column, m: Column) -> Column:
        n = F.coalesce(F.get("heads", m + 1)["k"], F.col("many")) - y["k"]
        return F.struct(y["run"]["i"].alias("i"), n.alias("n"), *[y["run"][c].alias(c) for c in ("cd", "cq", "cs")])

    return heads.select("anchor", "whole", F.transform("heads", stretch).alias("at"))


def runs(rows: DataFrame, size: int) -> DataFrame:
    """Where the runs of `size` words that stand twice are: rows (doc_id, tk, q, n, start, end, cd, cq, cs, cl).

    n runs one after the other from word q, over the bytes start to end; tk names the text. The smallest occurrence of
    each is in cd at word cq and byte cs, and for the n - 1 others one word further each. cl is the word of the last one
    where single runs were looked at, else cq again. Only groups whose anchor stands twice are looked at, and single runs
    only where the groups of an anchor differ; those of a group that follow each other in both places are one row. The
    result is written once, and what it was made from goes.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    spark = rows.sparkSession
    named = rows.select("doc_id", "text", F.xxhash64("text").alias("tk"))

    def keys(batches):
        for batch in batches:
            for a, b in slices(batch.column(0)):
                found = anchors(batch.column(0).slice(a, b - a), size)
                yield pa.RecordBatch.from_arrays([pa.array(found["anchor"].view(np.int64)), pa.array(found["whole"].view(np.int64))], ["anchor", "whole"])

    seen = rows.select("text").mapInArrow(keys, "anchor bigint, whole bigint").groupBy("anchor")
    twice = materialize(seen.agg(F.count(F.lit(1)).alias("many"), (F.min("whole") != F.max("whole")).alias("mixed")).filter("many > 1").select("anchor", "mixed"))
    held = spark.sparkContext.broadcast((bitmap(twice, F.col("anchor"), 26), bitmap(twice.filter("mixed"), F.col("anchor"), 26)))

    def places(batches):
        again, mixed = held.value
        for batch in batches:
            for a, b in slices(batch.column(1)):
                found = anchors(batch.column(1).slice(a, b - a), size)
                anchor = found["anchor"].view(np.int64)
                hit = np.flatnonzero(in_bitmap(again, anchor)) if len(anchor) else anchor
                if not len(hit):
                    continue
                begin = (np.cumsum(found["n"]) - found["n"])[hit]
                n = found["n"][hit]
                single = np.where(in_bitmap(mixed, anchor[hit]), n, 0)
                each = _ranges(begin, single)
                ends = pa.array(np.concatenate([[0], np.cumsum(single)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(found[c][each].view(np.int64))) for c in ("gram", "start", "end")]
                own = pa.array(found["text"][hit] + a)
                flat = [found["q"][hit], n, found["start"][begin], found["end"][begin + n - 1], anchor[hit], found["whole"][hit].view(np.int64)]
                names = ["doc_id", "tk", "q", "n", "start", "end", "anchor", "whole", "grams", "starts", "ends"]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(2).take(own), *[pa.array(x) for x in flat], *lists], names)

    lists = "grams array<bigint>, starts array<bigint>, ends array<bigint>"
    placed = materialize(named.select("doc_id", "text", "tk").mapInArrow(
        places, f"doc_id {kind}, tk bigint, q bigint, n bigint, start bigint, `end` bigint, anchor bigint, whole bigint, {lists}"
    ))
    least, most = F.min(F.struct("doc_id", "q", "tk", "start", "starts")), F.max(F.struct("doc_id", "q", "tk"))
    groups = materialize(placed.groupBy("anchor", "whole").agg(least.alias("least"), most.alias("most"), F.first("grams").alias("grams")))

    def differ() -> Column:
        return ~(F.col("least.doc_id").eqNullSafe(F.col("most.doc_id")) & (F.col("least.q") == F.col("most.q")) & (F.col("least.tk") == F.col("most.tk")))

    source = [F.col("least.doc_id").alias("cd"), F.col("least.q").alias("cq")]
    plain = groups.filter((F.size("grams") == 0) & differ()).select("anchor", "whole", *source, F.col("least.start").alias("cs"))
    spans = ["doc_id", "tk", "q", "n", "start", "end", "cd", "cq", "cs"]
    out = placed.filter(F.size("grams") == 0).drop("grams", "starts", "ends").join(plain, ["anchor", "whole"]).select(*spans)
    each = groups.filter(F.size("grams") > 0).select("anchor", "whole", "least", "most", F.posexplode("grams").alias("i", "gram")).select(
        "anchor", "whole", "i", "gram",
        F.struct(F.col("least.doc_id").alias("doc_id"), (F.col("least.q") + F.col("i")).alias("q"), F.col("least.tk").alias("tk"), F.get("least.starts", F.col("i")).alias("s")).alias("least"),
        F.struct(F.col("most.doc_id").alias("doc_id"), (F.col("most.q") + F.col("i")).alias("q"), F.col("most.tk").alias("tk")).alias("most"),
    )
    shared = each.groupBy("gram").agg(F.min("least").alias("least"), F.max("most").alias("most")).filter(differ())
    shared = each.select("anchor", "whole", "i", "gram").join(shared.select("gram", *source, F.col("least.s").alias("cs")), "gram").drop("gram")
    parts = placed.filter(F.size("grams") > 0).select("doc_id", "tk", "q", "starts", "ends", "anchor", "whole").join(_stretches(shared), ["anchor", "whole"])
    parts = parts.select("doc_id", "tk", "q", "starts", "ends", F.explode("at").alias("at")).select("*", "at.*")
    first, last = F.get("starts", F.col("i")).alias("start"), F.get("ends", F.col("i") + F.col("n") - 1).alias("end")
    parts = parts.select("doc_id", "tk", (F.col("q") + F.col("i")).alias("q"), F.col("n").cast("bigint").alias("n"), first, last, "cd", "cq", "cs", (F.col("cq") + F.col("n") - 1).alias("cl"))
    found = materialize(out.withColumn("cl", F.col("cq")).unionByName(parts))
    discard(twice, placed, groups)
    return found


class _Taken:
    """Disjoint stretches of a text: first and last word (exclusive), first and last byte, whether it begins and ends inside a line."""

    def __init__(self):
        self.own: list[tuple[int, int, int, int, bool, bool]] = []

    def add(self, w1: int, w2: int, s: int, e: int, head: bool, tail: bool) -> list[tuple[int, int, int, int, bool]]:
        """Takes what of a stretch is not taken, and returns it: words, bytes and whether it was cut off inside a line."""
        k, out, cut = max(0, bisect_left(self.own, (w1,)) - 1), [], False
        while k < len(self.own) and self.own[k][0] < w2 and w1 < w2:
            a, b, x, y, begins, ends = self.own[k]
            if b > w1:
                if a > w1:
                    out.append((w1, a, s, x, cut or begins))
                w1, s, cut = b, y, ends
            k += 1
        if w1 < w2:
            out.append((w1, w2, s, e, cut))
        for x in out:
            insort(self.own, (*x[:4], head, tail))
        return out


def outside(rows: DataFrame, known: DataFrame, size: int, least: int) -> DataFrame:
    """Repeated passages of `size` words and more that known does not cover.

    known: doc_id, word (the first, as its number in the text), n_words, start, end of what is reported already, and
    inside: 1 if it begins inside a line, and 2 more if it ends inside one. Runs whose smallest occurrences follow each
    other too are one passage. Its words in known or in another passage are taken off; the smallest occurrence is never
    cut for the sake of another. What then is left needs `least` words where only line ends part it from known. Rows as
    those of paragraphs.repeated, class_start being the one of the passage before anything is taken off.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    numbers = ["dk", "tk", "q", "n", "start", "end", "cdk", "cq", "cs", "cl", "inside"]
    none = F.lit(None).cast("bigint")
    ours = F.xxhash64("doc_id").alias("dk")
    twice = runs(rows, size).select("doc_id", "cd", ours, "tk", "q", "n", "start", "end", F.xxhash64("cd").alias("cdk"), "cq", "cs", "cl", F.lit(3).cast("bigint").alias("inside"), F.lit(1).alias("kind"))
    old = known.select(
        "doc_id", F.lit(None).cast(kind).alias("cd"), ours, F.lit(0).cast("bigint").alias("tk"), F.col("word").alias("q"), F.col("n_words").alias("n"), "start", "end",
        none.alias("cdk"), none.alias("cq"), none.alias("cs"), none.alias("cl"), "inside", F.lit(0).alias("kind"),
    ).join(twice.select("dk").distinct(), "dk", "left_semi")
    both = twice.unionByName(old).repartition("doc_id").sortWithinPartitions("dk", "kind", "tk", "q")

    def passages(table: pa.Table) -> pa.RecordBatch | None:
        """Of whole documents."""
        c = {x: table[x].fill_null(0).to_numpy() for x in [*numbers, "kind"]}
        own = (c["cdk"] == c["dk"]) & (c["cq"] == c["q"])
        same = lambda x: np.concatenate([[False], x[1:] == x[:-1]])
        again = same(c["dk"]) & same(c["tk"]) & same(c["q"]) & same(c["kind"])
        lead = np.flatnonzero(~again | (c["kind"] == 0))
        c = {x: v[lead] for x, v in c.items()}
        own = own[lead]
        follows = np.concatenate([[False], (c["q"] + c["n"])[:-1] == c["q"][1:]])
        stays = np.concatenate([[False], c["cl"][:-1] == c["cq"][1:]])
        one = same(c["dk"]) & same(c["tk"]) & same(c["kind"]) & same(c["cdk"]) & same(own) & follows & (same(c["q"] - c["cq"]) | stays) & (c["kind"] == 1)
        first = np.flatnonzero(~one)
        last = np.append(first[1:], len(one)) - 1
        begin = c["q"][first]
        stop = np.where(c["kind"][first] == 1, c["q"][last] + c["n"][last] + size - 1, begin + c["n"][first])
        span = list(zip(begin.tolist(), stop.tolist(), c["start"][first].tolist(), c["end"][last].tolist(), (c["inside"][first] & 1 > 0).tolist(), (c["inside"][first] & 2 > 0).tolist(), strict=True))
        order = np.lexsort((np.arange(len(first)), ~own[first], c["kind"][first], c["dk"][first]))
        dk, kinds = c["dk"][first], c["kind"][first]
        found, taken, now = [], _Taken(), None
        for k in order.tolist():
            if dk[k] != now:
                taken, now = _Taken(), dk[k]
            free = taken.add(*span[k])
            if kinds[k]:
                found += [(k, x) for x in free if x[4] or x[1] - x[0] >= least]
        if not found:
            return None
        at = first[[k for k, _ in found]]
        spans = np.array([x for _, x in found])
        row = pa.array(lead[at])
        values = [pa.array(spans[:, 2]), pa.array(spans[:, 3]), pa.array(spans[:, 1] - spans[:, 0]), table["cd"].combine_chunks().take(row), pa.array(c["cs"][at]), pa.array(~own[at])]
        return pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks().take(row), *values], ["doc_id", "start", "end", "n_words", "class_doc_id", "class_start", "removed"])

    def fn(batches):
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.asarray(batch.column(batch.schema.get_field_index("dk")))
            held.append(batch)
            if key[0] == key[-1] and (len(held) == 1 or held[-2].column("dk")[-1].as_py() == key[0]):
                continue
            cut = 0 if key[0] == key[-1] else int(np.flatnonzero(key != key[-1])[-1]) + 1
            done = passages(pa.Table.from_batches([*held[:-1], batch.slice(0, cut)]))
            held = [batch.slice(cut)]
            if done is not None:
                yield done
        if held and (done := passages(pa.Table.from_batches(held))) is not None:
            yield done

    return both.mapInArrow(fn, f"doc_id {kind}, start bigint, `end` bigint, n_words bigint, class_doc_id {kind}, class_start bigint, removed boolean")
