"""N-gram Jaccard join: size-banded tiles, bitmap signatures as a bound, exact intersection of sorted arrays."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from ..session import batches_of, discard, materialize
from .arrays import mix, shingles, slices, utf8, word_ranges, with_arrow, words
from .components import bitmap, components, in_bitmap

_U = np.uint64
PARITY_BITS = 512
TRIES = 2
_ROWS = 500  # documents whose bitmaps are held at once
_BYTES = 1 << 22  # of the Arrow batches of texts
_KEYS = 1 << 16  # keys that are held at once, besides those of one set
SPARE = 2  # least number of partitions beyond the bound, so that an empty partition in common proves nothing
LEFT_OUT = 0.9  # of the keys a set could spare; the others are told by their number in common


def sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of every text."""
    for a, b in slices(texts):
        data, at = utf8(texts.slice(a, b - a))
        hashes, starts, _ = words(data, at)
        first = word_ranges(at, starts)
        for k in range(b - a):
            yield a + k, np.unique(shingles(hashes[first[k] : first[k + 1]], size))


class Bands:
    """Sizes in bands whose upper end is half as large again as the lower; a band's tile has a number of partitions.

    Sets x and y are linked when den * |x & y| >= num * |x | y|; then |x ^ y| <= (|x| + |y|) * (den - num) / (den + num).
    With more partitions of the hash range than this bound some partition is the same in both; with more of them by r,
    so are r. Then each set may leave out r - 1 of its partitions, if all sets agree on which go first: of those in
    common the last in that order is left out by neither. Those with fewest shingles go first, as unlike sets have
    these in common, too: empty ones, then single shingles of a common phrase.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.low = [1]
        self.spares: dict[int, int] = {}
        self.known: dict[int, list[tuple[int, int, int]]] = {}

    def reach(self, n: int) -> int:
        """Of |x ^ y| for sizes whose sum is n."""
        return n * (self.den - self.num) // (self.den + self.num)

    def tiles(self, n: int) -> list[tuple[int, int, int]]:
        """Bands in which a set of n meets its partners, with their partitions and how many of these it leaves out."""
        if n not in self.known:
            most = n * self.den // self.num
            while self.low[-1] <= 2 * most + 2:
                self.low.append(max(self.low[-1] + 1, self.low[-1] * 3 // 2))
            j = int(np.searchsorted(self.low, n, side="right")) - 1
            self.known[n] = []
            for j in [j] if most < self.low[j + 1] else [j, j + 1]:
                top = self.low[j + 1] - 1
                if k := self.reach(2 * top):
                    m = k + 1 + self.spare(j)
                    same = m - self.reach(n + min(most, top))  # with the largest partner
                    self.known[n].append((j, m, int((same - 1) * LEFT_OUT)))
        return self.known[n]

    def common(self, x: int, y: int) -> int:
        """Least number of keys that linked sets of x and y have in common."""
        own = {j: out for j, _, out in self.tiles(x)}
        return sum(m - self.reach(x + y) - max(own[j], out) for j, m, out in self.tiles(y) if j in own)

    def spare(self, j: int) -> int:
        """Partitions of band j beyond the bound: more than a set of the band leaves empty but by rare chance.

        Where sets are so small that most partitions stay empty anyway, SPARE of them will do.
        """
        if j not in self.spares:
            k, spare = self.reach(2 * (self.low[j + 1] - 1)), SPARE
            for _ in range(50):
                m = k + 1 + spare
                empty = m * math.exp(-self.low[j] / m)
                spare = math.ceil(empty + 5 * math.sqrt(empty)) + SPARE
                if spare > k:
                    break
            self.spares[j] = spare if spare <= k else SPARE
        return self.spares[j]

    def keys(self, s: np.ndarray) -> np.ndarray:
        """A key for each partition of each tile that is not left out: band, partition and content."""
        out = [np.zeros(0, np.uint64)]
        scrambled = mix(s)
        for j, m, less in self.tiles(len(s)) if len(s) else ():
            part = (((s >> _U(32)) * _U(m)) >> _U(32)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            content = np.zeros(m, np.uint64)
            content[part[first]] = np.add.reduceat(scrambled, first)
            found = mix(content + mix(np.arange(m, dtype=np.uint64) + (_U(j) << _U(40))))
            out.append(found[np.lexsort((found, np.bincount(part, minlength=m)))[less:]])
        return np.concatenate(out)


def _parity(s: np.ndarray) -> np.ndarray:
    odd = np.bincount((s & _U(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def name(s: np.ndarray) -> int:
    """64 bits that stand for a set."""
    return int(mix(np.array([mix(s + _U(0x51)).sum(dtype=np.uint64) + _U(len(s))], np.uint64)).view(np.int64)[0])


def _named(texts: pa.Array, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    found = [s for _, s in sets(texts, size) if len(s)]
    return np.array([name(s) for s in found], np.int64), found


def lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows).view(np.int64))) if rows else pa.array([], pa.large_list(pa.int64()))


def _features(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, number of shingles, name of the set (64 bits; 0 if empty) and parity bitmap."""

    def fn(batches):
        for whole in batches:
            for first in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(first, _ROWS)
                n, names, bits = [], [], []
                for _, s in sets(batch.column(1), size):
                    n.append(len(s))
                    names.append(name(s) if len(s) else 0)
                    bits.append(_parity(s))
                columns = [pa.array(n, pa.int64()), pa.array(names, pa.int64()), lists(bits).cast(pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n", "h", "bits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(fn, f"doc_id {kind}, n bigint, h bigint, bits array<bigint>")


def flat_keys(found: Iterable[tuple[int, Callable[[], np.ndarray]]], held: Broadcast | None) -> Iterator[pa.RecordBatch]:
    """Rows (h, key) of sets given by name and keys, each name once; of keys in the held bitmap alone, if there is one."""

    def rows() -> pa.RecordBatch:
        h, key = np.repeat(np.array(names, np.int64), [len(k) for k in keys]), np.concatenate(keys).view(np.int64)
        if held is not None:
            ok = in_bitmap(held.value, key)
            h, key = h[ok], key[ok]
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(key)], ["h", "key"])

    seen: set[int] = set()
    names, keys, many = [], [], 0
    for h, own in found:
        if h in seen:
            continue
        seen.add(h)
        names.append(h)
        keys.append(own())
        many += len(keys[-1])
        if many >= _KEYS:
            yield rows()
            names, keys, many = [], [], 0
    if names:
        yield rows()


def _keyed(rows: DataFrame, size: int, num: int, den: int) -> Callable[[Broadcast | None], DataFrame]:
    """Partition keys worked out from the texts whenever they are asked for: as a table they would outweigh the texts."""

    def keyed(held: Broadcast | None = None) -> DataFrame:
        def fn(batches):
            bands = Bands(num, den)
            for batch in batches:
                found = (s for _, s in sets(batch.column(0), size) if len(s))
                yield from flat_keys(((name(s), lambda s=s: bands.keys(s)) for s in found), held)

        return rows.select("text").mapInArrow(fn, "h bigint, key bigint")

    return keyed


def _enough(num: int, den: int) -> Callable[[pa.Array, pa.Array, pa.Array], pa.Array]:
    """Whether two sizes and the number of keys in common allow a link."""

    def enough(x: pa.Array, y: pa.Array, n: pa.Array) -> pa.Array:
        bands = Bands(num, den)
        return pa.array([k >= bands.common(a, b) for a, b, k in zip(x.to_pylist(), y.to_pylist(), n.to_pylist(), strict=True)], pa.bool_())

    return enough


def _common(left: pa.Array, right: pa.Array) -> pa.Array:
    def values(x: pa.Array) -> np.ndarray:
        return np.asarray(x.values).view(np.uint64)  # sorted as such

    out = np.zeros(len(left), np.int64)
    for k in range(len(left)):
        a, b = values(left[k]), values(right[k])
        at = np.minimum(np.searchsorted(a, b), len(a) - 1)
        out[k] = int((a[at] == b).sum())
    return pa.array(out)


def cluster(
    rows: DataFrame, full: DataFrame, keyed: Callable[[Broadcast | None], DataFrame], items: Callable[[pa.Array], tuple[np.ndarray, list[np.ndarray]]],
    num: int, den: int, words: int, spent: DataFrame | None = None, enough: Callable[[pa.Array, pa.Array, pa.Array], pa.Array] | None = None,
) -> DataFrame:
    """h and component of every set that is linked: den * |common| >= num * |union|.

    full: a row per occurrence of a set with doc_id, n (its size), h (its name) and bits (a parity bitmap of so many 64-bit
    words). keyed: rows (h, key) of every set, repeated or not, of which linked sets share a key; given a bitmap, those
    whose key is in it. items: names and sorted arrays of all sets of some texts, with which the arrays of sets that share
    a key are read again from rows (doc_id, text). spent: the table behind full, if nothing else reads it; it goes as soon
    as the keys have been looked up, before any array is moved. enough: whether sets of two sizes that have so many keys in
    common may be linked; without it one key will do.

    At each key one set stands for the others: first the smallest, then the one that meets most sets. A few times, each
    set outside its component is compared with one of these, the one with most keys in common. The verified links make
    components; then all partners of different components, bound by sizes, bitmaps and the number of keys they have in
    common, are verified, each pair once. Pairs in one component need no look.
    """
    spark = rows.sparkSession
    names = full.groupBy("h").agg(F.min("doc_id").alias("first"))
    shared = (
        keyed(None).groupBy("key").agg(F.min("h").alias("least"), F.max("h").alias("most")).filter("least < most")
    )
    shared = materialize(shared.select("key", "least"))
    bits = spark.sparkContext.broadcast(bitmap(shared, F.col("key"), 25))

    members = materialize(keyed(bits).join(shared, "key").distinct())
    nodes = materialize(members.select("h").distinct().join(names, "h"))
    parts = range(words)
    summary = full.select("h", "n", *[F.col("bits")[i].alias(f"p{i}") for i in parts]).join(nodes.select("h"), "h", "left_semi")
    summary = materialize(summary.dropDuplicates(["h"]))
    discard(shared, *([] if spent is None else [spent]))

    def sides(df: DataFrame, own: list[str]) -> tuple[DataFrame, DataFrame]:
        """The frame twice, with an x or a y after the names of its own columns."""
        x, y = (df.select(*[c for c in df.columns if c not in own], *[F.col(c).alias(c + side) for c in own]) for side in "xy")
        return x, y

    def bounded() -> Column:
        """Sizes and bitmaps allow a link."""
        differ = sum((F.bit_count(F.col(f"p{i}x").bitwiseXOR(F.col(f"p{i}y"))).cast("bigint") for i in parts), F.lit(0).cast("bigint"))
        total = F.col("nx") + F.col("ny")
        return (F.least("nx", "ny") * den >= F.greatest("nx", "ny") * num) & (differ * (den + num) <= total * (den - num))

    def arrays(wanted: DataFrame) -> DataFrame:
        """h and the array of the sets wanted (h, first), read from the texts again: bitmaps rule out nearly all others."""
        held = spark.sparkContext.broadcast((bitmap(wanted, F.col("h"), 22), bitmap(wanted, F.xxhash64("first"), 22)))

        def read(batches):
            by_set, by_doc = held.value
            for batch in batches:
                texts = batch.column(0).filter(pa.array(in_bitmap(by_doc, np.asarray(batch.column(1)))))
                for a, b in slices(texts):
                    own, found = items(texts.slice(a, b - a))
                    if len(own) and (hit := in_bitmap(by_set, own)).any():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own[hit]), lists([s for s, y in zip(found, hit, strict=True) if y]).cast(pa.list_(pa.int64()))], ["h", "s"]
                        )

        return rows.select("text", F.xxhash64("doc_id").alias("k")).mapInArrow(read, "h bigint, s array<bigint>")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b, na, nb) that are linked. Only sets of these pairs have their arrays moved; they go afterwards."""
        sets_met = pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct()
        wanted = materialize(sets_met.join(nodes, "h"))
        content = arrays(wanted).dropDuplicates(["h"])  # what bitmaps let through besides meets no pair
        both = pairs.join(content.select(F.col("h").alias("a"), F.col("s").alias("x")), "a").join(content.select(F.col("h").alias("b"), F.col("s").alias("y")), "b")
        counted = with_arrow(both, "both", [F.col("x"), F.col("y")], "bigint", _common).drop("x", "y")
        found = materialize(counted.filter((F.col("na") + F.col("nb") - F.col("both")) * num <= F.col("both") * den).select("a", "b"))
        discard(wanted)
        return found

    def sized(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with sizes na and nb that sizes and bitmaps allow."""
        left, right = sides(summary, summary.columns)
        both = pairs.join(left.withColumnRenamed("hx", "a"), "a").join(right.withColumnRenamed("hy", "b"), "b").filter(bounded())
        return both.select("a", "b", F.col("nx").alias("na"), F.col("ny").alias("nb"))

    def still_open(rows: DataFrame, links: DataFrame) -> DataFrame:
        """key, h and label (the component) at the keys where components still meet, with the one that stands for the key."""
        labels = components(links).withColumnRenamed("node", "h")
        own = materialize(rows.select("key", "h").join(labels, "h", "left").select("key", "h", F.coalesce("component", "h").alias("label")))
        meeting = materialize(own.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count(F.lit(1)).alias("n")).filter("a < b").select("key", "n"))
        held = spark.sparkContext.broadcast(bitmap(meeting, F.col("key"), 25))
        near = F.arrow_udf(lambda keys: pa.array(in_bitmap(held.value, np.asarray(keys))), "boolean")
        every, own = own, materialize(own.filter(near("key")).join(meeting, "key"))
        discard(every)
        weights = own.groupBy("h").agg(F.sum("n").alias("weight"))  # how many it meets
        top = own.join(weights, "h").groupBy("key").agg(F.max(F.struct("weight", "h", "label")).alias("top"))
        out = materialize(own.drop("n").join(top, "key"))
        discard(own, meeting)
        return out

    links = tried = spark.createDataFrame([], "a bigint, b bigint")
    near = members.filter("h <> least").groupBy(F.col("h").alias("a"), F.col("least").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    open_ = members
    for turn in range(TRIES):  # each set with the one it shares most keys with, of those that stand for their key
        best = near.join(tried, ["a", "b"], "left_anti").groupBy("a").agg(F.max(F.struct("n", "b")).alias("best"))
        one = materialize(best.select("a", F.col("best.b").alias("b")))
        allowed = materialize(sized(one))
        links = links.union(verified(allowed))
        tried = tried.union(one)
        before, open_ = open_, still_open(open_, links)
        discard(allowed, before)
        outside = open_.filter("label <> top.label")
        near = outside.groupBy(F.col("h").alias("a"), F.col("top.h").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    x, y = sides(open_.select("key", "h", "label").join(summary, "h"), ["h", "label", *[c for c in summary.columns if c != "h"]])
    meets = (F.col("hx") < F.col("hy")) & (F.col("labelx") != F.col("labely")) & bounded()
    met = x.join(y, "key").filter(meets).groupBy(F.col("hx").alias("a"), F.col("hy").alias("b"), F.col("nx").alias("na"), F.col("ny").alias("nb"))
    pairs = met.agg(F.count(F.lit(1)).alias("n"))  # all their keys: one where two components meet is still open
    if enough is not None:
        pairs = with_arrow(pairs, "ok", [F.col("na"), F.col("nb"), F.col("n")], "boolean", enough).filter("ok")
    pairs = materialize(pairs.select("a", "b", "na", "nb"))
    links = links.union(verified(pairs))
    discard(pairs, open_, summary, nodes)
    return components(links).withColumnRenamed("node", "h")


def similar(docs: DataFrame, num: int = 90, den: int = 100, size: int = 3, doc_id: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row: documents linked when den * |common| >= num * |union|.

    A document's set: its distinct shingles of `size` words (A-Z lower-cased, between ASCII white space), the whole
    sequence if it has fewer words, nothing without words. component_id is the smallest doc_id reachable over links.
    Null and empty texts are linked with nothing and are their own component. Rows that repeat a text are one class.
    A row without doc_id belongs to its text's class and never names one. Other columns play no part; an empty table
    gives no rows. Sets are named by 64 bits (two of n sets share a name with probability n * n / 2**65).

    Keys are hash partitions by size band, of which linked sets share one at least, large ones many (Bands). Verification
    compares sizes, then the bits of the parity bitmaps (a lower bound of the difference), the number of keys in common,
    then the sorted arrays.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.col(text) if isinstance(text, str) else text).alias("text"))
    with batches_of(docs.sparkSession, _BYTES):
        known = materialize(_features(rows, size))
        own = materialize(known.select("doc_id", "n", "h"))
        keyed, items = _keyed(rows, size, num, den), lambda texts: _named(texts, size)
        groups = cluster(rows, known.filter("n > 0"), keyed, items, num, den, PARITY_BITS // 64, known, _enough(num, den))
    placed = own.join(groups, "h", "left").withColumn("group", F.when(F.col("n") > 0, F.coalesce("component", "h")))
    placed = materialize(placed.select("doc_id", "n", "group"))
    discard(own)
    least = placed.filter("`group` IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    out = placed.join(least, "group", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
