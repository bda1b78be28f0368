"""Hard negatives by exact integer scores: subset-sum tables of anchors, indexed by candidates' packed bit planes.

A score is an inner product of integers. Eight dimensions of an anchor make a table of its 256 subset sums; one bit of
eight dimensions of a candidate is one byte, and so an index into that table. The sum over the groups of eight, shifted
by the bit's place and added over all places, is the full score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .arrays import with_arrow

GROUP = 8
TABLE_BYTES = 1 << 25
SCORES = 1 << 18
_NONE = np.iinfo(np.int64).min


def quantized(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles as signed 64-bit integers; beyond these, modulo 2**64."""
    with np.errstate(over="ignore"):
        x = np.floor(values * float(scale))
    small = np.abs(x) < 2.0**62
    out = np.where(small, x, 0).astype(np.int64)
    for k in np.flatnonzero(~small):  # scale * x may be beyond doubles, so in whole numbers
        top, bottom = float(values[k]).as_integer_ratio()
        out[k] = ((top * scale // bottom) + (1 << 63)) % (1 << 64) - (1 << 63)
    return out


def bit_planes(vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """Bytes [row, plane, group of eight dimensions] of two's complements with as many planes as needed; that number."""
    dims = vectors.shape[1]
    spread = np.where(vectors < 0, ~vectors, vectors)
    planes = min(64, (int(spread.max()).bit_length() if spread.size else 0) + 1)
    padded = np.zeros((len(vectors), -(-dims // GROUP) * GROUP), np.int64)
    padded[:, :dims] = vectors
    out = np.empty((len(vectors), planes, padded.shape[1] // GROUP), np.uint8)
    for b in range(planes):
        out[:, b] = np.packbits(((padded >> b) & 1).astype(np.uint8), axis=1, bitorder="little")
    return out, planes


def subset_sums(anchors: np.ndarray, kind=np.int64) -> np.ndarray:
    """Tables [group, byte, anchor]: the sum of the anchor's dimensions that the byte's bits choose."""
    dims = anchors.shape[1]
    padded = np.zeros((len(anchors), -(-dims // GROUP) * GROUP), kind)
    padded[:, :dims] = anchors
    by_group = padded.reshape(len(anchors), padded.shape[1] // GROUP, GROUP)
    out = np.zeros((by_group.shape[1], 1 << GROUP, len(anchors)), kind)
    for bit in range(GROUP):  # tables double with each dimension
        out[:, 1 << bit : 2 << bit] = out[:, : 1 << bit] + by_group[:, :, bit].T[:, None, :]
    return out


def scores(packed: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Inner products [candidate, anchor], modulo 2**64."""
    planes = packed.shape[1]
    out = np.zeros((len(packed), tables.shape[2]), tables.dtype)
    looked_up = np.empty_like(out)
    for b in range(planes - 1, -1, -1):  # from the sign down, doubling what is there
        out <<= 1
        for g in range(len(tables)):
            np.take(tables[g], packed[:, b, g], axis=0, out=looked_up, mode="clip")
            if b == planes - 1:
                out -= looked_up
            else:
                out += looked_up
    return out


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    vectors = vectors.combine_chunks()
    flat = np.asarray(vectors.flatten())
    return flat.reshape(len(vectors), len(flat) // max(1, len(vectors)))


class _Best:
    """The k highest scores per anchor so far, with their candidates; ties stay with the earlier candidate."""

    def __init__(self, anchors: int, k: int):
        self.score = np.full((anchors, k), _NONE)
        self.row = np.zeros((anchors, k), np.int64)

    def add(self, valid: np.ndarray, start: int) -> None:
        """valid: scores [anchor, candidate from start on], _NONE for none."""
        open_ = np.flatnonzero(valid.max(axis=1) > self.score[:, -1])  # others have nothing that comes in
        if not len(open_):
            return
        k = self.score.shape[1]
        both = np.concatenate([self.score[open_], valid[open_]], axis=1)
        rows = np.concatenate([self.row[open_], np.broadcast_to(np.arange(start, start + valid.shape[1]), (len(open_), valid.shape[1]))], axis=1)
        every = np.arange(len(open_))
        for place in range(k):
            best = both.argmax(axis=1)
            self.score[open_, place], self.row[open_, place] = both[every, best], rows[every, best]
            both[every, best] = _NONE

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchors, candidates and scores."""
        anchor, place = np.nonzero(self.score != _NONE)
        return anchor, self.row[anchor, place], self.score[anchor, place]


def _blocks(candidates: np.ndarray, anchors: np.ndarray):
    """(anchor range, then candidate range and scores [anchor, candidate]) in pieces that bound tables and scores."""
    packed, planes = bit_planes(candidates)
    largest = np.abs(anchors.astype(np.float64)).sum(axis=1).max() if anchors.size else 0
    kind = np.int32 if largest * 2.0**planes < 2**31 else np.int64
    some = max(1, TABLE_BYTES // ((1 << GROUP) // GROUP * 8 * max(GROUP, anchors.shape[1])))
    for a in range(0, len(anchors), some):
        at = slice(a, min(a + some, len(anchors)))
        tables = subset_sums(anchors[at], kind)
        step = max(1, SCORES // (at.stop - at.start))
        for c in range(0, len(packed), step):
            part = slice(c, min(c + step, len(packed)))
            yield at, part, np.ascontiguousarray(scores(packed[part], tables).T).astype(np.int64)


def prepared(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256) -> DataFrame:
    """row_key, id, label, size and q (floor(scale * x) per component) of the rows that take part, each once."""
    v = F.col(vector).cast("array<double>")
    base = rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    base = base.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))

    def whole(vectors: pa.Array) -> pa.Array:
        flat = quantized(np.asarray(vectors.flatten()).astype(np.float64), scale)
        lengths = np.asarray(pc.list_value_length(vectors)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(flat))

    q = with_arrow(base.distinct(), "q", [F.col("v")], "array<bigint>", whole)
    return q.select(F.xxhash64("id", "label", "v").alias("row_key"), "id", "label", F.size("q").alias("size"), "q")


def mine(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95,
    anchor_block: int = 1024, candidate_block: int = 16384,
) -> DataFrame:
    """Per anchor its nearest rows of the same label, and per such positive the nearest of other labels in a score window.

    rows: as from `prepared`; anchors: a condition on id and label. Positives of an anchor are its first `positives` other
    rows of its label by score, highest first, ties by smaller id. The negatives of a positive are the first `negatives`
    rows of other labels with low_percent * positive_score <= 100 * score <= high_percent * positive_score. Result:
    anchor_id, positive_id, rank (from 1, among those returned), negative_id, positive_score, negative_score. Scores are exact
    64-bit integers (modulo 2**64 where they would not fit). Rows repeated as a whole count once; different rows of one id
    are rows of their own, also as anchors. Rows of another length than the anchor's are not compared with it. An empty
    table, a table without anchors and an anchor without such negatives give no rows.

    Every anchor meets every row of its length in blocks: anchors in about rows / anchor_block groups by hash, rows in
    groups of about candidate_block, and a task per pair of groups holds only these two and emits what may be among the
    first. The first pass meets anchors with rows of the same label only, and a hot label has as many groups as it needs.
    """
    spark_rows = materialize(rows)
    asked = materialize(spark_rows.filter(anchors))
    spread = F.xxhash64("row_key", F.lit(7))

    def grid(candidates: DataFrame, seekers: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
        """Both sides with all pairs of their hash groups within `key`: columns s (group of seekers) and c (of candidates)."""
        counts = candidates.groupBy(*key).agg(F.ceil(F.count("id") / candidate_block).cast("int").alias("n_c"))
        counts = counts.join(seekers.groupBy(*key).agg(F.ceil(F.count("id") / anchor_block).cast("int").alias("n_s")), key)

        def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
            placed = side.join(counts, key).withColumn(own, F.pmod(spread, f"n_{own}").cast("int"))
            return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1))).drop("n_c", "n_s")

        return dealt(candidates, "c", "s"), dealt(seekers, "s", "c")

    def pairs(fn, schema: str):
        """fn(candidates in order of id, seekers) for a pair of groups; names and types as in the schema."""
        names = [part.split()[0] for part in schema.split(", ")]

        def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
            kinds = [{"bigint": pa.int64(), "int": pa.int32()}[part.split()[1]] for part in schema.split(", ")]
            empty = [pa.array([], kind) for kind in kinds]
            if not left.num_rows or not right.num_rows:
                return pa.table(empty, names)
            found = fn(left.sort_by([("id", "ascending"), ("row_key", "ascending")]).combine_chunks(), right.combine_chunks())
            return pa.table([pa.array(column, kind) for column, kind in zip(found, kinds, strict=True)], names)

        return run

    def column(table: pa.Table, name: str) -> np.ndarray:
        return np.asarray(table[name].combine_chunks()) if table.num_rows else np.zeros(0, np.int64)

    def nearest(left: pa.Table, right: pa.Table):
        """Up to `positives` rows per anchor of a pair of groups of one label."""
        key, ids, own, own_id = column(left, "row_key"), column(left, "id"), column(right, "row_key"), column(right, "id")
        best: dict[int, _Best] = {}
        for at, part, s in _blocks(_matrix(left["q"]), _matrix(right["q"])):
            here = best.setdefault(at.start, _Best(at.stop - at.start, positives))
            here.add(np.where((key[part] == own[at, None]) & (ids[part] == own_id[at, None]), _NONE, s), part.start)
        out = []
        for first, here in best.items():
            anchor, row, score = here.found()
            out.append((own[first + anchor], own_id[first + anchor], ids[row], key[row], score))
        return [np.concatenate(c) for c in zip(*out, strict=True)]

    found_schema = "seeker bigint, anchor_id bigint, positive_id bigint, positive_key bigint, positive_score bigint"
    candidates, seekers = grid(spark_rows, asked, ["label", "size"])
    near = candidates.groupBy("label", "size", "c", "s").cogroup(seekers.groupBy("label", "size", "c", "s")).applyInArrow(pairs(nearest, found_schema), found_schema)
    first = F.row_number().over(Window.partitionBy("seeker", "anchor_id").orderBy(F.desc("positive_score"), "positive_id", "positive_key"))
    placed = materialize(near.withColumn("place", first).filter(F.col("place") <= positives))

    wanted = placed.groupBy("seeker", "anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("found"))
    wanted = wanted.select("seeker", "anchor_id", F.transform("found", lambda s: s["positive_score"]).alias("targets"))
    with_targets = asked.join(wanted, (asked["row_key"] == wanted["seeker"]) & (asked["id"] == wanted["anchor_id"])).drop("seeker", "anchor_id")

    def within(left: pa.Table, right: pa.Table):
        """Up to `negatives` rows per anchor and positive of a pair of groups."""
        key, ids, label, own, own_id, own_label = (column(t, c) for t in (left, right) for c in ("row_key", "id", "label"))
        targets = right["targets"].combine_chunks()
        goal = np.zeros((len(own), positives), np.int64)
        has = np.arange(positives) < np.asarray(pc.list_value_length(targets))[:, None]
        goal[has] = np.asarray(targets.flatten())
        low, high = bounds(goal, low_percent, high_percent)
        best: dict[tuple[int, int], _Best] = {}
        for at, part, s in _blocks(_matrix(left["q"]), _matrix(right["q"])):
            s[label[part] == own_label[at, None]] = _NONE
            for place in range(positives):
                here = best.setdefault((at.start, place), _Best(at.stop - at.start, negatives))
                inside = (s >= low[at, place, None]) & (s <= high[at, place, None]) & has[at, place, None]
                here.add(np.where(inside, s, _NONE), part.start)
        out = []
        for (first, place), here in best.items():
            anchor, row, score = here.found()
            out.append((own[first + anchor], own_id[first + anchor], np.full(len(anchor), place + 1), ids[row], key[row], score))
        return [np.concatenate(c) for c in zip(*out, strict=True)]

    hard_schema = "seeker bigint, anchor_id bigint, place int, negative_id bigint, negative_key bigint, negative_score bigint"
    candidates, seekers = grid(spark_rows, with_targets, ["size"])
    hard = candidates.groupBy("size", "c", "s").cogroup(seekers.groupBy("size", "c", "s")).applyInArrow(pairs(within, hard_schema), hard_schema)
    order = Window.partitionBy("seeker", "anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id", "negative_key")
    ranked = hard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    joined = ranked.join(placed.select("seeker", "anchor_id", "place", "positive_id", "positive_score"), ["seeker", "anchor_id", "place"])
    return joined.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")


def bounds(score: np.ndarray, low_percent: int, high_percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest n with low_percent * score <= 100 * n <= high_percent * score, without overflow."""
    whole, rest = score // 100, score % 100
    return whole * low_percent - (-rest * low_percent) // 100, whole * high_percent + rest * high_percent // 100
