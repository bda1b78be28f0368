"""Hard negatives against plain sums in whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogflow.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, q double, seeker string"


def by_hand(rows, every=5, positives=5, k=3):
    rows = {(i, tuple(v), lab) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab, v) for i, v, lab in rows]
    out = []
    for a in rows:
        if a[0] % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[1], c[1])), c[0], c[2]) for c in rows if c is not a and len(c[1]) == len(a[1]))
        for s, i, lab in [x for x in scored if x[2] == a[2]][:positives]:
            near = [(t, j) for t, j, other in scored if other != a[2] and 50 * -s <= 100 * -t <= 95 * -s][:k]
            out += [(a[0], i, rank, j, -s, -t) for rank, (t, j) in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows, every=5, **options):
    table = spark.createDataFrame([(i, v, lab, 1.0, "x") for i, v, lab in rows], SCHEMA)
    return sorted(map(tuple, negatives.mine(negatives.prepared(table), F.col("id") % every == 0, **options).collect()))


def test_equal_to_plain_sums_with_ties_repeats_and_odd_rows(spark):
    rng = random.Random(4)
    rows = [(k, [rng.choice([0.25, 0.5, 0.75, 1.0, -0.125]) for _ in range(11)], rng.choice([0, 0, 0, 1, 2])) for k in range(300)]
    rows += rows[:20]  # repeated as a whole
    rows += [(5, [0.5] * 11, 1), (7, [0.5] * 11, 0)]  # further rows of an id
    rows += [(None, [1.0] * 11, 0), (400, None, 0), (401, [1.0] * 11, None), (402, [None] * 11, 1), (403, [math.nan] * 11, 1), (404, [math.inf] * 11, 0)]
    rows += [(410, [1.0, 0.5], 0), (415, [0.5, 1.0], 0), (416, [0.5, 0.5], 1), (420, [], 1), (425, [], 1), (430, [], 2)]
    got = mined(spark, rows)
    assert got == by_hand(rows) and len(got) > 100
    assert mined(spark, rows, anchor_block=7, candidate_block=16) == got


def test_scores_are_inner_products_of_whole_numbers():
    rng = np.random.default_rng(2)
    for bits, dims in ((1, 3), (9, 64), (20, 17), (40, 8)):
        a, c = (rng.integers(-(1 << bits), 1 << bits, (n, dims)) for n in (5, 40))
        packed, planes = negatives.bit_planes(c)
        assert planes <= bits + 1
        want = (c.astype(object) @ a.T.astype(object) + (1 << 63)) % (1 << 64) - (1 << 63)
        assert (negatives.scores(packed, negatives.subset_sums(a)) == want.astype(np.int64)).all()
    got = [(s, a.start, p.start) for a, p, s in negatives._blocks(c, a)]
    assert len(got) == 1 and (got[0][0] == want.T.astype(np.int64)).all()


def test_quantized_rounds_down_and_wraps_far_beyond():
    got = negatives.quantized(np.array([0.5, -0.001, -1.0, 0.0, 2.0**53, 1e300, -(2.0**55)]), 256)
    assert got[:5].tolist() == [128, -1, -256, 0, 1 << 61]
    assert got[5] == (int(1e300) * 256 + (1 << 63)) % (1 << 64) - (1 << 63) and got[6] == -(1 << 63)


@pytest.mark.parametrize("score", [0, 1, 7, 99, 100, 101, 12345, -1, -250, 2**62])
def test_bounds(score):
    low, high = negatives.bounds(np.array([score]), 50, 95)
    assert low[0] == -(-50 * score // 100) and high[0] == 95 * score // 100


def test_tables_without_rows_or_anchors_give_none(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0), (2, [0.9], 0), (3, [0.8], 1)]) == []
    assert mined(spark, [(5, [1.0], 0), (3, [0.8], 1)]) == []
    assert mined(spark, [(5, [1.0], 0), (6, [1.0], 0), (3, [0.8], 1)]) == [(5, 6, 1, 3, 65536, 256 * 204)]
    assert mined(spark, [(5, [1.0], 0), (6, [-1.0], 0), (3, [-0.7], 1)]) == []  # a negative score has no window


def test_one_label_holding_most_rows(spark):
    rng = np.random.default_rng(9)
    rows = [(k, rng.normal(size=16).tolist(), 0 if k % 10 else 1) for k in range(400)]
    assert mined(spark, rows, candidate_block=32, anchor_block=8) == by_hand(rows)
