"""The trie of conversations against one built from plain tuples."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from catalogflow.llm import prefixes

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n double, block string, level int, id string"


def by_hand(rows, rebuild=True):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    md5 = lambda t: hashlib.md5(f"{len(t[2])}:{t[2]}:{t[3]}".encode()).hexdigest()
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: (t[0], t[1], md5(t)))] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        whole[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * words
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), parent, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def built(spark, rows, rebuild=True, width=8):
    table = spark.createDataFrame([(*r, 1.0, "x", 3, "y") for r in rows], SCHEMA)
    own = prefixes.turns(table)
    c = F.col("conv_id")
    kept = F.crc32(c.cast("string")) % 4 if rebuild else F.lit(0)
    return sorted(map(tuple, prefixes.trie(prefixes.branched(own, c - c % 20, kept, at_most=3), width).collect()))


def made(rng, n=60, longest=7, words=("a", "b b", "", None, " c\n\td ")):
    rows = []
    for c in rng.sample(range(-30, 200), n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "user", None, ""]), rng.choice(words)))
    return rows


@pytest.mark.parametrize("width", [1, 3, 8])
def test_equal_to_plain_tuples(spark, width):
    """Null turns, roles, texts and ids, equal turns, repeated rows, absent and short bases, conversations left without turns."""
    rows = made(random.Random(width))
    rows += rows[:15] + [(None, 1, "user", "a"), (1000, 0, "user", "lonely"), (1000, 1, "user", "b")]
    got = built(spark, rows, width=width)
    assert got == by_hand(rows) and len(got) > 100


def test_long_conversations_go_on_in_further_blocks(spark):
    rng = random.Random(8)
    rows = [(c, t, "user", rng.choice("xxxxxy") if t % 9 == 8 else "x") for c in range(12) for t in range(rng.choice([5, 40, 41, 64]))]
    want = by_hand(rows, rebuild=False)
    assert max(r[1] for r in want) == 64
    assert built(spark, rows, rebuild=False, width=4) == want


def test_one_very_long_conversation_and_many_equal_ones(spark):
    rows = [(7, t, "u", f"w{t % 3} z") for t in range(1500)] + [(100 + c, t, "u", f"w{t} z") for c in range(300) for t in range(3)]
    assert built(spark, rows, rebuild=False, width=16) == by_hand(rows, rebuild=False)


def test_no_rows_no_nodes_and_turnless_members(spark):
    assert built(spark, []) == [] and built(spark, [(None, 1, "u", "a")]) == []
    turnless = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 0)
    rows = [(turnless, 0, "u", "gone")]
    assert built(spark, rows) == by_hand(rows) == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]


def test_chunks_of_ids_are_hashed_in_order(spark, monkeypatch):
    ids = spark.range(-50, 20000).select(F.lit(2).cast("bigint").alias("depth"), F.lit(1).cast("bigint").alias("d1"), F.lit(1).cast("bigint").alias("d2"), F.col("id").alias("conv_id"))
    got = prefixes._digests(ids).collect()
    assert [tuple(r) for r in got] == [(2, 1, 1, hashlib.sha256(",".join(map(str, range(-50, 20000))).encode()).hexdigest())]
