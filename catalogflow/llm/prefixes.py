"""Trie of conversations: ROLLUP over positional columns of turn ids, in blocks of columns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.order import Running, group_position, running_values
from ..session import materialize

WIDTH = 8
_SPACE = r"[^\x20\x09-\x0D]+"
_CHUNK = 4096
_KEYS = ["block", "p1", "p2"]
NO_IDS = hashlib.sha256(b"").hexdigest()


def turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, pos (from 1) and id of every turn of a conversation in order.

    id: 24 bytes, the MD5 of role and text and then the number of words, so that equal turns have equal ids. Turns go by
    `turn` (null first), equal ones by id. Null roles and texts are empty; rows without conv_id take no part; rows that repeat
    are turns of their own. A conversation may be longer than a task: its turns are range-partitioned.
    """
    kept = rows.select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).filter("conv_id IS NOT NULL")
    words = F.regexp_count("text", F.lit(_SPACE)).cast("bigint")
    digest = F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))
    ids = F.unhex(F.concat(digest, F.lpad(F.hex(words), 16, F.lit("0"))))
    named = kept.select("conv_id", "turn", ids.alias("id"), F.monotonically_increasing_id().alias("row"))
    return group_position(materialize(named), ["conv_id"], ["turn", "id", "row"], "pos").select("conv_id", "pos", "id")


def words_of(turn_id: Column) -> Column:
    return F.conv(F.hex(F.substring(turn_id, 17, 8)), 16, 10).cast("bigint")


def branched(own: DataFrame, base: Column, kept: Column, at_most: int) -> DataFrame:
    """Conversations that begin like another one: the first `kept` turns of conversation `base`, then their own after `kept`.

    own: as from `turns`; base and kept: expressions over conv_id; at_most: the largest value of kept. A base that is
    absent gives no turns, a shorter one all it has. conv_id, n (turns now; 0 for none), pos and id; a conversation
    left without turns has one row with null pos and id.
    """
    lengths = own.groupBy("conv_id").agg(F.max("pos").alias("n_own")).withColumns({"base": base, "kept": kept})
    heads = own.filter(F.col("pos") <= at_most).select(F.col("conv_id").alias("base"), "pos", "id")
    size = lengths.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    taken = F.least("kept", F.coalesce("n_base", F.lit(0)))
    known = lengths.join(size, "base", "left").withColumn("taken", taken)
    known = materialize(known.withColumn("n", F.col("taken") + F.greatest(F.col("n_own") - F.col("kept"), F.lit(0))))
    first = known.filter("taken > 0").join(heads, "base").filter(F.col("pos") <= F.col("taken")).select("conv_id", "n", "pos", "id")
    # a long conversation meets its row in parts, each with a copy of that row
    part = F.floor((F.col("pos") - 1) / 1024)
    spread = known.filter("n_own > kept").select("conv_id", "n", "taken", "kept", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_own") - 1) / 1024))).alias("part"))
    rest = own.withColumn("part", part).join(spread, ["conv_id", "part"]).filter(F.col("pos") > F.col("kept"))
    rest = rest.select("conv_id", "n", (F.col("pos") - F.col("kept") + F.col("taken")).alias("pos"), "id")
    none = known.filter("n = 0").select("conv_id", "n", F.lit(None).cast("bigint").alias("pos"), F.lit(None).cast("binary").alias("id"))
    return first.unionByName(rest).unionByName(none)


def _lane(seed: int, turn_id: Column, pos: Column) -> Column:
    return F.xxhash64(F.lit(seed), turn_id, pos.cast("bigint"))


def _blocks(members: DataFrame, width: int) -> DataFrame:
    """A row per conversation and block: conv_id, n, block, p1 and p2 (name of the turns before), x1 and x2 (up to here), t1 .. tW.

    A sequence of turns is named by two 64-bit words: the exclusive or, over its turns, of a hash of turn and place.
    """
    block = F.coalesce(F.floor((F.col("pos") - 1) / width), F.lit(0)).alias("block")
    slot = F.pmod(F.col("pos") - 1, F.lit(width))
    lanes = [F.coalesce(F.bit_xor(F.when(F.col("id").isNotNull(), _lane(k, F.col("id"), F.col("pos")))), F.lit(0)).alias(f"o{k}") for k in (1, 2)]
    cells = [F.max(F.when(slot == j, F.col("id"))).alias(f"t{j + 1}") for j in range(width)]
    rows = members.groupBy("conv_id", block).agg(F.max("n").alias("n"), *lanes, *cells)
    running = [Running(f"x{k}", F.col(f"o{k}"), "xor") for k in (1, 2)]
    named = running_values(rows, ["conv_id"], ["block"], running)
    return named.withColumns({f"p{k}": F.col(f"x{k}").bitwiseXOR(F.col(f"o{k}")) for k in (1, 2)}).drop("o1", "o2")


def _columns(width: int) -> list[str]:
    return [f"t{j + 1}" for j in range(width)]


def _rolled_up(df: DataFrame, width: int, aggregates: str) -> DataFrame:
    """Aggregates of every prefix of t1 .. tW within (block, p1, p2), with its length in the block as `level`."""
    cells = ", ".join(_columns(width))
    held = df.sparkSession.sql(
        f"""SELECT block, p1, p2, {cells}, {width} - bit_count(grouping_id()) AS level, {aggregates}
        FROM {{cells}} GROUP BY block, p1, p2, ROLLUP ({cells})""",
        cells=df,
    )
    ended = " OR ".join(f"(level = {j + 1} AND t{j + 1} IS NULL)" for j in range(width))  # a prefix that no member has
    return held.filter(f"NOT ({ended})")


def _name(width: int, upto: Column) -> list[Column]:
    """p1 and p2 joined with the first `upto` turns of the block."""
    out = []
    for k in (1, 2):
        name = F.col(f"p{k}")
        for j in range(width):
            place = F.col("block") * width + (j + 1)
            name = name.bitwiseXOR(F.when(F.lit(j) < upto, _lane(k, F.col(f"t{j + 1}"), place)).otherwise(F.lit(0).cast("bigint")))
        out.append(name)
    return out


def _below(nodes: DataFrame) -> DataFrame:
    """leaves and saved of all nodes under each name where a block begins, over all later blocks: block, p1, p2, leaves, saved.

    A block's sums first hold its own nodes; then those 1, 2, 4, .. blocks further down are added, with every block knowing
    the one so far above it. The rounds are the logarithm of the deepest conversation's blocks.
    """
    own = nodes.filter("level > 0").groupBy("block", "p1", "p2").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))
    ends = nodes.filter("level > 0 AND boundary").select(
        (F.col("block") + 1).alias("block"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("p1").alias("u1"), F.col("p2").alias("u2")
    )
    now = materialize(own.join(ends, ["block", "p1", "p2"], "left"))
    deepest, step = now.agg(F.max("block")).first()[0] or 0, 1
    while step <= deepest:
        lifted = now.filter("u1 IS NOT NULL").groupBy((F.col("block") - step).alias("block"), F.col("u1").alias("p1"), F.col("u2").alias("p2"))
        more = lifted.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = now.select((F.col("block") + step).alias("block"), F.col("p1").alias("u1"), F.col("p2").alias("u2"), F.col("u1").alias("v1"), F.col("u2").alias("v2"))
        added = now.join(more, ["block", "p1", "p2"], "left").join(above, ["block", "u1", "u2"], "left")
        now = materialize(
            added.select(
                "block", "p1", "p2", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
                F.col("v1").alias("u1"), F.col("v2").alias("u2"),
            )
        )
        step *= 2
    return now.select("block", "p1", "p2", "leaves", "saved")


def _digests(members: DataFrame) -> DataFrame:
    """d1, d2, depth and the SHA-256 of the ascending ids, comma-joined, of the conversations that end at each node.

    Ids are range-partitioned by (node, id), so a node with very many has them in many partitions; each writes them as
    text in chunks, and the chunks of a node, thousands of times fewer, are hashed one after the other in order.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("depth", "d1", "d2", "conv_id")), strict=True)
            out = []
            for depth, d1, d2, conv in rows:
                if node != (depth, d1, d2) or len(ids) == _CHUNK:
                    if ids:
                        out.append((*node, ids[0], ",".join(map(str, ids))))
                    node, ids = (depth, d1, d2), []
                ids.append(conv)
            yield _batch(out, ["depth", "d1", "d2", "first", "ids"])
        if ids:
            yield _batch([(*node, ids[0], ",".join(map(str, ids)))], ["depth", "d1", "d2", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for depth, d1, d2, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "d1", "d2", "ids")), strict=True):
                if node == (depth, d1, d2):
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    out.append((*node, state.hexdigest()))
                node, state = (depth, d1, d2), hashlib.sha256(ids.encode())
            yield _batch(out, ["depth", "d1", "d2", "ends_sha256"])
        if state:
            yield _batch([(*node, state.hexdigest())], ["depth", "d1", "d2", "ends_sha256"])

    ordered = members.repartitionByRange(parts, "depth", "d1", "d2", "conv_id").sortWithinPartitions("depth", "d1", "d2", "conv_id")
    written = ordered.mapInArrow(chunks, "depth bigint, d1 bigint, d2 bigint, first bigint, ids string")
    dealt = written.repartition(parts, "depth", "d1", "d2").sortWithinPartitions("depth", "d1", "d2", "first")
    return dealt.mapInArrow(hashed, "depth bigint, d1 bigint, d2 bigint, ends_sha256 string")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"ids": pa.string(), "ends_sha256": pa.string()}
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for c, n in zip(columns, names, strict=True)], names)


def trie(members: DataFrame, width: int = WIDTH) -> DataFrame:
    """Every distinct prefix of the members' turns as a node.

    members: conv_id, n, pos, id as from `branched` (or `turns` with n, its conversation's length). Result, a row per node: conv_id
    (its smallest member), depth, parent_conv_id (null at the root), n_convs (members), n_children, n_leaves (childless
    nodes of its subtree, itself included), saved_tokens (over its subtree, (n_convs - 1) times the words of a node's last
    text), ends_sha256 (of the decimal ids of members with just these turns, ascending, comma-joined). No members, no rows.

    Block b holds turns b * width + 1 .. (b + 1) * width in columns; one ROLLUP over them, grouped by the block and the name of
    all turns before it, counts the prefixes of all blocks at once. A second ROLLUP over the nodes sums their subtrees,
    where a node at a block's end brings what all later blocks hold below it. Members are only counted, so a prefix that
    a third of all conversations share is one row per task before it is shuffled.
    """
    cells = materialize(_blocks(members, width))
    counted = _rolled_up(cells, width, "count(*) AS n_convs, min(conv_id) AS conv_id, max(n) AS longest")
    level = F.col("level")
    depth = F.col("block") * width + level
    turn = F.coalesce(*[F.when(level == j + 1, F.col(f"t{j + 1}")) for j in range(width)])
    here, above = _name(width, level), _name(width, level - 1)
    nodes = counted.withColumns(
        {
            "depth": depth, "d1": here[0], "d2": here[1], "e1": above[0], "e2": above[1], "leaf": (F.col("longest") == depth).cast("bigint"),
            "saved": F.when(level > 0, (F.col("n_convs") - 1) * words_of(turn)).otherwise(F.lit(0).cast("bigint")),
            "boundary": (level == width) & (F.col("longest") > depth),
        }
    )
    nodes = materialize(nodes.filter("level > 0 OR block = 0"))
    first = nodes.filter("level = 1 AND block > 0").groupBy("block", "p1", "p2").agg(F.count("conv_id").alias("first"))
    deeper = _below(nodes).filter("block > 0").join(first, ["block", "p1", "p2"])
    deeper = deeper.select(
        (F.col("block") - 1).alias("block"), F.col("p1").alias("d1"), F.col("p2").alias("d2"), "first", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved")
    )
    own = nodes.select(*_KEYS, *_columns(width), F.col("level").alias("own_level"), "conv_id", "n_convs", "leaf", "saved", "boundary", "d1", "d2")
    ends = own.filter("boundary").join(deeper, ["block", "d1", "d2"], "left")
    whole = ends.unionByName(own.filter("NOT boundary"), allowMissingColumns=True)

    children = ", ".join(f"count_if(own_level = {j + 1}) AS c{j + 1}" for j in range(width))
    summed = _rolled_up(
        whole, width,
        f"""min(conv_id) AS conv_id, max(n_convs) AS n_convs, sum(leaf + coalesce(more_leaves, 0)) AS n_leaves,
        sum(saved + coalesce(more_saved, 0)) AS saved_tokens, max(first) AS first, {children}""",
    ).filter("level > 0 OR block = 0")
    below = F.coalesce(*[F.when(level == j, F.col(f"c{j + 1}")) for j in range(width)], F.col("first"), F.lit(0))
    named = summed.select(
        "conv_id", depth.alias("depth"), "n_convs", below.alias("n_children"), "n_leaves", "saved_tokens",
        *[c.alias(n) for c, n in zip([*here, *above], ["d1", "d2", "e1", "e2"], strict=True)],
    )
    named = materialize(named)
    parents = named.filter("n_children > 0").select(F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"), F.col("d1").alias("e1"), F.col("d2").alias("e2"))
    last = cells.filter(F.col("n") <= (F.col("block") + 1) * width).select(F.col("n").alias("depth"), F.col("x1").alias("d1"), F.col("x2").alias("d2"), "conv_id")
    hashes = _digests(last)
    joined = named.join(parents, ["depth", "e1", "e2"], "left").join(hashes, ["depth", "d1", "d2"], "left")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256")
    )
