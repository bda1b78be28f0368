"""Large JSON documents read by many tasks: one array or object per file, cut into its elements.

A file is read in byte ranges (blocks) as pieces between commas, wherever these stand. Whether a piece begins inside a
string and how deep it lies are running sums over the pieces of its block, for both states the block may begin in. A table
with a few rows per block then tells how each block does begin and how many elements came before it, so no task needs the
document. Commas at depth one, outside strings, part the elements. A comma never follows a backslash in JSON, so escapes
end with their piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import materialize

_BLOCK = ["file", "block"]
_SPACE = " \t\n\x0b\f\r"  # what \s stands for


def _count(c: Column, mark: str) -> Column:
    """Number of uses of one character in a text."""
    return F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block, pos, piece, its first letter (null if blank), with its quotes and the change of depth if it begins outside (d0) or inside (d1) a string."""
    text = spark.read.option("lineSep", ",").text(path)
    value = F.col("value")
    bare = F.when(value.contains("\\"), F.regexp_replace(value, r"(?s)\\.", "")).otherwise(value)

    def change(outside: str) -> Column:
        found = {mark: _count(F.col(outside), mark) for mark in "[{]}"}
        return (found["["] + found["{"] - found["]"] - found["}"]).cast("bigint")

    placed = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"),
        value.alias("piece"), F.when(F.trim(value) != "", F.substring(F.ltrim(value, F.lit(_SPACE + "\ufeff")), 1, 1)).alias("head"), bare.alias("bare"),
    )
    quoted = placed.withColumn("quotes", _count(F.col("bare"), '"').cast("bigint"))
    outside = quoted.withColumns({
        "o0": F.when(F.col("quotes") == 0, F.col("bare")).otherwise(F.regexp_replace("bare", '"[^"]*("|$)', "")),
        "o1": F.when(F.col("quotes") == 0, "").otherwise(F.regexp_replace("bare", '^[^"]*"|"[^"]*("|$)', "")),
    })
    return materialize(outside.select(*_BLOCK, "pos", "piece", "head", "quotes", change("o0").alias("d0"), change("o1").alias("d1")))


def _within(pieces: DataFrame) -> DataFrame:
    """The pieces with running sums in their block: upto (quotes), deep0 and deep1 (depth, if the block begins outside or inside a string)."""
    own = Window.partitionBy(*_BLOCK).orderBy("pos")
    quoted = pieces.withColumn("upto", F.sum("quotes").over(own))
    outside = (F.col("upto") - F.col("quotes")) % 2 == 0
    stepped = quoted.withColumns({"s0": F.when(outside, F.col("d0")).otherwise(F.col("d1")), "s1": F.when(outside, F.col("d1")).otherwise(F.col("d0"))})
    return stepped.withColumns({"deep0": F.sum("s0").over(own), "deep1": F.sum("s1").over(own)})


def _ends(upto: Column, deep0: Column, deep1: Column) -> Column:
    """Whether an element ends where a piece does, in a block that begins with inside0 and depth0."""
    return ((upto + F.col("inside0")) % 2 == 0) & (F.col("depth0") + F.when(F.col("inside0") == 0, deep0).otherwise(deep1) == 1)


def _places(pieces: DataFrame) -> DataFrame:
    """A row per block: inside0, depth0 and idx0 as it begins, its number of ends, whether it is its file's first and last; and of the file kind, sound, most (the last idx)."""
    kinds = _within(pieces).groupBy(*_BLOCK, (F.col("upto") % 2).alias("odd"), "deep0", "deep1").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quotes").alias("quotes"), F.sum("s0").alias("s0"), F.sum("s1").alias("s1"),
        F.min(F.when(F.col("head").isNotNull(), F.struct("pos", "head"))).alias("lead"),
    )
    kinds = materialize(kinds)  # pieces that end alike, counted: few rows per block
    blocks = kinds.groupBy(*_BLOCK).agg(*[F.sum(c).alias(c) for c in ("quotes", "s0", "s1")], F.min("lead")["head"].alias("head"))
    order, every = Window.partitionBy("file").orderBy("block"), Window.partitionBy("file")  # one row per block
    blocks = blocks.withColumn("inside0", (F.sum("quotes").over(order) - F.col("quotes")) % 2)
    blocks = blocks.withColumn("d", F.when(F.col("inside0") == 0, F.col("s0")).otherwise(F.col("s1")))
    begun = blocks.withColumn("depth0", F.sum("d").over(order) - F.col("d"))
    ending = kinds.join(begun.select(*_BLOCK, "inside0", "depth0"), _BLOCK).filter(_ends(F.col("odd"), F.col("deep0"), F.col("deep1"))).groupBy(*_BLOCK).agg(F.sum("n").alias("ends"))
    counted = begun.join(ending, _BLOCK, "left").withColumn("ends", F.coalesce("ends", F.lit(0).cast("bigint")))
    kind = F.min_by("head", F.when(F.col("head").isNotNull(), F.col("block"))).over(every)
    closed = (F.sum("d").over(every) == 0) & (F.sum("quotes").over(every) % 2 == 0)
    return counted.select(
        *_BLOCK, "inside0", "depth0", (F.sum("ends").over(order) - F.col("ends")).alias("idx0"), "ends",
        (F.col("block") == F.min("block").over(every)).alias("first"), (F.col("block") == F.max("block").over(every)).alias("last"),
        kind.alias("kind"), F.coalesce(closed & kind.isin("[", "{"), F.lit(False)).alias("sound"), F.sum("ends").over(every).alias("most"),
    )


def _joined(parts: str, text: str) -> Column:
    return F.array_join(F.transform(F.array_sort(parts), lambda s: s[text]), ",").alias("text")


def elements(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """file, kind ('[' or '{'), idx (from 0) and element of every element of the files' documents.

    An element of an object is its key and value, as they stand. strict raises, naming the file, where a document is neither an
    array nor an object, or ends inside a string or a bracket; else such a file gives no rows. Empty documents give none.
    """
    pieces = _pieces(spark, path)
    places = materialize(_places(pieces))
    if strict and (odd := places.filter("NOT sound").select("file").head()):
        raise ValueError(f"{odd['file']}: expected a whole JSON array or object at the top level")
    lying = _within(pieces).join(places.filter("sound"), _BLOCK).withColumn("ending", _ends(F.col("upto"), F.col("deep0"), F.col("deep1")).cast("bigint"))
    before = F.sum("ending").over(Window.partitionBy(*_BLOCK).orderBy("pos")) - F.col("ending")
    across = ((before == 0) & ~F.col("first")) | ((before == F.col("ends")) & ~F.col("last"))  # may go on in another block
    numbered = lying.select(*_BLOCK, "pos", "piece", "kind", "most", (F.col("idx0") + before).alias("idx"), across.alias("across"))
    key = ["file", "kind", "most", "idx"]
    held = materialize(numbered.groupBy(*key, "block", "across").agg(F.collect_list(F.struct("pos", "piece")).alias("p")).select(*key, "block", "across", _joined("p", "piece")))
    cut = held.filter("across").groupBy(*key).agg(F.collect_list(F.struct("block", "text")).alias("p")).select(*key, _joined("p", "text"))
    text = held.filter("NOT across").select(*key, "text").union(cut)
    opened = F.when(F.col("idx") == 0, F.regexp_replace("text", r"^[\s﻿]*[\[{]", "")).otherwise(F.col("text"))
    closed = F.when(F.col("idx") == F.col("most"), F.regexp_replace(opened, r"[\]}]\s*$", "")).otherwise(opened)
    return text.select("file", "kind", "idx", F.trim(closed, F.lit(_SPACE)).alias("element")).filter("element <> '' OR idx > 0")
