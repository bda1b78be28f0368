"""Joins that stay even when one key holds a large share of the rows.

Spark splits skewed join partitions at run time, but not where an aggregation on the same key follows and reuses the
join's partitioning. `skew_join` is for those places: it finds the hot keys with a partial aggregation and spreads
just these over several partitions; all other keys join as usual.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize, reusable

ROWS_PER_PART = 1_000_000
MAX_HOT_KEYS = 4096
_NULL_PARTS = 256
_SALT = "__salt"
_PARTS = "__parts"


def _hashable(df: DataFrame, name: str) -> Column:
    """The column, or its text where its type holds a map, which has no hash."""
    c = F.col(name)
    return F.to_json(F.struct(c)) if "map<" in df.schema[name].dataType.simpleString() else c


def spread(df: DataFrame, *by: str) -> DataFrame:
    """The rows dealt by key over the session's number of shuffle partitions, which stay as many however short the rows are.

    For costly work on short rows: file splits and coalesced partitions go by size, so a few tasks would do it all.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def skew_join(
    big: DataFrame, small: DataFrame, key: list[str], how: str = "inner", rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """big joined with small on key, every hot key of big cut into parts of about `rows_per_part` rows.

    how: inner or left. The rows of `small` with a hot key are repeated once per part. A key is hot above
    max(rows_per_part, rows / 4096) rows, so there are at most 4096 of them and their table may be broadcast.
    """
    big = reusable(big)
    rows = big.count()
    limit = max(rows_per_part, -(-rows // MAX_HOT_KEYS))
    if rows <= limit:
        return big.join(small, key, how)
    counted = big.groupBy(*key).agg(F.count(F.lit(1)).alias(_PARTS)).filter(F.col(_PARTS) > limit)
    found = materialize(counted.withColumn(_PARTS, F.ceil(F.col(_PARTS) / limit)))
    if found.isEmpty():  # a plain join leaves the rows by key, as an aggregation on the key wants them
        return big.join(small, key, how)
    hot = F.broadcast(found)
    spread = F.xxhash64(*[_hashable(big, c) for c in big.columns if c not in key] or [F.lit(0)])
    # rows without key match nothing and may go anywhere
    without_key = F.greatest(*[F.col(k).isNull() for k in key]) if len(key) > 1 else F.col(key[0]).isNull()
    parts = F.when(without_key, F.lit(_NULL_PARTS)).otherwise(F.coalesce(_PARTS, F.lit(1)))
    salted = big.join(hot, key, "left").withColumn(_SALT, F.when(parts > 1, F.pmod(spread, parts)).otherwise(F.lit(0).cast("bigint"))).drop(_PARTS)
    repeated = small.join(hot, key, "left").withColumn(
        _SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(_PARTS, F.lit(1)) - 1))
    ).drop(_PARTS)
    return salted.join(repeated, [*key, _SALT], how).drop(_SALT)
