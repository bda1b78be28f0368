"""Streams over the driver tables, drained and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import new_shared_path
from ..streaming import streams as S
from .q_joins import C1_SQL, catalog_inputs, enriched_columns, part_catalog
from .q_order import _BREAKER
from .registry import query


class _Arriving:
    """The tables with one of them replaced by its file stream."""

    def __init__(self, t, name: str):
        self._t, self._name = t, name
        self._stream = S.file_stream(t.spark, t.folder, getattr(t, name).schema, f"{name}.parquet")

    def __getattr__(self, name: str):
        return self._stream if name == self._name else getattr(self._t, name)


@query("K1_enrich_stream", C1_SQL)
def k1(t):
    target, checkpoint = new_shared_path(t.spark, "k1"), new_shared_path(t.spark, "k1c")
    stream = S.enrich_stream(catalog_inputs(_Arriving(t, "lineitem")), part_catalog(t), ["upc", "upc_updated"], ["p_partkey"], "https://shop.example")
    S.drain(enriched_columns(stream), target, checkpoint)
    return t.spark.read.parquet(target)


@query(
    "K2_upsert_stream",
    "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1",
)
def k2(t):
    target, checkpoint = new_shared_path(t.spark, "k2"), new_shared_path(t.spark, "k2c")
    stream = _Arriving(t, "events").events.select("user_id", "event_id", "event_type")
    S.upsert_stream(stream, target, checkpoint, ["user_id"], ["event_id"], mode="overwrite")
    # a second drain with the same checkpoint finds nothing new
    S.upsert_stream(stream, target, checkpoint, ["user_id"], ["event_id"], mode="overwrite")
    return S.read_upserted(t.spark, target, ["user_id"])


def arriving_twice(t, rows, first, drain):
    """Files of `rows` in a folder of their own, drained before and after the second one arrives."""
    folder = new_shared_path(t.spark, "arrivals")
    for part in (first, ~first):
        rows.filter(part).coalesce(1).write.mode("append").parquet(folder)
        drain(S.file_stream(t.spark, folder, rows.schema))


@query(
    "K2_skip_stream",
    """WITH b AS (SELECT (min(event_id) + max(event_id)) // 2 AS cut FROM events),
    e AS (SELECT user_id, event_id, event_type, event_id <= cut AS early FROM events, b),
    f AS (SELECT user_id, bool_or(early) AS early FROM e GROUP BY 1)
    SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM e JOIN f USING (user_id, early) GROUP BY 1""",
)
def k2_skip(t):
    """A key that an earlier file brought stays as it is; the second file adds new keys only."""
    target, checkpoint = new_shared_path(t.spark, "k2"), new_shared_path(t.spark, "k2c")
    rows = t.events.select("user_id", "event_id", "event_type")
    cut = rows.agg(F.floor((F.min("event_id") + F.max("event_id")) / 2)).scalar()
    arriving_twice(t, rows, F.col("event_id") <= cut, lambda stream: S.upsert_stream(stream, target, checkpoint, ["user_id"], ["event_id"], buckets=16))
    return S.read_upserted(t.spark, target, ["user_id"])


@query("K3_breaker_stream", _BREAKER)
def k3(t):
    target, state, checkpoint = (new_shared_path(t.spark, p) for p in ("k3", "k3s", "k3c"))
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    middle = rows.agg(F.min("ts") + (F.max("ts") - F.min("ts")) / 2).scalar()

    def drain(stream):
        S.breaker_stream(stream, target, state, checkpoint, "user_id", ["ts", "event_id"], F.col("event_type") == "error", 2, buckets=16)

    arriving_twice(t, rows, F.col("ts") <= middle, drain)
    return t.spark.read.parquet(target).select("event_id", "user_id", "failures", "disabled")
