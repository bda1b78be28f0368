"""The same operators on arriving files. Every stream is resumable from its checkpoint and safe to replay."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.codes import upc_digits
from ..operators.aggregate import last_wins
from ..operators.lookup import enrich_from_catalog
from ..operators.order import Running, running_values
from ..session import materialize
from .keyed import BUCKET, KeyedState, KeyFilters, bucket_of, make_folder, touched


def file_stream(spark: SparkSession, path: str, schema, name: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files as a stream; `name` limits it to files of that name."""
    reader = spark.readStream.schema(schema)
    if name:
        reader = reader.option("pathGlobFilter", name)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def enrich_stream(
    inputs: DataFrame, catalog: DataFrame, upc_columns: list[str], catalog_order: list[str], homepage: str = ""
) -> DataFrame:
    """Catalog enrichment of a stream: a stream-static left join, no state to keep.

    The catalog is deduped once and stored, not again in every micro-batch.
    """
    coded = catalog.withColumn("upc", upc_digits(F.col("upc"))).filter("upc != ''")
    unique = materialize(last_wins(coded, ["upc"], catalog_order))
    return enrich_from_catalog(inputs, unique, upc_columns, None, homepage)


def drain(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Write what has arrived and stop; a rerun with the same checkpoint continues."""
    query = (
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _batch_path(target: str, batch_id: int) -> str:
    return f"{target.rstrip('/')}/batch={batch_id}"


def start_batches(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(handle).start()
    )


def upsert_stream(
    stream: DataFrame, target: str, checkpoint: str, key: list[str], order: list[str], mode: str = "skip", buckets: int = 64
) -> list[dict[str, int]]:
    """Rows of new keys (mode 'skip') or the newest row of every key (mode 'overwrite').

    Each micro-batch writes only its own folder, named by the batch id, so a replayed batch replaces itself and a
    batch costs its own size. `read_upserted` gives the current table. In mode 'skip' a batch must know the keys before it:
    files are cut by key buckets and have Bloom filters, and the anti join reads those files only that may hold one of the
    batch's keys. Returned, per batch of this mode: batch, files (before it) and read (of these).
    """
    make_folder(stream.sparkSession, target)
    filters = KeyFilters(stream.sparkSession, f"{target.rstrip('/')}-filters", key, buckets)
    report: list[dict[str, int]] = []

    def newest(batch: DataFrame, batch_id: int) -> None:
        last_wins(batch, key, order).write.mode("overwrite").parquet(_batch_path(target, batch_id))

    def unseen(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = materialize(last_wins(batch, key, order))
        maybe = sorted(filters.may_hold(rows.select(*key), batch_id))
        report.append({"batch": batch_id, "files": len(filters.files(batch_id)), "read": len(maybe)})
        new = rows
        if maybe:
            kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in key)
            done = spark.read.schema(kinds).parquet(*[f"{_batch_path(target, a)}/{BUCKET}={b}" for a, b in maybe])
            new = materialize(rows.join(done, key, "left_anti"))
        placed = new.withColumn(BUCKET, bucket_of(key, buckets)).repartition(BUCKET)
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(_batch_path(target, batch_id))
        filters.write(new.select(*key), batch_id)

    start_batches(stream, checkpoint, unseen if mode == "skip" else newest).awaitTermination()
    return report


def read_upserted(spark: SparkSession, target: str, key: list[str]) -> DataFrame:
    """Newest row per key over all committed batches."""
    return last_wins(spark.read.parquet(target), key, ["batch"]).drop("batch", BUCKET)


def breaker_stream(
    stream: DataFrame, target: str, state: str, checkpoint: str, source: str, order: list[str], failed: Column, n: int, buckets: int = 64
) -> None:
    """Search breaker on a stream: rows with `disabled`, state (failures in a row, tripped) kept per source.

    A micro-batch is scanned with the same running values over range partitions as the batch form, so one busy source does
    not end up in one task. The state is kept in key buckets; a batch reads and rewrites those of its own sources only.
    """
    spark = stream.sparkSession
    kind = stream.schema[source].dataType.simpleString()
    store = KeyedState(spark, state, f"`{source}` {kind}, carried bigint, tripped boolean", [source], buckets)

    def handle(batch: DataFrame, batch_id: int) -> None:
        store.compact(batch_id)
        before = store.read(batch_id, touched(batch.select(bucket_of([source], buckets).alias(BUCKET))))
        marked = batch.withColumn("__failed", failed).join(before, source, "left").withColumns(
            {"carried": F.coalesce("carried", F.lit(0)), "tripped": F.coalesce("tripped", F.lit(False))}
        )
        one = F.lit(1).cast("bigint")
        ran = running_values(marked, [source], order, [Running("__pos", one)])
        ran = running_values(ran, [source], order, [Running("__ok", F.when(~F.col("__failed"), F.col("__pos")), "max")])
        in_a_row = F.when(F.col("__ok").isNull(), F.col("__pos") + F.col("carried")).otherwise(F.col("__pos") - F.col("__ok"))
        ran = ran.withColumn("failures", in_a_row)
        trips = ran.filter(F.col("failures") >= n).groupBy(source).agg(F.min("__pos").alias("__trip"))
        out = ran.join(trips, source, "left").withColumn(
            "disabled", F.col("tripped") | F.coalesce(F.col("__pos") > F.col("__trip"), F.lit(False))
        )
        out.select(*batch.columns, "failures", "disabled").write.mode("overwrite").parquet(_batch_path(target, batch_id))
        after = out.groupBy(source).agg(
            F.max_by("failures", "__pos").alias("carried"),
            (F.bool_or("tripped") | F.bool_or(F.col("failures") >= n)).alias("tripped"),
        )
        kept = before.join(after.select(source), source, "left_anti")
        store.write(after.unionByName(kept), batch_id)

    start_batches(stream, checkpoint, handle).awaitTermination()
