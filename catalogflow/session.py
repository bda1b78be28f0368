"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_written: list[str] = []


def build_session(app: str = "catalogflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE with skew handling)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a local one where it is unset and all runs on one machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def new_shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Cuts lineage, so a lost executor does not recompute the upstream, and later passes read only the columns they
    need (a plain count reads none).
    """
    path = new_shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    _written.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


_COSTLY = ("Join", "Aggregate", "Window", "Generate", "MapInPandas", "Union")


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*frames: DataFrame) -> None:
    """Delete tables as `materialize` returned them, once nothing reads them any more; other frames are left alone.

    The shuffle files of finished steps go when the driver's JVM collects its garbage, so it is asked to.
    """
    spark = None
    for df in frames:
        path = getattr(df, "_written_to", None)
        if path in _written:
            spark = df.sparkSession
            _written.remove(path)
            _delete(spark, path)
    if spark is not None:
        spark._jvm.System.gc()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that `materialize` writes inside the block go at its end; what was computed from them must be written by then."""
    before = len(_written)
    try:
        yield
    finally:
        while len(_written) > before:
            _delete(spark, _written.pop())


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Python functions of jobs inside the block get Arrow batches of about so many bytes, so long texts take no more memory."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark reads."""
    _delete(spark, path)


def release(spark: SparkSession) -> None:
    """Delete the tables this process materialized; call it when their results have been written."""
    while _written:
        _delete(spark, _written.pop())


def reusable(df: DataFrame) -> DataFrame:
    """The frame itself when it is a scan with filters and columns, else its materialized form."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return materialize(df) if any(node in plan for node in _COSTLY) else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
