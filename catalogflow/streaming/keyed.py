"""Stores in key buckets for streams: current state per key, and filters that tell which files may hold a key.

Both live in folders of Parquet files named by batch id. A batch reads what batches before it left, so a replayed batch
does the same again and replaces its own folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKET = "__bucket"


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _path(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    folder, files = _path(spark, path)
    files.mkdirs(folder)


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    folder, files = _path(spark, pattern)
    return [str(f.getPath()) for f in files.globStatus(folder) or []]


def _number(path: str, name: str) -> int:
    return int(path.split(f"{name}=")[1].split("/")[0])


def touched(df: DataFrame) -> list[int]:
    """The buckets that occur in the frame: at most the number of buckets."""
    return sorted(row[0] for row in df.select(BUCKET).distinct().collect())


class KeyedState:
    """The newest row of every key, in `buckets` buckets with a version per batch that touched them.

    A batch writes the buckets it touches and no others. Once it runs, all batches before it are committed, so it also
    deletes what they replaced: each bucket keeps the version the batch reads, and the one it writes.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, key, buckets
        make_folder(spark, self.path)

    def versions(self) -> dict[int, list[int]]:
        """Complete versions per bucket, in ascending order."""
        complete = {_number(p, "version") for p in _listed(self.spark, f"{self.path}/version=*/_SUCCESS")}
        found: dict[int, list[int]] = {}
        for p in _listed(self.spark, f"{self.path}/version=*/{BUCKET}=*"):
            if _number(p, "version") in complete:
                found.setdefault(_number(p, BUCKET), []).append(_number(p, "version"))
        return {b: sorted(v) for b, v in found.items()}

    def read(self, upto: int, buckets: list[int] | None = None) -> DataFrame:
        """The state before batch `upto`, of the given buckets or of all."""
        newest = {b: max((x for x in v if x < upto), default=None) for b, v in self.versions().items() if buckets is None or b in buckets}
        paths = [f"{self.path}/version={v}/{BUCKET}={b}" for b, v in sorted(newest.items()) if v is not None]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, rows: DataFrame, batch: int) -> None:
        """The new rows of all buckets that the batch touched."""
        placed = rows.withColumn(BUCKET, bucket_of(self.key, self.buckets)).repartition(BUCKET)
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/version={batch}")

    def compact(self, batch: int) -> None:
        """Delete the versions that no batch from this one on reads."""
        for bucket, versions in self.versions().items():
            for old in [v for v in versions if v < batch][:-1]:
                folder, files = _path(self.spark, f"{self.path}/version={old}/{BUCKET}={bucket}")
                files.delete(folder, True)


class KeyFilters:
    """Bloom filters of the keys of every file of a bucketed, batch-wise table: a word of 64 bits per place that is set.

    A key sets four bits of one of `words` words, named by its hash; a file's filter is the table of its words, so it
    grows with the file's keys until all words are in use (then with about 8 keys a word one key in 40 is let through).
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = 64, words: int = 1 << 16):
        self.spark, self.path, self.key, self.buckets, self.words = spark, path.rstrip("/"), key, buckets, words
        make_folder(spark, self.path)

    def _hashed(self, keys: DataFrame) -> DataFrame:
        spread = F.xxhash64(*self.key, F.lit(1))
        bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(spread, 6 * k).bitwiseAND(63).cast("int")) for k in range(4)]
        mask = bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])
        word = F.pmod(F.shiftrightunsigned(spread, 24), F.lit(self.words))
        return keys.select(*self.key, bucket_of(self.key, self.buckets).alias(BUCKET), word.alias("word"), mask.alias("mask"))

    def write(self, keys: DataFrame, batch: int) -> None:
        words = self._hashed(keys).groupBy(BUCKET, "word").agg(F.expr("bit_or(mask)").alias("bits"))
        words.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/batch={batch}")

    def files(self, upto: int) -> set[tuple[int, int]]:
        """(batch, bucket) of every file before batch `upto`."""
        found = _listed(self.spark, f"{self.path}/batch=*/{BUCKET}=*")
        return {(_number(p, "batch"), _number(p, BUCKET)) for p in found if _number(p, "batch") < upto}

    def may_hold(self, keys: DataFrame, upto: int) -> set[tuple[int, int]]:
        """(batch, bucket) of the files before batch `upto` that may hold one of the keys. Others hold none of them."""
        hashed = self._hashed(keys)
        wanted = set(touched(hashed))
        paths = [f"{self.path}/batch={a}/{BUCKET}={b}" for a, b in sorted(self.files(upto)) if b in wanted]
        if not paths:
            return set()
        stored = self.spark.read.schema(f"word bigint, bits bigint, batch int, {BUCKET} int").option("basePath", self.path).parquet(*paths)
        met = hashed.join(stored, [BUCKET, "word"]).filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        return {(row[0], row[1]) for row in met.select("batch", BUCKET).distinct().collect()}  # a row per file at most
