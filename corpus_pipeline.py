"""A corpus run: each stage reads what the one before it kept."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogflow.llm import decontaminate, jaccard, language, packing, secrets
from catalogflow.llm.arrays import free_name
from catalogflow.llm.components import bitmap, in_bitmap
from catalogflow.llm.queries import byte_bpe
from catalogflow.session import materialize, read_table, remove_folder, scratch, shared_dir

ORACLE_SQL = None  # no stage can be put into SQL


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those without text or letters go. Columns of documents."""
    pred, score = free_name(docs, "_lang_pred"), free_name(docs, "_lang_score")
    found = language.identify(docs, language.train(docs), pred=pred, score=score)
    return found.filter(F.col(pred) != language.UNKNOWN).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more on five words: that with the smallest doc_id.

    A document is known by doc_id and text, so two texts under one doc_id are judged apart. Rows without doc_id stay only
    where their whole group has none (then that with the smallest hash of its text). Of rows that repeat both doc_id and
    text one stays. Documents without words are in no group and all stay.
    """
    key, near, again = (free_name(docs, name) for name in ("_key", "_near", "_again"))
    named = docs.withColumn(key, F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text")))
    groups = materialize(jaccard.similar(named.select(key, "text"), num=80, den=100, size=5, doc_id=key).filter("n_shingles > 0"))
    gone = groups.filter("component_id < doc_id").select(F.col("doc_id").alias(key), F.lit(False).alias(again))
    kept = groups.filter("component_id = doc_id").groupBy(F.col("doc_id").alias(key)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    odd = materialize(gone.distinct().union(kept.select(key, F.lit(True))))
    held = spark.sparkContext.broadcast(bitmap(odd, F.xxhash64(key), 22))
    found = F.arrow_udf(lambda keys: pa.array(in_bitmap(held.value, np.asarray(keys))), "boolean")
    marked = named.withColumn(near, found(F.xxhash64(key)))  # most documents need no join
    some = marked.filter(F.col(near)).join(odd, key, "left")
    parts = [marked.filter(~F.col(near)), some.filter(F.col(again).isNull()), some.filter(again).dropDuplicates([key])]
    return parts[0].select(*docs.columns).union(parts[1].select(*docs.columns)).union(parts[2].select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    leaks = free_name(docs, "_leaks")
    found = decontaminate.find(docs, read_table(spark, sf_dir, "benchmark"), out=leaks)
    return found.filter(F.size(leaks) == 0).select(*docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret and n_chars, if there is such a column, as it is then."""
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean.select(*docs.columns)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs, byte_bpe())


STAGES = [
    ("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secret_scans", secret_scans), ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again.

    What a stage wrote on its way, and its input, go when its result stands; the last result stays for the caller.
    """
    docs = read_table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        if before is not None:
            remove_folder(spark, before)
        before = f"{base}/{name}"
    return docs
