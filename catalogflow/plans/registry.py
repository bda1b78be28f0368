"""Named queries over the driver tables, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import materialize, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver tables of one folder, read on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.folder, name)

    def lines(self) -> DataFrame:
        """Every line of every order, numbered through within its order (lineitem may repeat a line number)."""
        order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity")
        return self.lineitem.select(
            "l_orderkey",
            F.row_number().over(order).cast(self.lineitem.schema["l_linenumber"].dataType).alias("l_linenumber"),
            F.col("l_partkey").alias("p"),
            F.col("l_suppkey").alias("s"),
            F.col("l_returnflag").alias("rf"),
            F.col("l_linestatus").alias("ls"),
            F.col("l_quantity").alias("q"),
        )

    @cached_property
    def kept_lines(self) -> DataFrame:
        """lines() in the shared folder, for queries that read them several times: numbered once."""
        return materialize(self.lines())


LINES = """lines AS (SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
 l_returnflag, l_linestatus, l_quantity) AS INTEGER) AS l_linenumber, l_partkey AS p, l_suppkey AS s, l_returnflag AS rf, l_linestatus AS ls,
 l_quantity AS q FROM lineitem)"""


def query(name: str, sql: str | None = None):
    """Register fn(tables) under a name, with its SQL when there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def text(name: str) -> Column:
    return F.col(name).cast("string")


def big(c: Column) -> Column:
    return c.cast("bigint")
