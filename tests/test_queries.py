"""Every registered query against its SQL on the smallest tables."""

import pytest

from check import compare

FOLDER = "/root/testdata/sf0.001"


def _names():
    from catalogflow.plans import load
    from catalogflow.plans.registry import QUERIES

    load()
    return list(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_query_equals_sql(spark, name):
    from catalogflow.plans.registry import ORACLES, QUERIES

    result = compare(spark, FOLDER, name, QUERIES[name], ORACLES.get(name))
    assert not result.startswith("FAIL"), result


def test_entry_has_rows(spark):
    from __spark_entry__ import entry

    assert entry(spark).head() is not None


def test_negative_zero_is_a_price_without_sign(spark, tmp_path):
    import os

    from pyspark.sql import functions as F

    from catalogflow.plans.registry import ORACLES, QUERIES

    for name in os.listdir(FOLDER):
        if name != "customer.parquet":
            os.symlink(f"{FOLDER}/{name}", tmp_path / name)
    balance = F.when(F.col("c_custkey") % 7 == 5, F.lit(-0.0)).otherwise(F.col("c_acctbal"))
    spark.read.parquet(f"{FOLDER}/customer.parquet").withColumn("c_acctbal", balance).coalesce(1).write.parquet(str(tmp_path / "made"))
    made = next(p for p in (tmp_path / "made").iterdir() if p.suffix == ".parquet")
    os.symlink(made, tmp_path / "customer.parquet")
    name = "I1_build_shopify_products"
    result = compare(spark, str(tmp_path), name, QUERIES[name], ORACLES[name])
    assert not result.startswith("FAIL"), result
