"""Physical plans: what must not be in them, and what must reach the scan."""

import re

import pytest
from geots.plans import registry

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_cross_join_and_no_python_but_for_point_bytes(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)
    if name not in ("s22_point_master", "s24_province_grid"):
        assert not re.search("Python|Pandas|Arrow", text)


def test_only_needed_columns_are_read(spark):
    text = plan(registry.QUERIES["a1_monthly_mean"](spark, SF))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text)[1]
    assert {c.split(":")[0] for c in read.split(",")} == {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"}


def test_filters_reach_the_scan(spark, tmp_path):
    from geots.operators import sampling
    from pyspark.sql import functions as F

    from geots.plans import bridge

    sampling.blocked(bridge.pixels(spark, SF), 16).write.partitionBy("tile").parquet(f"{tmp_path}/blocks")
    blocks = spark.read.parquet(f"{tmp_path}/blocks")
    points = spark.createDataFrame([(1, 500100.0, 1405000.0)], "tile int, x double, y double")
    text = plan(sampling.sampled(points, blocks.filter("tile = 1"), bridge.meta(spark, SF).withColumn("tile", F.col("tile").cast("int")), "nir", "v"))
    assert re.search(r"PartitionFilters: \[[^\]]*tile", text) and re.search(r"PushedFilters: \[[^\]]*EqualTo\(band,nir\)", text)
