"""Numbering rows of whole tables without a task that holds them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import shared_dir


def materialised(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, lineage cut.

    The folder is the session's ``spark.checkpoint.dir``; one is made only where there is none on
    one machine, and a cluster without it is an error.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their range partition; written once, as the ranges are found by sampling."""
    return materialised(df.repartitionByRange(*order).withColumn("__bucket", F.spark_partition_id()))


def _before(sizes: DataFrame) -> DataFrame:
    """Sums over the buckets before each; one row a bucket, a bounded number."""
    total = F.coalesce(F.sum("__n").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return F.broadcast(sizes.select("__bucket", total.alias("__before")))


def numbered(df: DataFrame, order: list[str], into: str) -> DataFrame:
    """``df`` with ``into``: 0, 1, ... in the order of columns that together are unique.

    Each range partition is numbered by itself, and the partitions' sizes are summed up.
    """
    ranged = _ranged(df, order)
    within = ranged.withColumn("__nth", F.row_number().over(Window.partitionBy("__bucket").orderBy(*order)) - 1)
    before = _before(ranged.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n")))
    return within.join(before, "__bucket").withColumn(into, (F.col("__before") + F.col("__nth")).cast("long")).drop("__bucket", "__nth", "__before")


def running_total(counts: DataFrame, order: str, value: str, into: str) -> DataFrame:
    """``counts`` with ``into``: the sum of ``value`` over rows up to and including each, by ``order``."""
    ranged = _ranged(counts, [order])
    inside = F.sum(value).over(Window.partitionBy("__bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    before = _before(ranged.groupBy("__bucket").agg(F.sum(value).alias("__n")))
    return ranged.withColumn("__in", inside).join(before, "__bucket").withColumn(into, (F.col("__before") + F.col("__in")).cast("long")).drop("__bucket", "__in", "__before")
