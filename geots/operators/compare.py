"""Comparison of two sources or runs, on long tables joined by key.

``local`` and ``remote`` are (plot_id, point_id, day, v); missing values are null or absent rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .order import numbered

KEYS = ["plot_id", "point_id", "day"]


def aligned(local: DataFrame, remote: DataFrame, how: str = "full_outer") -> DataFrame:
    """Both sides' values by point and day, as ``local`` and ``remote``."""
    return local.select(*KEYS, F.col("v").alias("local")).join(remote.select(*KEYS, F.col("v").alias("remote")), KEYS, how)


def status(local: Column, remote: Column) -> Column:
    """Which side has a value: both, local_only, gee_only or none."""
    return (
        F.when(local.isNotNull() & remote.isNotNull(), "both")
        .when(local.isNotNull(), "local_only")
        .when(remote.isNotNull(), "gee_only")
        .otherwise("none")
    )


def large_differences(local: DataFrame, remote: DataFrame, threshold: float = 0.15) -> DataFrame:
    """Points and days whose values differ by ``threshold`` or more."""
    both = aligned(local, remote, "inner").withColumn("abs_diff", F.abs(F.col("local") - F.col("remote")))
    return both.filter(F.col("abs_diff") >= threshold)


def located(differences: DataFrame, points: DataFrame) -> DataFrame:
    """Differences with their points' ``lat`` and ``lon``, six decimals."""
    at = points.select("plot_id", "point_id", F.bround("lat", 6).alias("lat"), F.bround("lon", 6).alias("lon"))
    return differences.join(at, ["plot_id", "point_id"], "left")


def difference_summary(differences: DataFrame) -> DataFrame:
    """A plot's number of large differences, their mean and largest."""
    return differences.groupBy("plot_id").agg(F.count("abs_diff").alias("n_pairs"), F.avg("abs_diff").alias("mean_diff"), F.max("abs_diff").alias("max_diff"))


def plot_days(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Each side's number of values and their mean a plot and day."""
    both = local.select("plot_id", "day", F.col("v").alias("l"), F.lit(None).cast("double").alias("r")).unionByName(
        remote.select("plot_id", "day", F.lit(None).cast("double").alias("l"), F.col("v").alias("r"))
    )
    return both.groupBy("plot_id", "day").agg(
        F.count("l").alias("local_valid_pts"), F.count("r").alias("gee_valid_pts"), F.avg("l").alias("local_mean"), F.avg("r").alias("gee_mean")
    )


def unmatched_days(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Days on which a plot has values on one side alone, with their status."""
    has_l, has_r = F.col("local_valid_pts") > 0, F.col("gee_valid_pts") > 0
    days = plot_days(local, remote).filter(has_l != has_r)
    return days.withColumn("status", F.when(has_l, "local_only").otherwise("gee_only"))


def unmatched_table(unmatched: DataFrame) -> DataFrame:
    """A plot's number of unmatched days of either status, 0 where none."""
    return unmatched.groupBy("plot_id").pivot("status", ["gee_only", "local_only"]).count().na.fill(0)


def matched_days(local: DataFrame, remote: DataFrame) -> DataFrame:
    """The days on which every plot has values on both sides or on neither."""
    days = plot_days(local, remote).withColumn("same", (F.col("local_valid_pts") > 0) == (F.col("gee_valid_pts") > 0))
    return days.groupBy("day").agg(F.bool_and("same").alias("same")).filter("same").select("day")


def removed_days(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Days that ``matched_days`` leaves out, once each."""
    every = local.select("day").union(remote.select("day")).distinct()
    return every.join(matched_days(local, remote), "day", "left_anti")


def matched_only(local: DataFrame, remote: DataFrame) -> tuple[DataFrame, DataFrame]:
    keep = matched_days(local, remote)
    return local.join(keep, "day", "left_semi"), remote.join(keep, "day", "left_semi")


def still_unmatched(local: DataFrame, remote: DataFrame) -> bool:
    """Whether any plot and day has values on one side alone."""
    return not unmatched_days(local, remote).isEmpty()


def month_pairs(old: DataFrame, new: DataFrame, how: str = "full_outer") -> DataFrame:
    """(plot_id, month, v1, v2) of two (plot_id, month, v) tables, with rounded differences."""
    both = old.select("plot_id", "month", F.col("v").alias("v1")).join(new.select("plot_id", "month", F.col("v").alias("v2")), ["plot_id", "month"], how)
    return both.withColumn("diff", F.col("v2") - F.col("v1")).withColumn("abs_diff", F.abs("diff"))


def shared_months(old: DataFrame, new: DataFrame) -> DataFrame:
    """Months in which some plot has a value on either side."""
    return old.filter("v is not null").select("month").intersect(new.filter("v is not null").select("month"))


def all_months(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.select("month").union(new.select("month")).distinct()


def error_of(pairs: DataFrame, by: list[str] = ()) -> DataFrame:
    """Number, mean absolute difference, bias and largest difference, overall or by columns."""
    both = pairs.na.drop(subset=["v1", "v2"])
    return both.groupBy(*by).agg(F.count("diff").alias("n"), F.avg("abs_diff").alias("mae"), F.avg("diff").alias("bias"), F.max("abs_diff").alias("max_abs"))


def plot_error(pairs: DataFrame) -> DataFrame:
    return pairs.na.drop(subset=["v1", "v2"]).groupBy("plot_id").agg(F.count("month").alias("n_months"), F.avg("abs_diff").alias("mean_abs"), F.max("abs_diff").alias("max_abs"))


def valid_scenes(observations: DataFrame) -> DataFrame:
    """Days with at least one value, a plot and month."""
    return observations.filter("v is not null").groupBy("plot_id", text.month_of(F.col("day")).alias("month")).agg(F.countDistinct("day").alias("n_scenes"))


def scene_means(observations: DataFrame, decimals: int = 4) -> DataFrame:
    """The means of a plot's scenes in a month, in order of their days.

    A plot has at most a few scenes a day, so a list holds some dozens.
    """
    scene = observations.groupBy("plot_id", "day").agg(F.avg("v").alias("m")).filter("m is not null")
    listed = F.array_sort(F.collect_list(F.struct("day", F.bround("m", decimals).alias("m"))))
    return scene.groupBy("plot_id", text.month_of(F.col("day")).alias("month")).agg(F.transform(listed, lambda s: s["m"]).alias("scene_means"))


def largest(rows: DataFrame, column: str, n: int, ties: list[str]) -> DataFrame:
    """The ``n`` rows with the largest ``column``, ties by the other columns."""
    return rows.orderBy(F.desc(column), *ties).limit(n)


def every_nth(plots: DataFrame, n: int, key: str = "plot_id") -> DataFrame:
    """At most ``n`` plots at an even stride through their sorted ids."""
    ids = numbered(plots.select(key).distinct(), [key], "nth")
    total = ids.agg(F.max("nth").alias("m")).first()["m"]
    if total is None:
        return ids.select(key)
    step = max(1, (total + 1) // n)
    return ids.filter((F.col("nth") % step == 0) & (F.col("nth") < step * n)).select(key)


def plot_ready(series: DataFrame, value: str, by: list[str], least: int = 2) -> DataFrame:
    """Valid points of series that have at least ``least`` of them."""
    valid = series.filter(F.col(value).isNotNull())
    enough = valid.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select(*by)
    return valid.join(enough, by, "left_semi")
