"""Observations to monthly statistics per point, across tiles, and to wide tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

# The statistics that a run writes, one table each.
STATS = ("mean", "max", "min", "median")
POINT = ("plot_id", "point_id")


def statistic(name: str, value: str) -> Column:
    return {"mean": F.avg, "max": F.max, "min": F.min, "median": F.median}[name](value)


def statistics(observations: DataFrame, value: str = "ndvi", day: str = "day", keys: tuple[str, ...] = ("tile", *POINT)) -> DataFrame:
    """Mean, maximum, minimum and exact median a tile, point and month; nulls do not count."""
    return observations.groupBy(*keys, text.month_of(F.col(day)).alias("month")).agg(*(statistic(s, value).alias(s) for s in STATS), F.count(value).alias("n"))


def dense(stats: DataFrame, points: DataFrame, months: DataFrame, keys: tuple[str, ...] = ("tile", *POINT)) -> DataFrame:
    """``stats`` with a row for every point of ``points`` and every month of ``months``.

    Points that were never clear and months without a clear scene stay, with null statistics.
    ``months`` (month) has some hundred rows in decades of scenes, and is read as one list.
    """
    listed = months.agg(F.array_sort(F.collect_set("month")).alias("m")).scalar()
    frame = points.select(*keys).distinct().select(*keys, F.explode(listed).alias("month"))
    return frame.join(stats, [*keys, "month"], "left")


def months(scenes: DataFrame, day: str = "day") -> DataFrame:
    """The months of all scenes of all tiles, cloudy ones included."""
    return scenes.select(text.month_of(F.col(day)).alias("month")).filter("month is not null").distinct()


def across_tiles(stats: DataFrame, tile: str = "tile", keys: tuple[str, ...] = (*POINT, "month")) -> DataFrame:
    """One row a point and month: each statistic from the first tile, in order, that has it."""
    return stats.groupBy(*keys).agg(*(F.min_by(s, F.when(F.col(s).isNotNull(), F.col(tile))).alias(s) for s in STATS))


def wide(long: DataFrame, value: str, columns: list[str], by: str = "month", keys: list[str] | None = None, narrow: bool = False) -> DataFrame:
    """One column a month (or day): ``columns`` are given, so no job is run to find them."""
    rows = long.select(*(keys or list(POINT)), by, F.col(value).cast("float" if narrow else "double").alias(value))
    return rows.groupBy(*(keys or list(POINT))).pivot(by, columns).agg(F.first(value, ignorenulls=True))


def long(table: DataFrame, columns: list[str], by: str = "month", value: str = "ndvi") -> DataFrame:
    """A wide table's ``columns`` as rows, nulls included; other columns stay."""
    rest = [c for c in table.columns if c not in columns]
    return table.unpivot([F.col(f"`{c}`") for c in rest], [F.col(f"`{c}`") for c in columns], by, value)


def wide_statistics(long_stats: DataFrame, points: DataFrame, month_names: list[str]) -> DataFrame:
    """One wide table of all four statistics, single precision, for every point: one pivot, one join.

    Points without a value in any month stay, with nulls. Columns are named ``<month>_<statistic>``.
    """
    at = points.select(*POINT, F.col("lat").cast("float").alias("lat"), F.col("lon").cast("float").alias("lon")).dropDuplicates(list(POINT))
    rows = long_stats.select(*POINT, "month", *(F.col(s).cast("float").alias(s) for s in STATS))
    table = rows.groupBy(*POINT).pivot("month", month_names).agg(*(F.first(s, ignorenulls=True).alias(s) for s in STATS))
    return at.join(table, list(POINT), "left")


def of_statistic(table: DataFrame, name: str, month_names: list[str]) -> DataFrame:
    """The wide table of one statistic: of a written ``wide_statistics`` only its columns are read."""
    return table.select(*POINT, "lat", "lon", *(F.col(f"`{m}_{name}`").alias(m) for m in month_names))


def four_tables(long_stats: DataFrame, points: DataFrame, month_names: list[str]) -> dict[str, DataFrame]:
    """The four wide tables, single precision, with the points' coordinates."""
    table = wide_statistics(long_stats, points, month_names)
    return {s: of_statistic(table, s, month_names) for s in STATS}


def united(tables: list[DataFrame]) -> DataFrame:
    """Wide tables of differing months under each other: a month that a table lacks is null in its rows.

    Month columns come last, in order. At least one table must be given.
    """
    whole = tables[0]
    for more in tables[1:]:
        whole = whole.unionByName(more, allowMissingColumns=True)
    names = text.month_columns(whole.columns)
    return whole.select(*(c for c in whole.columns if c not in names), *(F.col(f"`{m}`") for m in names))


def plot_scene(observations: DataFrame, value: str = "ndvi", day: str = "day") -> DataFrame:
    """Mean and median of a plot's points a day."""
    return observations.groupBy("plot_id", day).agg(F.avg(value).alias("mean"), F.median(value).alias("median"), F.count(value).alias("n"))


def plot_month_pooled(observations: DataFrame, value: str = "ndvi", day: str = "day") -> DataFrame:
    """Mean over all points and days of a plot and month together."""
    return observations.groupBy("plot_id", text.month_of(F.col(day)).alias("month")).agg(F.avg(value).alias("mean"))


def plot_month_of_points(stats: DataFrame, statistic_name: str = "mean") -> DataFrame:
    """Mean over a plot's points of their monthly statistic."""
    return stats.groupBy("plot_id", "month").agg(F.avg(statistic_name).alias("mean"))


def plot_month_maximum(observations: DataFrame, value: str = "ndvi", day: str = "day") -> DataFrame:
    """Mean over a plot's points of their monthly maximum, over all tiles."""
    best = observations.groupBy(*POINT, text.month_of(F.col(day)).alias("month")).agg(F.max(value).alias("top"))
    return best.groupBy("plot_id", "month").agg(F.avg("top").alias("mean_max"))


def tile_maximum(plot_months: DataFrame, value: str) -> DataFrame:
    """The larger value of plots that lie in several tiles."""
    return plot_months.groupBy("plot_id", "month").agg(F.max(value).alias(value))


def daily_maximum(observations: DataFrame, value: str = "ndvi", day: str = "day") -> DataFrame:
    return observations.groupBy("tile", day).agg(F.max(value).alias("ndvi_max"))


def province_month_maximum(daily: DataFrame, day: str = "day") -> DataFrame:
    return daily.groupBy(text.month_start(F.col(day)).alias("year_month")).agg(F.max("ndvi_max").alias("ndvi_max"))


def plot_matrix(observations: DataFrame, value: str = "ndvi", day: str = "day") -> DataFrame:
    """(plot_id, day, points, values): a plot's points of a day as arrays, in order of their ids.

    A row holds one plot's points, some thousands; missing values are null.
    """
    cells = F.sort_array(F.collect_list(F.struct("point_id", F.col(value).alias("v"))))
    rows = observations.groupBy("plot_id", day).agg(cells.alias("cells"))
    return rows.select("plot_id", day, F.transform("cells", lambda c: c["point_id"]).alias("points"), F.transform("cells", lambda c: c["v"]).alias("values"))
