"""The whole run: polygons, grid and scenes to four monthly tables."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..config import Config
from ..functions import crs, text, wkb
from ..operators import grid, monthly, order, sampling, spatial
from ..sources import geotiff, sinks, tables

TILES = 8  # of a job; a run that is ended does no more than these again
Blocks = Callable[[DataFrame], DataFrame]


def tile_points(points: DataFrame, plots: DataFrame, tiles: DataFrame, cell: float = 0.25) -> DataFrame:
    """Points of each tile (x, y in the tile's own zone). ``tiles``: tile, parts in degrees, epsg."""
    pairs = spatial.intersecting(plots, tiles, "plot_id", "tile", cell)
    dealt = spatial.tile_points(points, pairs).join(tiles.select("tile", "epsg"), "tile")
    x, y = crs.to_utm(F.col("lon"), F.col("lat"), F.col("epsg"))
    return dealt.select("tile", "plot_id", "point_id", x.alias("x"), y.alias("y"), "lat", "lon")


def monthly_statistics(points: DataFrame, scenes: DataFrame, blocks: DataFrame, meta: DataFrame, config: Config = Config()) -> DataFrame:
    """(plot_id, point_id, month, mean, max, min, median): all points and all months with scenes.

    Statistics are taken a tile first; where tiles overlap the first tile with a value counts.
    """
    seen = sampling.observations(points, scenes, blocks, meta, config)
    by_tile = monthly.statistics(seen)
    return monthly.dense(monthly.across_tiles(by_tile), points, monthly.months(scenes), monthly.POINT)


def grid_path(spark: SparkSession, config: Config) -> str:
    """The grid table of a run: the one that is set, else that of the polygons in the grid folder or beside them."""
    if config.grid_file:
        return config.grid_file
    folders = [f for f in (config.grid_dir, f"{config.polygons.rstrip('/').rpartition('/')[0]}/grid_points") if f]
    for folder in folders:
        found = text.grid_for(config.polygons, tables.parquet_files(spark, folder))
        if found:
            return found
    raise ValueError(f"no grid for {config.polygons} in {' or '.join(folders)}")


def from_rasters(rasters: DataFrame, config: Config) -> tuple[Blocks, DataFrame, DataFrame]:
    """Blocks (of given points), their places, and the rasters that cannot be read, of GeoTIFF files (tile, scene_id, band, path).

    A file that cannot be read leaves its scene without those values; it does not end the run.
    """
    found = order.materialised(geotiff.index(rasters, config.block, broken="skip"))
    about = geotiff.meta(found)
    bands = ["mask", "nir", "red"]

    def blocks(points: DataFrame) -> DataFrame:
        return geotiff.blocks(geotiff.needed(found, points, about, config, bands), config.block, broken="skip", bands=bands)

    return blocks, about, found.filter("problem is not null").select("tile", "scene_id", "band", "path", "problem")


def signatures(scenes: DataFrame, config: Config) -> dict:
    """For each tile what its statistics come from: its scenes and the settings. A row a tile."""
    scene = F.xxhash64("scene_id", "day", F.lit(repr(config)))
    rows = scenes.groupBy("tile").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(scene).alias("x"))
    return {r["tile"]: f"{r['n']}:{r['x']}" for r in rows.collect()}


def run(spark: SparkSession, config: Config, tiles: DataFrame, scenes: DataFrame, blocks: DataFrame | Blocks, meta: DataFrame) -> dict[str, int]:
    """Write point master, the four tables and a summary of the run below ``config.output_dir``; rows written by table.

    ``scenes`` is a catalog (tile, scene_id, day); ``blocks`` and ``meta`` hold its rasters
    (``blocks`` may be a function of the points, see ``from_rasters``). Statistics are made some
    tiles at a time, each group of tiles in partitions of their own, and what is done is logged
    after it. A run that was ended begins again with the tiles whose scenes or settings are not in
    the log; a run that succeeds removes log and intermediate tables.
    """
    began, timing = time.monotonic(), {}

    def lap(stage: str) -> None:
        timing[stage] = timing.get(stage, 0.0) + time.monotonic() - began - sum(timing.values())

    root = f"{config.output_dir}/{config.province}"
    stats_path, log_path, placed_path, wide_path = (f"{root}/_{n}.parquet" for n in ("stats", "done", "placed", "wide"))
    plots = tables.polygons(spark, config.polygons)
    points = tables.grid(spark, grid_path(spark, config))
    sinks.write_geoparquet(grid.point_master(points), f"{root}/point_master.parquet", ["Point"], mode="overwrite" if config.rebuild_points else "ignore")
    lap("point_master")
    days = scenes.filter(F.col("day").between(F.lit(config.date_start), F.lit(config.date_end)))
    tile_points(points, plots, tiles).write.mode("overwrite").parquet(placed_path)
    placed = spark.read.parquet(placed_path)
    lap("points")
    wanted = signatures(days, config)
    done = {r["tile"]: r["signature"] for r in spark.read.parquet(log_path).orderBy("n").collect()} if sinks.exists(spark, log_path) else {}
    todo = sorted(t for t, s in wanted.items() if done.get(t) != s)
    counted = {"clear_points": 0, "index_points": 0}
    for at in range(0, len(todo), TILES):
        group = todo[at : at + TILES]
        here = placed.filter(F.col("tile").isin(group))
        own = blocks(here) if callable(blocks) else blocks.filter(F.col("tile").isin(group))
        watch = Observation()
        seen = sampling.observations(here, days, own, meta, config).observe(watch, F.count(F.lit(1)).alias("clear_points"), F.count("ndvi").alias("index_points"))
        stats = monthly.statistics(seen)
        stats.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile").parquet(stats_path)
        schema = stats.schema
        spark.createDataFrame([(t, wanted[t], len(done) + at) for t in group], StructType([schema["tile"], StructField("signature", StringType()), StructField("n", LongType())])).coalesce(1).write.mode("append").parquet(log_path)
        counted = {k: v + watch.get[k] for k, v in counted.items()}
    lap("statistics")
    # Some hundred months in decades of scenes.
    names = sorted(r["month"] for r in monthly.months(days).collect())
    long = StructType([*(placed.schema[n] for n in ("tile", *monthly.POINT)), StructField("month", StringType()), *(StructField(s, DoubleType()) for s in monthly.STATS)])
    kept = spark.read.schema(long).parquet(stats_path).filter(F.col("tile").isin(list(wanted))) if wanted else spark.createDataFrame([], long)
    monthly.wide_statistics(monthly.across_tiles(kept), placed, names).write.mode("overwrite").parquet(wide_path)
    lap("wide")
    written = {}
    for name in monthly.STATS:
        table = monthly.of_statistic(spark.read.parquet(wide_path), name, names)
        out = f"{root}/ndvi_{name}.parquet"
        sinks.write_geoparquet(table.withColumn("geometry", wkb.point_wkb("lon", "lat")), out, ["Point"])
        written[name] = spark.read.parquet(out).count()
        lap(f"write_{name}")
    counts = {
        "tiles_processed": len(wanted),
        "tiles_resumed": len(wanted) - len(todo),
        "scenes_processed": days.count(),
        **counted,
        "points_written": sum(written.values()),
    }
    summary = sinks.run_summary(config.province, dt.date.today().isoformat(), time.monotonic() - began, counts, timing)
    sinks.put_text(spark, f"{root}/performance_summary.json", summary)
    for path in (stats_path, log_path, placed_path, wide_path):  # only now: a failed run keeps them
        sinks.remove(spark, path)
    return written
