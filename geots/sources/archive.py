"""Scene archives: file listing to a catalog, two archives laid over each other."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text

OLD, NEW = "OLD", "NEW"
#: Parts of a path, from the tile's folder on.
LAYOUT = r"([0-9]{2})/([A-Z])/([A-Z]{2})/([^/]+)/GRANULE/[^/]+/IMG_DATA/R(\d+)m/([^/]+)$"


def listing(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path): all files under ``root``; only names are read, by Spark's own parallel listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return files.select("path")


def scene_files(paths: DataFrame, satellite: str, mask_suffix: str = "_OMNI_SCL_20m.tif") -> DataFrame:
    """(tile, scene, res, name, path) of files that lie in a scene's folder of the satellite.

    A scene's folder has three parts or more, joined by underscores, and the satellite's letter third.
    """
    part = [F.regexp_extract("path", LAYOUT, i) for i in range(1, 7)]
    found = paths.filter(F.col("path").rlike(LAYOUT)).select(F.concat(*part[:3]).alias("tile"), part[3].alias("scene"), part[4].cast("int").alias("res"), part[5].alias("name"), "path")
    return found.filter((F.size(F.split("scene", "_")) >= 3) & (F.substring("scene", 3, 1) == satellite))


def band_scenes(files: DataFrame, band: str, start: dt.date, end: dt.date, res: int = 10, mask_suffix: str = "_OMNI_SCL_20m.tif") -> DataFrame:
    """(tile, scene, day, mask_path, band_path): scenes with exactly one mask and one band file.

    The day is read from the band file's name; scenes whose name has no date there, and days
    outside [start, end], go.
    """
    is_mask = (F.col("res") == 20) & F.col("name").endswith(mask_suffix)
    is_band = (F.col("res") == res) & F.col("name").endswith(f"_B{band}_{res}m.jp2")
    whole = files.filter(is_mask | is_band).groupBy("tile", "scene").agg(
        F.count_if(is_mask).alias("masks"),
        F.count_if(is_band).alias("bands"),
        F.max(F.when(is_mask, F.col("path"))).alias("mask_path"),
        F.max(F.when(is_band, F.col("path"))).alias("band_path"),
    )
    dated = whole.filter("masks = 1 and bands = 1").withColumn("day", text.scene_date(F.col("band_path")))
    return dated.filter(F.col("day").between(F.lit(start), F.lit(end))).select("tile", "scene", "day", "mask_path", "band_path")


def overlay(old: DataFrame, new: DataFrame) -> DataFrame:
    """One scene a tile and day: the new archive's before the old one's, then the smallest path.

    ``folder`` tells which archive it is from.
    """
    both = old.withColumn("folder", F.lit(OLD)).unionByName(new.withColumn("folder", F.lit(NEW)))
    best = F.min_by(F.struct(*both.columns), F.struct((F.col("folder") == OLD).alias("older"), F.col("band_path")))
    return both.groupBy("tile", "day").agg(best.alias("s")).select("s.*")


def with_folder_check(scenes: DataFrame, cutoff: dt.date) -> DataFrame:
    """``folder_ok``: whether a scene's archive is the one expected for its day."""
    return scenes.withColumn("folder_ok", F.col("folder") == F.when(F.col("day") < F.lit(cutoff), OLD).otherwise(NEW))


def cutoff_only(scenes: DataFrame, cutoff: dt.date) -> DataFrame:
    """The comparison's policy: only scenes in the archive expected for their day, all of them."""
    return with_folder_check(scenes, cutoff).filter("folder_ok").drop("folder_ok")


def in_years(scenes: DataFrame, first: int, last: int) -> DataFrame:
    """Scenes whose folder's third part begins with a year of the range."""
    year = F.expr("try_cast(substring(element_at(split(scene, '_'), 3), 1, 4) AS int)")
    return scenes.filter(year.between(first, last))


def merged_bands(nir: DataFrame, red: DataFrame) -> DataFrame:
    """(tile, day, mask_path, nir_path, red_path): scenes that both bands have under one mask."""
    keys = ["tile", "day", "mask_path"]
    return nir.select(*keys, F.col("band_path").alias("nir_path")).join(red.select(*keys, F.col("band_path").alias("red_path")), keys)


def catalog(spark: SparkSession, config) -> DataFrame:
    """The catalog of a run: both archives listed, overlaid and merged by band."""
    bands = []
    for band in (config.nir_band, config.red_band):
        each = [band_scenes(scene_files(listing(spark, root), config.satellite), band, config.date_start, config.date_end) for root in (config.archive_old, config.archive_new)]
        bands.append(overlay(*each))
    return merged_bands(*bands)


def busiest_tile(scenes: DataFrame) -> DataFrame:
    """The tile with most scenes, ties to the smaller name."""
    return scenes.groupBy("tile").agg(F.count(F.lit(1)).alias("n_scenes")).orderBy(F.desc("n_scenes"), "tile").limit(1)


def pending(tiles: DataFrame, done: DataFrame) -> DataFrame:
    """Tiles that have no output yet: what a resumed run works on."""
    return tiles.join(done.select("tile").distinct(), "tile", "left_anti")


def first_of_day(scenes: DataFrame, order: list[str]) -> DataFrame:
    """The first scene a tile and day in the given order, for archives without priority."""
    nth = F.row_number().over(Window.partitionBy("tile", "day").orderBy(*order))
    return scenes.withColumn("__nth", nth).filter("__nth = 1").drop("__nth")
