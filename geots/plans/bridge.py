"""Plots, tiles, observations and rasters derived from the driver's tables.

The values are arithmetic, not imagery: they exercise every operator on whole tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, raster

AFTER = dt.date(1998, 1, 25)
SENTINELS = (0, 65535)
BANDS = ("mask", "nir", "red")
#: A raster of the bridge: its origin, pixel size and number of pixels.
GX, GW, GY, GH, NX, NY = 500000.0, 60.0, 1405400.0, -90.0, 64, 64


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def boxes(spark: SparkSession, d: str) -> DataFrame:
    """(plot_id, x0, y0, w, h): a rectangle a supplier, in metres.

    They are dealt to tasks: many come in one small file, and what is done to each costs more than its bytes tell.
    """
    k, n = F.col("s_suppkey"), F.col("s_suppkey") % 100
    dealt = table(spark, d, "supplier").select("s_suppkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return dealt.select(
        k.alias("plot_id"),
        (500000 + 37 * n).cast("double").alias("x0"),
        (1400000 + 53 * n).cast("double").alias("y0"),
        (25 + (k % 7) * 10).cast("double").alias("w"),
        (35 + (k % 5) * 10).cast("double").alias("h"),
    )


def plots(spark: SparkSession, d: str) -> DataFrame:
    """(plot_id, parts): every third plot has a hole, every fourth a second part."""
    x, y, w, h = (F.col(c) for c in ("x0", "y0", "w", "h"))
    outer = geometry.rectangle(x, y, x + w, y + h)
    hole = geometry.rectangle(x + 10, y + 10, x + 20, y + 20)
    one = F.when(F.col("plot_id") % 3 == 0, F.array(outer, hole)).otherwise(F.array(outer))
    second = F.array(geometry.rectangle(x + 200, y, x + 200 + w, y + h))
    return boxes(spark, d).select("plot_id", F.when(F.col("plot_id") % 4 == 0, F.array(one, second)).otherwise(F.array(one)).alias("parts"))


def tiles(spark: SparkSession, d: str) -> DataFrame:
    """(tile_no, parts): strips 900 m wide that overlap by 100 m."""
    k = F.col("r_regionkey")
    x0 = (500000 + 800 * k).cast("double")
    return table(spark, d, "region").select(k.alias("tile_no"), F.array(F.array(geometry.rectangle(x0, F.lit(1400000.0), x0 + 900, F.lit(1406000.0)))).alias("parts"))


def raw(spark: SparkSession, d: str) -> DataFrame:
    """(tile_no, plot_id, point_id, day, mask, nir, red): one row a tile, point and day."""
    p, o, n = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_linenumber")
    return (
        table(spark, d, "lineitem")
        .groupBy((n % 5).alias("tile_no"), F.col("l_suppkey").alias("plot_id"), (p % 16).alias("point_id"), F.col("l_shipdate").cast("date").alias("day"))
        .agg(
            F.max((p * 7 + o) % 6).alias("mask"),
            F.max((p * 31 + o * 17 + n * 13) % 4000).alias("nir"),
            F.max((p * 11 + o * 29 + n * 7) % 3000).alias("red"),
        )
    )


def index(clear: DataFrame) -> DataFrame:
    value = raster.ndvi(F.col("nir"), F.col("red"), F.col("day"), AFTER, 1000, SENTINELS)
    valid = clear.filter(raster.valid_pair(F.col("nir"), F.col("red"), SENTINELS))
    return valid.select("tile_no", "plot_id", "point_id", "day", value.alias("v"))


def observations(spark: SparkSession, d: str) -> DataFrame:
    """(tile_no, plot_id, point_id, day, v): clear and valid ones; v is null at a zero sum."""
    return index(raw(spark, d).filter(raster.is_clear(F.col("mask"), (0,))))


def remote(spark: SparkSession, d: str) -> DataFrame:
    """A second source: shifted, and with points removed."""
    k = F.col("plot_id") + F.col("point_id")
    return observations(spark, d).filter(k % 11 != 0).withColumn("v", F.col("v") + (k % 5) * 0.05)


def sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Both sources with one value a point and day: of the first tile that has one."""
    pick = F.min_by("v", "tile_no").alias("v")
    return tuple(s.filter("v is not null").groupBy("plot_id", "point_id", "day").agg(pick) for s in (observations(spark, d), remote(spark, d)))


def plot_months(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Monthly means of plots by both sources: (plot_id, month, v)."""
    month = F.date_format("day", "yyyy-MM").alias("month")
    return tuple(s.groupBy("plot_id", month).agg(F.avg("v").alias("v")) for s in sides(spark, d))


def scenes(spark: SparkSession, d: str) -> DataFrame:
    """(tile, scene_id, day): four scenes a tile."""
    each = table(spark, d, "region").select(F.col("r_regionkey").alias("tile"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    return each.select("tile", (F.col("tile") * 4 + F.col("k")).cast("long").alias("scene_id"), F.date_add(F.lit(dt.date(1997, 11, 20)), (F.col("k") * 31 + F.col("tile")).cast("int")).alias("day"))


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """(tile, scene_id, band, px, py, dn) of all scenes and bands."""
    cells = scenes(spark, d).select("tile", "scene_id", F.posexplode(F.array(*map(F.lit, BANDS))).alias("b", "band"))
    cells = cells.withColumn("px", F.explode(F.sequence(F.lit(0), F.lit(NX - 1)))).withColumn("py", F.explode(F.sequence(F.lit(0), F.lit(NY - 1))))
    mixed = F.col("px") * 31 + F.col("py") * 17 + F.col("scene_id") * 13 + F.col("b") * 7
    return cells.select("tile", "scene_id", "band", "px", "py", F.when(F.col("b") == 0, mixed % 3).otherwise((mixed * 37) % 4000).cast("int").alias("dn"))


def meta(spark: SparkSession, d: str) -> DataFrame:
    each = table(spark, d, "region").select(F.col("r_regionkey").alias("tile"), F.explode(F.array(*map(F.lit, BANDS))).alias("band"))
    return each.select("tile", "band", *(F.lit(v).alias(n) for n, v in (("gx", GX), ("gw", GW), ("gy", GY), ("gh", GH), ("nx", NX), ("ny", NY))), F.lit(3999).alias("nodata"))


def archive_paths(spark: SparkSession, d: str) -> DataFrame:
    """(path, folder): file names of two archives, some scenes without a mask or with two bands."""
    k = F.col("o_orderkey")
    day = F.date_format(F.date_add(F.lit(dt.date(2024, 1, 1)), (k % 730).cast("int")), "yyyyMMdd")
    tile = F.concat(F.lit("47/P/"), F.element_at(F.array(*map(F.lit, ("QQ", "QR", "RQ", "RR"))), (k % 4 + 1).cast("int")))
    scene = F.concat(F.lit("S2"), F.when(k % 5 == 0, "A").otherwise("B"), F.lit("_MSIL2A_"), day, F.lit("T"), F.lpad((k % 240000).cast("string"), 6, "0"), F.lit("_N"), k.cast("string"))
    root = F.concat(F.when(k % 2 == 0, "/old/").otherwise("/new/"), tile, F.lit("/"), scene, F.lit("/GRANULE/L2A/IMG_DATA/"))
    mask = F.concat(root, F.lit("R20m/T47PQQ_"), day, F.lit("_OMNI_SCL_20m.tif"))
    band = F.concat(root, F.lit("R10m/T47PQQ_"), day, F.lit("T03_B08_10m.jp2"))
    other = F.concat(root, F.lit("R10m/T47PQQ_"), day, F.lit("T04_B08_10m.jp2"))
    files = F.array_compact(F.array(F.when(k % 7 != 0, mask), band, F.when(k % 11 == 0, other)))
    return table(spark, d, "orders").select(F.explode(files).alias("path"), F.when(k % 2 == 0, "OLD").otherwise("NEW").alias("folder"))
