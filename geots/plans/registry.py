"""One query an operator over the bridge tables, each with its SQL counterpart.

Names begin with the operator's number in the inventory. Computed doubles are rounded to six
places on both sides, by the same arithmetic, days are written as text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import crs, geometry, raster, text, wkb
from ..operators import compare, grid, monthly, order, sampling, spatial
from ..sources import archive, geotiff, sinks, tables
from ..streaming import scenes as streaming
from . import bridge, files, run

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

BLOCK = 16
CONFIG = Config(offset_after=bridge.AFTER, block=BLOCK)


def sql_rounded(sql: str) -> str:
    """``round(x, 6)`` of the SQL texts as plain arithmetic, which both engines do alike at halves."""
    at = 0
    while (at := sql.find("round(", at)) >= 0:
        depth, end = 1, at + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[at + 6 : end - 1]
        if inner.endswith(", 6"):
            sql = f"{sql[:at]}(floor(({inner[:-3]}) * CAST(1000000 AS DOUBLE) + CAST(0.5001 AS DOUBLE)) / CAST(1000000 AS DOUBLE)){sql[end:]}"
        at += 1
    return sql


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql_rounded(sql)
        return f

    return add


def r6(c: Column | str, name: str | None = None) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return rounded(column).alias(name or str(c))


def rounded(x: Column) -> Column:
    """Six places by plain arithmetic, halves up even where summing has cost a mean its last bit."""
    return F.floor(x * F.lit(1e6) + F.lit(0.5001)) / F.lit(1e6)


def day_text(c: str = "day") -> Column:
    return F.col(c).cast("string").alias(c)


# The bridge in SQL.
OBS = """
WITH obs AS (SELECT l_linenumber % 5 AS tile_no, l_suppkey AS plot_id, l_partkey % 16 AS point_id, CAST(l_shipdate AS DATE) AS day,
         max((l_partkey * 7 + l_orderkey) % 6) AS mask, max((l_partkey * 31 + l_orderkey * 17 + l_linenumber * 13) % 4000) AS nir,
         max((l_partkey * 11 + l_orderkey * 29 + l_linenumber * 7) % 3000) AS red
       FROM lineitem GROUP BY 1, 2, 3, 4),
valid AS (SELECT * FROM obs WHERE mask = 0 AND nir NOT IN (0, 65535) AND red NOT IN (0, 65535)),
shifted AS (SELECT *, CAST(CASE WHEN day > DATE '1998-01-25' THEN nir - 1000 ELSE nir END AS DOUBLE) AS n,
              CAST(CASE WHEN day > DATE '1998-01-25' THEN red - 1000 ELSE red END AS DOUBLE) AS r FROM valid),
ndvi AS (SELECT tile_no, plot_id, point_id, day, CASE WHEN n + r <> 0 THEN (n - r) / (n + r) END AS v FROM shifted),
remote AS (SELECT tile_no, plot_id, point_id, day, v + ((plot_id + point_id) % 5) * CAST(0.05 AS DOUBLE) AS v FROM ndvi WHERE (plot_id + point_id) % 11 <> 0),
loc AS (SELECT plot_id, point_id, day, arg_min(v, tile_no) AS v FROM ndvi WHERE v IS NOT NULL GROUP BY 1, 2, 3),
rem AS (SELECT plot_id, point_id, day, arg_min(v, tile_no) AS v FROM remote WHERE v IS NOT NULL GROUP BY 1, 2, 3),
pm1 AS (SELECT plot_id, strftime(day, '%Y-%m') AS month, avg(v) AS v FROM loc GROUP BY 1, 2),
pm2 AS (SELECT plot_id, strftime(day, '%Y-%m') AS month, avg(v) AS v FROM rem GROUP BY 1, 2),
stats AS (SELECT tile_no, plot_id, point_id, strftime(day, '%Y-%m') AS month, avg(v) AS mean, max(v) AS max, min(v) AS min,
            median(v) AS median, count(v) AS n FROM ndvi GROUP BY 1, 2, 3, 4),
pd AS (SELECT plot_id, day, count(l) AS lc, count(r) AS rc, avg(l) AS lm, avg(r) AS rm FROM
         (SELECT plot_id, day, v AS l, NULL::DOUBLE AS r FROM loc UNION ALL SELECT plot_id, day, NULL, v FROM rem) GROUP BY 1, 2),
pairs AS (SELECT plot_id, month, pm1.v AS v1, pm2.v AS v2, pm2.v - pm1.v AS diff, abs(pm2.v - pm1.v) AS abs_diff FROM pm1 FULL JOIN pm2 USING (plot_id, month)),
large AS (SELECT plot_id, point_id, day, loc.v AS local, rem.v AS remote, abs(loc.v - rem.v) AS abs_diff
          FROM loc JOIN rem USING (plot_id, point_id, day) WHERE abs(loc.v - rem.v) >= CAST(0.15 AS DOUBLE))
"""
BOX = """
WITH box AS (SELECT s_suppkey AS plot_id, CAST(500000 + 37 * (s_suppkey % 100) AS DOUBLE) AS x0, CAST(1400000 + 53 * (s_suppkey % 100) AS DOUBLE) AS y0,
         CAST(25 + (s_suppkey % 7) * 10 AS DOUBLE) AS w, CAST(35 + (s_suppkey % 5) * 10 AS DOUBLE) AS h FROM supplier),
part AS (SELECT plot_id, 0 AS part, x0, y0, w, h, plot_id % 3 = 0 AS hole FROM box
         UNION ALL SELECT plot_id, 1, x0 + 200, y0, w, h, FALSE FROM box WHERE plot_id % 4 = 0),
centre AS (SELECT plot_id, part, x0, y0, w, h, hole, x, unnest(generate_series(0, 20)) * 10 + floor(y0 / 10) * 10 + 5 AS y
           FROM (SELECT *, unnest(generate_series(0, 20)) * 10 + floor(x0 / 10) * 10 + 5 AS x FROM part)),
pts AS (SELECT plot_id, part, x, y, CAST(row_number() OVER (PARTITION BY plot_id ORDER BY part, y, x) - 1 AS BIGINT) AS point_id FROM centre
        WHERE x > x0 AND x < x0 + w AND y > y0 AND y < y0 + h AND NOT (hole AND x >= x0 + 10 AND x <= x0 + 20 AND y >= y0 + 10 AND y <= y0 + 20)),
tile AS (SELECT r_regionkey AS tile_no, CAST(500000 + 800 * r_regionkey AS DOUBLE) AS tx0, CAST(500900 + 800 * r_regionkey AS DOUBLE) AS tx1 FROM region),
pt AS (SELECT DISTINCT plot_id, tile_no FROM part JOIN tile ON x0 <= tx1 AND x0 + w >= tx0 AND y0 <= 1406000 AND y0 + h >= 1400000)
"""
RASTER = BOX + """,
scene AS (SELECT r_regionkey AS tile, CAST(r_regionkey * 4 + k AS BIGINT) AS scene_id, DATE '1997-11-20' + CAST(k * 31 + r_regionkey AS INTEGER) AS day
          FROM region, (SELECT unnest(generate_series(0, 3)) AS k)),
place AS (SELECT tile_no AS tile, plot_id, point_id, x, y, CAST(trunc((x - 500000) / 60) AS INTEGER) AS px, CAST(trunc((y - 1405400) / -90) AS INTEGER) AS py
          FROM pts JOIN pt USING (plot_id)),
seen AS (SELECT *, (px * 31 + py * 17 + scene_id * 13) % 3 AS mask, ((px * 31 + py * 17 + scene_id * 13 + 7) * 37) % 4000 AS nir0, ((px * 31 + py * 17 + scene_id * 13 + 14) * 37) % 4000 AS red0
         FROM place JOIN scene USING (tile) WHERE px BETWEEN 0 AND 63 AND py BETWEEN 0 AND 63),
bands AS (SELECT *, nullif(nir0, 3999) AS nir, nullif(red0, 3999) AS red FROM seen),
fixed AS (SELECT *, CAST(nir - CASE WHEN day > DATE '1998-01-25' THEN 1000 ELSE 0 END AS DOUBLE) AS n, CAST(red - CASE WHEN day > DATE '1998-01-25' THEN 1000 ELSE 0 END AS DOUBLE) AS r
          FROM bands WHERE mask = 0),
val AS (SELECT tile, plot_id, point_id, day, CASE WHEN nir NOT IN (0, 65535) AND red NOT IN (0, 65535) AND n + r <> 0 THEN (n - r) / (n + r) END AS v FROM fixed)
"""


# Band arithmetic --------------------------------------------------------------------------------


def _parts(spark, d):
    k = F.col("p_partkey")
    return bridge.table(spark, d, "part").select(
        k.alias("p_partkey"),
        ((k * 31) % 4000).alias("nir"),
        ((k * 11) % 3000).alias("red"),
        (k % 8).alias("mask"),
        F.date_add(F.lit(dt.date(2022, 1, 20)), (k % 12).cast("int")).alias("day"),
        (F.lit(500000.0) + (k % 400) * 10 - 37).alias("x"),
    )


PART = """
WITH q AS (SELECT p_partkey, (p_partkey * 31) % 4000 AS nir, (p_partkey * 11) % 3000 AS red, p_partkey % 8 AS mask,
             DATE '2022-01-20' + CAST(p_partkey % 12 AS INTEGER) AS day, CAST(500000 + (p_partkey % 400) * 10 - 37 AS DOUBLE) AS x FROM part)
"""
CUTOFF = dt.date(2022, 1, 25)


@query("p15_clear_mask", PART + "SELECT p_partkey, mask FROM q WHERE mask = 0")
def p15(spark, d):
    return _parts(spark, d).filter(raster.is_clear(F.col("mask"), (0,))).select("p_partkey", "mask")


@query("p16_scl_mask", PART + "SELECT p_partkey, mask FROM q WHERE mask IN (4, 5, 7)")
def p16(spark, d):
    return _parts(spark, d).filter(raster.is_clear(F.col("mask"), (4, 5, 7))).select("p_partkey", "mask")


@query("p17_nodata", PART + "SELECT p_partkey, nullif(nir, 62) AS dn FROM q")
def p17(spark, d):
    return _parts(spark, d).select("p_partkey", raster.no_data(F.col("nir"), F.lit(62)).alias("dn"))


@query("p18_sentinels", PART + "SELECT p_partkey, CAST(CASE WHEN nir NOT IN (0, 65535) AND red NOT IN (0, 65535) THEN nir END AS BIGINT) AS nir FROM q")
def p18(spark, d):
    return _parts(spark, d).select("p_partkey", F.when(raster.valid_pair(F.col("nir"), F.col("red"), (0, 65535)), F.col("nir")).cast("long").alias("nir"))


@query("p19_out_of_bounds", PART + "SELECT p_partkey, CASE WHEN px BETWEEN 0 AND 199 THEN px END AS px FROM (SELECT p_partkey, CAST(trunc((x - 500000) / 10) AS INTEGER) AS px FROM q)")
def p19(spark, d):
    px = raster.pixel_trunc(F.col("x"), F.lit(500000.0), F.lit(10.0))
    return _parts(spark, d).select("p_partkey", px.alias("px")).select("p_partkey", F.when(raster.inside(F.col("px"), F.lit(0), F.lit(200), F.lit(1)), F.col("px")).alias("px"))


@query("p20_oob_clamp", PART + "SELECT p_partkey, least(greatest(CAST(floor((x - 500000) / 10) AS INTEGER), 0), 199) AS px FROM q")
def p20(spark, d):
    px = raster.pixel_floor(F.col("x"), F.lit(500000.0), F.lit(10.0))
    return _parts(spark, d).select("p_partkey", raster.clamp(px, F.lit(200)).alias("px"))


@query("p21_pixel_trunc", PART + "SELECT p_partkey, CAST(trunc((x - 500000) / 20) AS INTEGER) AS px FROM q")
def p21(spark, d):
    return _parts(spark, d).select("p_partkey", raster.pixel_trunc(F.col("x"), F.lit(500000.0), F.lit(20.0)).alias("px"))


@query("p22_pixel_floor", PART + "SELECT p_partkey, px, CAST(500000 + px * 20 AS DOUBLE) AS corner FROM (SELECT p_partkey, CAST(floor((x - 500000) / 20) AS INTEGER) AS px FROM q)")
def p22(spark, d):
    px = raster.pixel_floor(F.col("x"), F.lit(500000.0), F.lit(20.0))
    return _parts(spark, d).select("p_partkey", px.alias("px")).withColumn("corner", raster.pixel_corner(F.col("px"), F.lit(500000.0), F.lit(20.0)))


@query("p23_dn_offset", PART + "SELECT p_partkey, CAST(CASE WHEN day > DATE '2022-01-25' THEN nir - 1000 ELSE nir END AS BIGINT) AS dn FROM q")
def p23(spark, d):
    return _parts(spark, d).select("p_partkey", raster.dn_corrected(F.col("nir"), F.col("day"), CUTOFF, 1000).cast("long").alias("dn"))


@query("p24_ndvi", PART + "SELECT p_partkey, round(CASE WHEN nir + red <> 0 THEN CAST(nir - red AS DOUBLE) / (nir + red) END, 6) AS ndvi FROM q")
def p24(spark, d):
    return _parts(spark, d).select("p_partkey", r6(raster.normalized_difference(F.col("nir"), F.col("red")), "ndvi"))


@query("p25_narrowed", PART + "SELECT p_partkey, CAST(CASE WHEN nir + red <> 0 THEN CAST(nir - red AS DOUBLE) / (nir + red) END AS FLOAT) AS ndvi FROM q")
def p25(spark, d):
    return _parts(spark, d).select("p_partkey", raster.normalized_difference(F.col("nir"), F.col("red")).cast("float").alias("ndvi"))


@query("p27_bround", "SELECT p_partkey, round_even(CAST(p_partkey AS DOUBLE) / 8, 2) AS v FROM part")
def p27(spark, d):
    return bridge.table(spark, d, "part").select("p_partkey", F.bround(F.col("p_partkey").cast("double") / 8, 2).alias("v"))


@query("p37_masked_difference", PART + "SELECT p_partkey, round(CASE WHEN mask IN (4, 5, 7) AND nir + red <> 0 THEN CAST(nir - red AS DOUBLE) / (nir + red) END, 6) AS ndvi FROM q")
def p37(spark, d):
    value = F.when(raster.is_clear(F.col("mask"), (4, 5, 7)), raster.normalized_difference(F.col("nir"), F.col("red")))
    return _parts(spark, d).select("p_partkey", r6(value, "ndvi"))


@query("p38_day_tile_bounds", PART + "SELECT p_partkey FROM q WHERE day >= DATE '2022-01-22' AND day < DATE '2022-01-24' AND mask = 2 AND x BETWEEN 500100 AND 502000")
def p38(spark, d):
    day = F.col("day")
    return _parts(spark, d).filter((day >= F.lit(dt.date(2022, 1, 22))) & (day < F.lit(dt.date(2022, 1, 24))) & (F.col("mask") == 2) & F.col("x").between(500100, 502000)).select("p_partkey")


# Geometry, grid, projection ---------------------------------------------------------------------


@query("p1_to_utm", None)
def p1(spark, d):
    """Customers' invented places, projected: tests compare with control points and round trips."""
    k = F.col("c_custkey")
    lon, lat = 99 + (k % 600) / 100.0, 5 + (k % 1500) / 100.0
    epsg = crs.zone_of(lon)
    x, y = crs.to_utm(lon, lat, epsg)
    return bridge.table(spark, d, "customer").select("c_custkey", epsg.alias("epsg"), r6(x, "x"), r6(y, "y"))


@query("p2_round_trip", "SELECT c_custkey, round(99 + CAST(c_custkey % 600 AS DOUBLE) / 100, 6) AS lon, round(5 + CAST(c_custkey % 1500 AS DOUBLE) / 100, 6) AS lat FROM customer")
def p2(spark, d):
    k = F.col("c_custkey")
    lon, lat = 99 + (k % 600) / 100.0, 5 + (k % 1500) / 100.0
    placed = bridge.table(spark, d, "customer").select("c_custkey", crs.zone_of(lon).alias("epsg"), lon.alias("a"), lat.alias("b"))
    x, y = crs.to_utm(F.col("a"), F.col("b"), F.col("epsg"))
    back = placed.select("c_custkey", "epsg", x.alias("x"), y.alias("y"))
    lon, lat = crs.to_lonlat(F.col("x"), F.col("y"), F.col("epsg"))
    return back.select("c_custkey", r6(lon, "lon"), r6(lat, "lat"))


@query("p4_utm_zone", "SELECT c_nationkey, CASE WHEN avg(99 + CAST(c_custkey % 600 AS DOUBLE) / 100) >= 102 THEN 32648 ELSE 32647 END AS epsg FROM customer GROUP BY 1")
def p4(spark, d):
    lon = 99 + (F.col("c_custkey") % 600) / 100.0
    return bridge.table(spark, d, "customer").groupBy("c_nationkey").agg(crs.zone_of(F.avg(lon)).alias("epsg"))


@query("p6_snap", BOX + "SELECT plot_id, floor(x0 / 10) * 10 AS x, floor(y0 / 10) * 10 AS y FROM box")
def p6(spark, d):
    return bridge.boxes(spark, d).select("plot_id", grid.snapped(F.col("x0"), 10).alias("x"), grid.snapped(F.col("y0"), 10).alias("y"))


def _axis_sql(first: str) -> str:
    return BOX + f"SELECT plot_id, x FROM (SELECT plot_id, x0, w, {first} + unnest(generate_series(0, 20)) * 10 AS x FROM box) WHERE x < x0 + w"


def _axis(spark, d, start):
    return bridge.boxes(spark, d).select("plot_id", F.explode(grid.axis(F.col("x0"), F.col("x0") + F.col("w"), 10, start)).alias("x"))


@query("p7_grid_axis", _axis_sql("floor(x0 / 10) * 10 + 5"))
def p7(spark, d):
    return _axis(spark, d, grid.SNAPPED)


@query("p8_axis_corner", _axis_sql("x0"))
def p8(spark, d):
    return _axis(spark, d, grid.CORNER)


@query("p9_axis_centre", _axis_sql("x0 + 5"))
def p9(spark, d):
    return _axis(spark, d, grid.CENTRE)


@query("p10_point_in_polygon", BOX + "SELECT plot_id, CAST(count(*) AS BIGINT) AS n, sum(x) AS sx, sum(y) AS sy FROM pts GROUP BY 1")
def p10(spark, d):
    """Every centre of a plot's bounding box is tested against all its edges."""
    plots = bridge.plots(spark, d).select("plot_id", F.explode("parts").alias("rings"))
    edged = plots.select("plot_id", geometry.polygon_edges(F.col("rings")).alias("e"), geometry.bounds(F.flatten("rings")).alias("b"))
    x = edged.withColumn("x", F.explode(grid.axis(F.col("b.xmin"), F.col("b.xmax"), 10)))
    both = x.withColumn("y", F.explode(grid.axis(F.col("b.ymin"), F.col("b.ymax"), 10)))
    return both.filter(geometry.in_polygon(F.col("e"), F.col("x"), F.col("y"))).groupBy("plot_id").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"))


@query("p11_polygon_flatten", BOX + "SELECT plot_id, part FROM part")
def p11(spark, d):
    """The polygons of geometries' bytes, of which some are multipolygons."""
    flat = bridge.plots(spark, d).select("plot_id", wkb.decoded(wkb.encoded("parts")).alias("parts"))
    return flat.select("plot_id", F.posexplode("parts").alias("part", "rings")).select("plot_id", "part")


@query("o7_point_id", BOX + "SELECT plot_id, point_id, x, y FROM pts")
def o7(spark, d):
    return grid.grid(bridge.plots(spark, d))


@query("f1_feature_id", BOX + "SELECT plot_id, point_id, 'RAYONG_' || plot_id AS plot_uid, md5('RAYONG_' || plot_id || '_' || CAST(round_even(x, 0) AS BIGINT) || '_' || CAST(round_even(y, 0) AS BIGINT)) AS feature_id FROM pts")
def f1(spark, d):
    uid = text.plot_uid("RAYONG", F.col("plot_id"))
    return grid.grid(bridge.plots(spark, d)).select("plot_id", "point_id", uid.alias("plot_uid"), text.feature_id(uid, F.col("x"), F.col("y")).alias("feature_id"))


UID = "'RAYONG_' || plot_id"


@query("s24_province_grid", BOX + f"SELECT 'RAYONG' AS province, plot_id, {UID} AS plot_uid, point_id, md5({UID} || '_' || CAST(x AS BIGINT) || '_' || CAST(y AS BIGINT)) AS feature_id, x AS x_utm, y AS y_utm, x AS x_back, y AS y_back, 21 AS n_bytes FROM pts")
def s24(spark, d):
    """The whole grid table; its geographic coordinates projected forward again, and the size of its point's bytes."""
    made = grid.province_grid(grid.grid(bridge.plots(spark, d)), "RAYONG", 32647)
    x, y = crs.to_utm(F.col("lon"), F.col("lat"), 32647)
    return made.select(*made.columns[:7], r6(x, "x_back"), r6(y, "y_back"), F.octet_length("geometry").alias("n_bytes"))


@query("s22_point_master", BOX + "SELECT plot_id, point_id, x, y, TRUE AS same, '0101000000' AS head FROM pts")
def s22(spark, d):
    """Point master: its place projected forward again, the same place in both pairs of columns, and its geometry's header."""
    made = grid.point_master(grid.province_grid(grid.grid(bridge.plots(spark, d)), "RAYONG", 32647))
    x, y = crs.to_utm(F.col("lon"), F.col("lat"), 32647)
    return made.select("plot_id", "point_id", r6(x, "x"), r6(y, "y"), ((F.col("x") == F.col("lon")) & (F.col("y") == F.col("lat"))).alias("same"), F.hex(F.substring("geometry", 1, 5)).alias("head"))


@query("s12_grid_scan", BOX + "SELECT plot_id, CAST(count(*) AS BIGINT) AS n, CAST(max(point_id) AS BIGINT) AS last FROM pts GROUP BY 1")
def s12(spark, d):
    """The grid table written, and read with the columns that a run needs."""
    path = f"{files.folder(spark, 'grid')}/RAYONG_grid.parquet"
    grid.province_grid(grid.grid(bridge.plots(spark, d)), "RAYONG", 32647).write.parquet(path)
    return tables.grid(spark, path).groupBy("plot_id").agg(F.count("lat").alias("n"), F.max("point_id").alias("last"))


@query("s3_default_id", BOX + "SELECT plot_id AS name, CAST(row_number() OVER (ORDER BY x0, plot_id) - 1 AS BIGINT) AS plot_id FROM box")
def s3(spark, d):
    boxes = bridge.boxes(spark, d).withColumnRenamed("plot_id", "name")
    return grid.with_default_id(boxes, ["x0", "name"]).select("name", "plot_id")


@query("p3_reproject_polygons", BOX + "SELECT plot_id, min(x0) AS xmin, min(y0) AS ymin, max(x0 + w) AS xmax, max(y0 + h) AS ymax, CAST(sum(CASE WHEN hole THEN 10 ELSE 5 END) AS BIGINT) AS n FROM part GROUP BY 1")
def p3(spark, d):
    """Polygons to degrees and back to metres: bounds and number of vertices."""
    there = bridge.plots(spark, d).withColumn("parts", crs.reprojected(F.col("parts"), 32647, forward=False))
    back = there.select("plot_id", geometry.vertices(crs.reprojected(F.col("parts"), 32647)).alias("v"))
    b = geometry.bounds(F.col("v"))
    return back.select("plot_id", *(r6(b[n], n) for n in ("xmin", "ymin", "xmax", "ymax")), F.size("v").cast("long").alias("n"))


@query("p12_drop_null_geometry", BOX + "SELECT plot_id, TRUE AS valid, CAST(count(*) AS BIGINT) AS n_parts FROM part WHERE plot_id % 5 NOT IN (0, 1) GROUP BY 1")
def p12(spark, d):
    """Geometries that are null or without area go; the others are decoded and valid."""
    flat = F.array(F.array(geometry.rectangle(F.lit(0.0), F.lit(0.0), F.lit(9.0), F.lit(0.0))))
    k = F.col("plot_id") % 5
    bytes_of = F.when(k == 1, wkb.encoded(flat)).when(k != 0, wkb.encoded("parts"))
    return grid.polygons(bridge.plots(spark, d).select("plot_id", bytes_of.alias("geometry"))).select("plot_id", "valid", F.size("parts").cast("long").alias("n_parts"))


@query("p13_make_valid", BOX + """
SELECT plot_id, CASE plot_id % 6 WHEN 0 THEN 2 WHEN 3 THEN 2 WHEN 5 THEN 2 ELSE 1 END AS n_parts, CASE plot_id % 6 WHEN 0 THEN 2 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 5 THEN 2 ELSE 1 END AS n_rings,
       round(w * h * CASE plot_id % 6 WHEN 0 THEN 0.5 WHEN 2 THEN 0.8125 WHEN 3 THEN 1.5 WHEN 4 THEN 2.0 WHEN 5 THEN 0.75 ELSE 1.0 END, 6) AS area, TRUE AS valid FROM box""")
def p13(spark, d):
    """Bow ties, spikes, a hole that touches the outer ring, parts that overlap or share an edge, a hole across the whole."""
    x, y, w, h, k = F.col("x0"), F.col("y0"), F.col("w"), F.col("h"), F.col("plot_id") % 6

    def ring(*corners: tuple[float, float]) -> Column:
        return F.array(*(geometry.point(x + a * w, y + b * h) for a, b in (*corners, corners[0])))

    whole = ring((0, 0), (1, 0), (1, 1), (0, 1))
    broken = (
        F.when(k == 0, F.array(F.array(ring((0, 0), (1, 1), (1, 0), (0, 1)))))
        .when(k == 1, F.array(F.array(ring((0, 0), (1, 0), (1, 1), (2, 2), (1, 1), (0, 1)))))
        .when(k == 2, F.array(F.array(whole, ring((0, 0.5), (0.5, 0.25), (0.75, 0.5), (0.5, 0.75)))))
        .when(k == 3, F.array(F.array(whole), F.array(ring((0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5)))))
        .when(k == 4, F.array(F.array(whole), F.array(ring((1, 0), (2, 0), (2, 1), (1, 1)))))
        .otherwise(F.array(F.array(whole, ring((0.25, 0), (0.5, 0), (0.5, 1), (0.25, 1)))))
    )
    found = grid.polygons(bridge.boxes(spark, d).select("plot_id", wkb.encoded(broken).alias("geometry")))
    n_rings = F.aggregate("parts", F.lit(0), lambda n, rings: n + F.size(rings))
    simple = F.col("valid") & F.forall("parts", geometry.is_simple_polygon)
    return found.select("plot_id", F.size("parts").alias("n_parts"), n_rings.alias("n_rings"), r6(geometry.area(F.col("parts")), "area"), simple.alias("valid"))


@query("f13_representative_point", BOX + "SELECT plot_id, TRUE AS inside, FALSE AS empty FROM box")
def f13(spark, d):
    # A step of its own: inside the test, which goes over the edges, the point would be found for each.
    placed = order.materialised(bridge.plots(spark, d).select("plot_id", "parts", geometry.representative_point(F.col("parts")).alias("p")))
    return placed.select("plot_id", geometry.in_polygon(geometry.edges(F.col("parts")), F.col("p.x"), F.col("p.y")).alias("inside"), (F.size("parts") == 0).alias("empty"))


@query("f11_centroid", BOX + """
SELECT plot_id, round(sum(a * cx) / sum(a), 6) AS x, round(sum(a * cy) / sum(a), 6) AS y, round(sum(a), 6) AS area FROM (
  SELECT plot_id, w * h AS a, x0 + w / 2 AS cx, y0 + h / 2 AS cy FROM part
  UNION ALL SELECT plot_id, -100.0, x0 + 15, y0 + 15 FROM part WHERE hole) GROUP BY 1""")
def f11(spark, d):
    c = geometry.centroid(F.col("parts"))
    return bridge.plots(spark, d).select("plot_id", r6(c["x"], "x"), r6(c["y"], "y"), r6(geometry.area(F.col("parts")), "area"))


@query("s2_vector_folder", BOX + """
SELECT CASE plot_id % 3 WHEN 0 THEN 'gpkg' WHEN 1 THEN 'shp' ELSE 'parquet' END AS kind, plot_id, CASE WHEN plot_id % 3 = 2 THEN NULL ELSE 32647 END AS epsg,
       CAST(count(*) AS BIGINT) AS n_parts, round(sum(w * h - CASE WHEN hole THEN 100 ELSE 0 END), 6) AS area FROM part GROUP BY 1, 2, 3""")
def s2(spark, d):
    """A folder of GeoPackages, shapefiles and a Parquet table, written from the plots and read as one table."""
    path, plots = files.folder(spark, "polygons"), bridge.plots(spark, d)
    files.write_packages(plots.filter("plot_id % 3 = 0"), path, 32647)
    files.write_shapes(plots.filter("plot_id % 3 = 1"), path, 'PROJCS["WGS_1984_UTM_Zone_47N",GEOGCS["GCS_WGS_1984"]]')
    plots.filter("plot_id % 3 = 2").select("plot_id", wkb.encoded("parts").alias("geometry")).write.parquet(f"{path}/table.parquet")
    found = grid.polygons(tables.polygon_folder(spark, path))
    kind = F.when(F.col("file").endswith(".gpkg"), "gpkg").when(F.col("file").endswith(".shp"), "shp").otherwise("parquet")
    return found.select(kind.alias("kind"), F.col("attributes")["plot_id"].cast("long").alias("plot_id"), "epsg", F.size("parts").cast("long").alias("n_parts"), r6(geometry.area(F.col("parts")), "area"))


@query("f12_bounds", BOX + "SELECT plot_id, min(x0) AS xmin, min(y0) AS ymin, max(x0 + w) AS xmax, max(y0 + h) AS ymax FROM part GROUP BY 1")
def f12(spark, d):
    return bridge.plots(spark, d).select("plot_id", geometry.bounds(geometry.vertices(F.col("parts"))).alias("b")).select("plot_id", "b.*")


@query("a28_extent", BOX + "SELECT min(x0) AS xmin, min(y0) AS ymin, max(x0 + w) AS xmax, max(y0 + h) AS ymax FROM part")
def a28(spark, d):
    return f12(spark, d).agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


# Joins ------------------------------------------------------------------------------------------


def _plot_tiles(spark, d):
    return spatial.intersecting(bridge.plots(spark, d), bridge.tiles(spark, d), "plot_id", "tile_no", 500)


@query("j1_spatial_intersects", BOX + "SELECT plot_id, tile_no FROM pt")
def j1(spark, d):
    return _plot_tiles(spark, d)


@query("j2_semi_plots", BOX + "SELECT plot_id, point_id FROM pts WHERE plot_id IN (SELECT plot_id FROM pt WHERE tile_no = 1)")
def j2(spark, d):
    return grid.grid(bridge.plots(spark, d)).join(_plot_tiles(spark, d).filter("tile_no = 1"), "plot_id", "left_semi").select("plot_id", "point_id")


@query("j3_slots", BOX + "SELECT tile_no, plot_id, CAST(row_number() OVER (PARTITION BY tile_no ORDER BY plot_id) - 1 AS BIGINT) AS slot FROM pt")
def j3(spark, d):
    return spatial.slots(_plot_tiles(spark, d), "plot_id", "tile_no")


def _raster(spark, d):
    points = spatial.tile_points(grid.grid(bridge.plots(spark, d)), _plot_tiles(spark, d), tile="tile_no").withColumnRenamed("tile_no", "tile")
    meta = bridge.meta(spark, d)
    return points, bridge.scenes(spark, d), sampling.blocked(bridge.pixels(spark, d), BLOCK), meta


@query("j5_point_scene", RASTER + "SELECT tile, plot_id, point_id, scene_id, CAST(mask AS INTEGER) AS mask FROM seen")
def j5(spark, d):
    points, _, blocks, meta = _raster(spark, d)
    return sampling.sampled(points.select("tile", "plot_id", "point_id", "x", "y"), blocks, meta, "mask", "mask", CONFIG).select("tile", "plot_id", "point_id", "scene_id", "mask")


@query("j6_pixel_lookup", RASTER + "SELECT tile, plot_id, point_id, scene_id, CAST(nir AS INTEGER) AS nir FROM bands")
def j6(spark, d):
    """Plain equi-join on pixel numbers, with the table of single pixels."""
    points, scenes, _, meta = _raster(spark, d)
    at = sampling.placed(points, meta, "nir", CONFIG).join(scenes.select("tile", "scene_id"), "tile")
    pixels = bridge.pixels(spark, d).filter("band = 'nir'").select("tile", "scene_id", "px", "py", "dn")
    return at.join(pixels, ["tile", "scene_id", "px", "py"]).select("tile", "plot_id", "point_id", "scene_id", raster.no_data(F.col("dn"), F.col("nodata")).alias("nir"))


@query("j7_mask_then_band", RASTER + "SELECT tile, plot_id, point_id, CAST(day AS VARCHAR) AS day, round(v, 6) AS ndvi FROM val")
def j7(spark, d):
    points, scenes, blocks, meta = _raster(spark, d)
    return sampling.observations(points, scenes, blocks, meta, CONFIG).select("tile", "plot_id", "point_id", day_text(), r6("ndvi"))


@query("j8_coarse_mask", PART + "SELECT p_partkey, CAST(floor((x - 500000) / 20) AS INTEGER) AS mx, CAST(((floor((x - 500000) / 20) * 7) % 5) AS BIGINT) AS mask FROM q WHERE x >= 500000")
def j8(spark, d):
    """The coarse mask's cell under a fine pixel, from a mask raster of 20 m in blocks, the same in each of three tiles."""
    tiles = F.array(*map(F.lit, "ABC"))
    fine = _parts(spark, d).filter("x >= 500000").select("p_partkey", F.element_at(tiles, (F.col("p_partkey") % 3 + 1).cast("int")).alias("tile"), "x", F.lit(10.0).alias("y"))
    cells = bridge.table(spark, d, "part").select((F.col("p_partkey") % 200).cast("int").alias("px")).distinct()
    pixels = cells.select(F.explode(tiles).alias("tile"), "px").select("tile", F.lit(1).cast("long").alias("scene_id"), F.lit("mask").alias("band"), "px", F.lit(0).alias("py"), (F.col("px") * 7 % 5).alias("dn"))
    place = {"gx": 500000.0, "gw": 20.0, "gy": 0.0, "gh": 20.0, "nx": 200, "ny": 1}
    meta = pixels.select("tile", "band").distinct().select("tile", "band", *(F.lit(v).alias(n) for n, v in place.items()), F.lit(None).cast("int").alias("nodata"))
    found = sampling.sampled(fine, sampling.blocked(pixels, BLOCK), meta, "mask", "mask", CONFIG)
    return found.select("p_partkey", raster.pixel_floor(F.col("x"), F.lit(500000.0), F.lit(20.0)).alias("mx"), F.col("mask").cast("long").alias("mask"))


@query("s15_geotiff_pixels", RASTER + "SELECT tile, plot_id, point_id, CAST(day AS VARCHAR) AS day, round(v, 6) AS ndvi FROM val")
def s15(spark, d):
    """As j7, from GeoTIFF files: directories to a table of blocks, of which those with points are read."""
    points, scenes, _, _ = _raster(spark, d)
    points = order.materialised(points)
    epsg, nodata = 32647, 3999
    listed = files.write_rasters(bridge.pixels(spark, d), files.folder(spark, "rasters"), BLOCK, (bridge.GX, bridge.GY), (bridge.GW, bridge.GH), epsg, nodata)
    found = order.materialised(geotiff.index(order.materialised(listed), BLOCK))
    own = geotiff.meta(found)
    blocks = geotiff.blocks(geotiff.needed(found, points, own, CONFIG, list(bridge.BANDS)), BLOCK, bands=list(bridge.BANDS))
    return sampling.observations(points, scenes, blocks, own, CONFIG).select("tile", "plot_id", "point_id", day_text(), r6("ndvi"))


@query("s14_raster_meta", f"SELECT r_regionkey AS tile, band, CAST({bridge.GX} AS DOUBLE) AS gx, CAST({bridge.GW} AS DOUBLE) AS gw, CAST({bridge.GY} AS DOUBLE) AS gy, CAST({bridge.GH} AS DOUBLE) AS gh, {bridge.NX} AS nx, {bridge.NY} AS ny, CAST(3999 AS DOUBLE) AS nodata, 32647 AS epsg FROM region, (SELECT unnest(['mask', 'nir', 'red']) AS band)")
def s14(spark, d):
    """Place, reference system and no-data value of every tile's bands, from the files' directories."""
    listed = files.write_rasters(bridge.pixels(spark, d), files.folder(spark, "rasters"), BLOCK, (bridge.GX, bridge.GY), (bridge.GW, bridge.GH), 32647, 3999)
    return geotiff.meta(geotiff.index(order.materialised(listed), BLOCK))


@query("s17_full_band", "SELECT r_regionkey AS tile, r_regionkey * 4 + k AS scene_id, band, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN b = 0 THEN (px * 31 + py * 17 + (r_regionkey * 4 + k) * 13) % 3 ELSE ((px * 31 + py * 17 + (r_regionkey * 4 + k) * 13 + b * 7) * 37) % 4000 END * (px + 64 * py)) AS BIGINT) AS mixed FROM region, (SELECT unnest(generate_series(0, 3)) AS k), (SELECT unnest(['mask', 'nir', 'red']) AS band, unnest([0, 1, 2]) AS b), (SELECT unnest(generate_series(0, 63)) AS px), (SELECT unnest(generate_series(0, 63)) AS py) GROUP BY 1, 2, 3")
def s17(spark, d):
    """All pixels of all bands, taken out of their blocks: how many, and their values weighted by their places."""
    pixels = sampling.pixels(sampling.blocked(bridge.pixels(spark, d), BLOCK), bridge.meta(spark, d), BLOCK)
    mixed = F.sum(F.col("dn").cast("long") * (F.col("px") + F.lit(bridge.NX) * F.col("py")))
    return pixels.groupBy("tile", "scene_id", "band").agg(F.count(F.lit(1)).alias("n"), mixed.alias("mixed"))


@query("a10_clear_counts", RASTER + "SELECT tile, scene_id, CAST(count(*) AS BIGINT) AS n_points, CAST(count(*) FILTER (mask = 0) AS BIGINT) AS n_clear FROM seen GROUP BY 1, 2")
def a10(spark, d):
    points, _, blocks, meta = _raster(spark, d)
    return sampling.clear_counts(points, blocks, meta, CONFIG)


@query("a32_day_mosaic", RASTER + "SELECT day, px, py, CAST(arg_max(nir, scene_id) AS INTEGER) AS nir FROM (SELECT CAST(date_trunc('month', day) AS VARCHAR)[1:7] AS day, px, py, nir, scene_id FROM bands) WHERE nir IS NOT NULL GROUP BY 1, 2, 3")
def a32(spark, d):
    images = j6(spark, d).join(bridge.scenes(spark, d).select("scene_id", "day"), "scene_id")
    points = sampling.placed(_raster(spark, d)[0], bridge.meta(spark, d), "nir", CONFIG).select("tile", "plot_id", "point_id", "px", "py")
    placed = images.join(points, ["tile", "plot_id", "point_id"]).withColumn("day", F.date_format("day", "yyyy-MM"))
    return sampling.mosaic(placed, ["day", "px", "py"], "nir", "scene_id")


@query("run_monthly", RASTER + """,
st AS (SELECT tile, plot_id, point_id, strftime(day, '%Y-%m') AS month, avg(v) AS mean, max(v) AS max, min(v) AS min, median(v) AS median FROM val GROUP BY 1, 2, 3, 4),
one AS (SELECT plot_id, point_id, month, arg_min(mean, tile) FILTER (mean IS NOT NULL) AS mean, arg_min(max, tile) FILTER (max IS NOT NULL) AS max,
          arg_min(min, tile) FILTER (min IS NOT NULL) AS min, arg_min(median, tile) FILTER (median IS NOT NULL) AS median FROM st GROUP BY 1, 2, 3),
frame AS (SELECT plot_id, point_id, month FROM (SELECT DISTINCT plot_id, point_id FROM place), (SELECT DISTINCT strftime(day, '%Y-%m') AS month FROM scene))
SELECT plot_id, point_id, month, round(mean, 6) AS mean, round(max, 6) AS max, round(min, 6) AS min, round(median, 6) AS median FROM frame LEFT JOIN one USING (plot_id, point_id, month)""")
def run_monthly(spark, d):
    """Grid, tiles, rasters, mask, index, monthly statistics, tiles merged, all points and months kept."""
    points, scenes, blocks, meta = _raster(spark, d)
    stats = run.monthly_statistics(points, scenes, blocks, meta, CONFIG)
    return stats.select("plot_id", "point_id", "month", *(r6(s) for s in monthly.STATS))


@query("j9_two_sources", OBS + "SELECT plot_id, point_id, CAST(day AS VARCHAR) AS day, round(loc.v, 6) AS local, round(rem.v, 6) AS remote FROM loc JOIN rem USING (plot_id, point_id, day)")
def j9(spark, d):
    return compare.aligned(*bridge.sides(spark, d), how="inner").select("plot_id", "point_id", day_text(), r6("local"), r6("remote"))


@query("j10_left", OBS + "SELECT plot_id, point_id, CAST(day AS VARCHAR) AS day, round(loc.v, 6) AS local, round(rem.v, 6) AS remote FROM loc LEFT JOIN rem USING (plot_id, point_id, day)")
def j10(spark, d):
    return compare.aligned(*bridge.sides(spark, d), how="left").select("plot_id", "point_id", day_text(), r6("local"), r6("remote"))


@query("j11_inner_months", OBS + "SELECT plot_id, month, round(v1, 6) AS v1, round(v2, 6) AS v2 FROM pairs WHERE v1 IS NOT NULL AND v2 IS NOT NULL")
def j11(spark, d):
    return compare.month_pairs(*bridge.plot_months(spark, d), how="inner").select("plot_id", "month", r6("v1"), r6("v2"))


@query("j12_located", OBS + "SELECT plot_id, point_id, CAST(day AS VARCHAR) AS day, round(abs_diff, 6) AS abs_diff, round_even(CAST(plot_id AS DOUBLE) / 64, 6) AS lat, round_even(CAST(point_id AS DOUBLE) / 64, 6) AS lon FROM large")
def j12(spark, d):
    local, remote = bridge.sides(spark, d)
    points = local.select("plot_id", "point_id").distinct().withColumns({"lat": F.col("plot_id") / 64.0, "lon": F.col("point_id") / 64.0})
    return compare.located(compare.large_differences(local, remote), points).select("plot_id", "point_id", day_text(), r6("abs_diff"), "lat", "lon")


@query("j13_full_outer", OBS + "SELECT plot_id, month, round(v1, 6) AS v1, round(v2, 6) AS v2 FROM pairs")
def j13(spark, d):
    return compare.month_pairs(*bridge.plot_months(spark, d)).select("plot_id", "month", r6("v1"), r6("v2"))


ONE_OF_ALL = ", one AS (SELECT plot_id, point_id, month, " + ", ".join(f"arg_min({s}, tile_no) FILTER ({s} IS NOT NULL) AS {s}" for s in monthly.STATS) + " FROM stats GROUP BY 1, 2, 3)"


# Aggregations -----------------------------------------------------------------------------------


def _stats(spark, d):
    return monthly.statistics(bridge.observations(spark, d), "v", keys=("tile_no", *monthly.POINT))


def _monthly(name: str, stat: str):
    @query(name, OBS + f"SELECT tile_no, plot_id, point_id, month, round({stat}, 6) AS {stat} FROM stats")
    def one(spark, d):
        return _stats(spark, d).select("tile_no", "plot_id", "point_id", "month", r6(stat))


for _i, _s in enumerate(monthly.STATS, 1):
    _monthly(f"a{_i}_monthly_{_s}", _s)


@query("a5_month_dense", OBS + """, by_plot AS (SELECT tile_no, plot_id, strftime(day, '%Y-%m') AS month, avg(v) AS mean FROM ndvi GROUP BY 1, 2, 3)
SELECT tile_no, plot_id, month, round(mean, 6) AS mean
FROM (SELECT DISTINCT tile_no, plot_id FROM obs) CROSS JOIN (SELECT DISTINCT strftime(day, '%Y-%m') AS month FROM obs) LEFT JOIN by_plot USING (tile_no, plot_id, month)""")
def a5(spark, d):
    """All plots of a tile in all months, cloudy ones included."""
    raw, keys = bridge.raw(spark, d), ("tile_no", "plot_id")
    stats = monthly.statistics(bridge.observations(spark, d), "v", keys=keys)
    return monthly.dense(stats, raw, monthly.months(raw), keys).select(*keys, "month", r6("mean"))


@query("s21_tile_sink", OBS + "SELECT tile_no AS tile, CAST(count(*) AS BIGINT) AS n, CAST(count(v) AS BIGINT) AS n_values, CAST(count(DISTINCT plot_id) AS BIGINT) AS n_plots FROM ndvi GROUP BY 1")
def s21(spark, d):
    """Observations written in a folder a tile, twice with the last tile alone the second time, and read back."""
    path = f"{files.folder(spark, 'tiles')}/tiles.parquet"
    seen = bridge.observations(spark, d).withColumnRenamed("tile_no", "tile")
    sinks.write_tiles(seen, path)
    sinks.write_tiles(seen.filter("tile = 4"), path)
    found = spark.read.schema(seen.schema).parquet(path)
    return found.groupBy("tile").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("n_values"), F.countDistinct("plot_id").alias("n_plots"))


@query("s23_four_tables", OBS + ONE_OF_ALL + " SELECT plot_id, point_id, CAST(plot_id AS FLOAT) AS lat, " + ", ".join(f"CAST(count({s}) AS BIGINT) AS n_{s}, max(CAST({s} AS FLOAT)) AS top_{s}" for s in monthly.STATS) + " FROM one GROUP BY 1, 2")
def s23(spark, d):
    """The four wide tables, joined: of every point the number of months with a value, and the largest, in single precision."""
    long = monthly.across_tiles(_stats(spark, d), "tile_no")
    points = long.select(*monthly.POINT, F.col("plot_id").alias("lat"), F.col("point_id").alias("lon")).distinct()
    days = bridge.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    months = sorted(r["month"] for r in monthly.months(days).collect())
    out = None
    for s, table in monthly.four_tables(long, points, months).items():
        held = F.array(*(F.col(f"`{m}`") for m in months))
        own = table.select(*monthly.POINT, *(["lat"] if out is None else []), F.size(F.filter(held, lambda v: v.isNotNull())).cast("long").alias(f"n_{s}"), F.array_max(held).alias(f"top_{s}"))
        out = own if out is None else out.join(own, list(monthly.POINT))
    return out


@query("a6_tile_dedup", OBS + "SELECT plot_id, point_id, month, " + ", ".join(f"round(arg_min({s}, tile_no) FILTER ({s} IS NOT NULL), 6) AS {s}" for s in monthly.STATS) + " FROM stats GROUP BY 1, 2, 3")
def a6(spark, d):
    return monthly.across_tiles(_stats(spark, d), "tile_no").select("plot_id", "point_id", "month", *(r6(s) for s in monthly.STATS))


@query("a7_distinct_tiles", BOX + "SELECT DISTINCT tile_no FROM pt")
def a7(spark, d):
    return _plot_tiles(spark, d).select("tile_no").distinct()


@query("a8_prefix_sum", BOX + "SELECT plot_id, n, CAST(sum(n) OVER (ORDER BY plot_id) AS BIGINT) AS upto FROM (SELECT plot_id, CAST(count(*) AS BIGINT) AS n FROM pts GROUP BY 1)")
def a8(spark, d):
    counts = grid.grid(bridge.plots(spark, d)).groupBy("plot_id").agg(F.count(F.lit(1)).alias("n"))
    return order.running_total(counts, "plot_id", "n", "upto")


@query("a9_points_per_plot", BOX + "SELECT CAST(count(DISTINCT plot_id) AS BIGINT) AS plots, round(count(*) / CAST(count(DISTINCT plot_id) AS DOUBLE), 6) AS per_plot FROM pts")
def a9(spark, d):
    counts = grid.grid(bridge.plots(spark, d)).groupBy("plot_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.count(F.lit(1)).alias("plots"), r6(F.avg("n"), "per_plot"))


@query("a11_daily_max", OBS + "SELECT tile_no AS tile, CAST(day AS VARCHAR) AS day, round(max(v), 6) AS ndvi_max FROM ndvi GROUP BY 1, 2")
def a11(spark, d):
    return monthly.daily_maximum(bridge.observations(spark, d).withColumnRenamed("tile_no", "tile"), "v").select("tile", day_text(), r6("ndvi_max"))


@query("a12_province_month_max", OBS + "SELECT strftime(day, '%Y-%m-01') AS year_month, round(max(v), 6) AS ndvi_max FROM ndvi GROUP BY 1")
def a12(spark, d):
    daily = monthly.daily_maximum(bridge.observations(spark, d).withColumnRenamed("tile_no", "tile"), "v")
    return monthly.province_month_maximum(daily).select(day_text("year_month"), r6("ndvi_max"))


@query("a13_plot_scene", OBS + "SELECT plot_id, CAST(day AS VARCHAR) AS day, round(avg(v), 6) AS mean, round(median(v), 6) AS median, CAST(count(v) AS BIGINT) AS n FROM ndvi GROUP BY 1, 2")
def a13(spark, d):
    return monthly.plot_scene(bridge.observations(spark, d), "v").select("plot_id", day_text(), r6("mean"), r6("median"), "n")


@query("a14_pooled_mean", OBS + "SELECT plot_id, strftime(day, '%Y-%m') AS month, round(avg(v), 6) AS mean FROM ndvi GROUP BY 1, 2")
def a14(spark, d):
    return monthly.plot_month_pooled(bridge.observations(spark, d), "v").select("plot_id", "month", r6("mean"))


@query("a15_two_level_mean", OBS + "SELECT plot_id, month, round(avg(m), 6) AS mean FROM (SELECT plot_id, month, arg_min(mean, tile_no) FILTER (mean IS NOT NULL) AS m FROM stats GROUP BY plot_id, point_id, month) GROUP BY 1, 2")
def a15(spark, d):
    return monthly.plot_month_of_points(monthly.across_tiles(_stats(spark, d), "tile_no")).select("plot_id", "month", r6("mean"))


@query("a16_mean_of_max", OBS + "SELECT plot_id, month, round(avg(m), 6) AS mean_max FROM (SELECT plot_id, strftime(day, '%Y-%m') AS month, max(v) AS m FROM ndvi GROUP BY plot_id, point_id, 2) GROUP BY 1, 2")
def a16(spark, d):
    return monthly.plot_month_maximum(bridge.observations(spark, d), "v").select("plot_id", "month", r6("mean_max"))


@query("a17_tile_max", OBS + "SELECT plot_id, month, round(max(m), 6) AS v FROM (SELECT tile_no, plot_id, month, avg(mean) AS m FROM stats GROUP BY 1, 2, 3) GROUP BY 1, 2")
def a17(spark, d):
    tile = _stats(spark, d).groupBy("tile_no", "plot_id", "month").agg(F.avg("mean").alias("v"))
    return monthly.tile_maximum(tile, "v").select("plot_id", "month", r6("v"))


@query("a18_large_diff_summary", OBS + "SELECT plot_id, CAST(count(*) AS BIGINT) AS n_pairs, round(avg(abs_diff), 6) AS mean_diff, round(max(abs_diff), 6) AS max_diff FROM large GROUP BY 1")
def a18(spark, d):
    return compare.difference_summary(compare.large_differences(*bridge.sides(spark, d))).select("plot_id", "n_pairs", r6("mean_diff"), r6("max_diff"))


@query("a19_unmatched_crosstab", OBS + "SELECT plot_id, CAST(count(*) FILTER (lc = 0) AS BIGINT) AS gee_only, CAST(count(*) FILTER (rc = 0) AS BIGINT) AS local_only FROM pd WHERE (lc > 0) <> (rc > 0) GROUP BY 1")
def a19(spark, d):
    return compare.unmatched_table(compare.unmatched_days(*bridge.sides(spark, d)))


@query("a20_valid_counts", OBS + "SELECT plot_id, CAST(day AS VARCHAR) AS day, CAST(lc AS BIGINT) AS local_valid_pts, CAST(rc AS BIGINT) AS gee_valid_pts, round(lm, 6) AS local_mean, round(rm, 6) AS gee_mean FROM pd")
def a20(spark, d):
    return compare.plot_days(*bridge.sides(spark, d)).select("plot_id", day_text(), "local_valid_pts", "gee_valid_pts", r6("local_mean"), r6("gee_mean"))


@query("a22_valid_scene_count", OBS + "SELECT plot_id, strftime(day, '%Y-%m') AS month, CAST(count(DISTINCT day) AS BIGINT) AS n_scenes FROM loc GROUP BY 1, 2")
def a22(spark, d):
    return compare.valid_scenes(bridge.sides(spark, d)[0])


@query("a23_scene_list", OBS + "SELECT plot_id, month, string_agg(CAST(CAST(round(m * 16) AS BIGINT) AS VARCHAR), ',' ORDER BY day) AS scene_means FROM (SELECT plot_id, day, strftime(day, '%Y-%m') AS month, avg(v) AS m FROM loc GROUP BY 1, 2) GROUP BY 1, 2")
def a23(spark, d):
    listed = compare.scene_means(bridge.sides(spark, d)[0], 12)
    return listed.select("plot_id", "month", F.array_join(F.transform("scene_means", lambda m: F.round(m * 16).cast("long").cast("string")), ",").alias("scene_means"))


@query("a24_global_error", OBS + "SELECT CAST(count(diff) AS BIGINT) AS n, round(avg(abs_diff), 6) AS mae, round(avg(diff), 6) AS bias, round(max(abs_diff), 6) AS max_abs FROM pairs WHERE diff IS NOT NULL")
def a24(spark, d):
    return compare.error_of(compare.month_pairs(*bridge.plot_months(spark, d))).select("n", r6("mae"), r6("bias"), r6("max_abs"))


@query("a25_month_error", OBS + "SELECT month, CAST(count(diff) AS BIGINT) AS n, round(avg(abs_diff), 6) AS mae, round(avg(diff), 6) AS bias, round(max(abs_diff), 6) AS max_abs FROM pairs WHERE diff IS NOT NULL GROUP BY 1")
def a25(spark, d):
    return compare.error_of(compare.month_pairs(*bridge.plot_months(spark, d)), ["month"]).select("month", "n", r6("mae"), r6("bias"), r6("max_abs"))


@query("a26_plot_error", OBS + "SELECT plot_id, CAST(count(*) AS BIGINT) AS n_months, round(avg(abs_diff), 6) AS mean_abs, round(max(abs_diff), 6) AS max_abs FROM pairs WHERE diff IS NOT NULL GROUP BY 1")
def a26(spark, d):
    return compare.plot_error(compare.month_pairs(*bridge.plot_months(spark, d))).select("plot_id", "n_months", r6("mean_abs"), r6("max_abs"))


STATUS = "CASE WHEN l IS NOT NULL AND r IS NOT NULL THEN 'both' WHEN l IS NOT NULL THEN 'local_only' WHEN r IS NOT NULL THEN 'gee_only' ELSE 'none' END"


@query("p30_diff_status", OBS + f"SELECT plot_id, point_id, CAST(day AS VARCHAR) AS day, {STATUS} AS status FROM (SELECT plot_id, point_id, day, loc.v AS l, rem.v AS r FROM loc FULL JOIN rem USING (plot_id, point_id, day))")
def p30(spark, d):
    return compare.aligned(*bridge.sides(spark, d)).select("plot_id", "point_id", day_text(), compare.status(F.col("local"), F.col("remote")).alias("status"))


@query("a27_status_counts", OBS + f"SELECT {STATUS} AS status, CAST(count(*) AS BIGINT) AS n FROM (SELECT loc.v AS l, rem.v AS r FROM loc FULL JOIN rem USING (plot_id, point_id, day)) GROUP BY 1")
def a27(spark, d):
    return p30(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("p29_large_differences", OBS + "SELECT plot_id, point_id, CAST(day AS VARCHAR) AS day, round(abs_diff, 6) AS abs_diff FROM large")
def p29(spark, d):
    return compare.large_differences(*bridge.sides(spark, d)).select("plot_id", "point_id", day_text(), r6("abs_diff"))


# Order, sets, reshaping -------------------------------------------------------------------------


@query("o1_scene_order", "SELECT tile, scene_id, nth FROM (SELECT r_regionkey AS tile, CAST(r_regionkey * 4 + k AS BIGINT) AS scene_id, CAST(row_number() OVER (ORDER BY k * 31 + r_regionkey, r_regionkey) - 1 AS BIGINT) AS nth FROM region, (SELECT unnest(generate_series(0, 3)) AS k))")
def o1(spark, d):
    return order.numbered(bridge.scenes(spark, d), ["day", "tile"], "nth").select("tile", "scene_id", "nth")


@query("o3_topn_diff", OBS + "SELECT plot_id, month, round(abs_diff, 6) AS abs_diff FROM pairs WHERE diff IS NOT NULL ORDER BY round(abs_diff, 6) DESC, plot_id, month LIMIT 20")
def o3(spark, d):
    pairs = compare.month_pairs(*bridge.plot_months(spark, d), how="inner").select("plot_id", "month", r6("abs_diff"))
    return compare.largest(pairs, "abs_diff", 20, ["plot_id", "month"])


ARCHIVE = """
WITH f AS (SELECT o_orderkey AS k, strftime(DATE '2024-01-01' + CAST(o_orderkey % 730 AS INTEGER), '%Y%m%d') AS ymd, ['QQ', 'QR', 'RQ', 'RR'][o_orderkey % 4 + 1] AS q,
             CASE WHEN o_orderkey % 2 = 0 THEN 'OLD' ELSE 'NEW' END AS folder FROM orders),
s AS (SELECT *, '47P' || q AS tile, 'S2B_MSIL2A_' || ymd || 'T' || lpad(CAST(k % 240000 AS VARCHAR), 6, '0') || '_N' || k AS scene, strptime(ymd, '%Y%m%d')::DATE AS day
      FROM f WHERE k % 5 <> 0 AND k % 7 <> 0 AND k % 11 <> 0)
"""
_SPAN = (dt.date(2024, 1, 1), dt.date(2026, 12, 31))


def _archive(spark, d):
    paths = bridge.archive_paths(spark, d)
    return [archive.band_scenes(archive.scene_files(paths.filter(F.col("folder") == f), "B"), "08", *_SPAN) for f in (archive.OLD, archive.NEW)]


@query("s6_scene_catalog", ARCHIVE + "SELECT tile, scene, CAST(day AS VARCHAR) AS day FROM s")
def s6(spark, d):
    old, new = _archive(spark, d)
    return old.unionByName(new).select("tile", "scene", day_text())


@query("s7_tile_path", "SELECT o_orderkey, '47/P/' || ['QQ', 'QR'][o_orderkey % 2 + 1] AS path FROM orders")
def s7(spark, d):
    k = F.col("o_orderkey")
    return bridge.table(spark, d, "orders").select("o_orderkey", text.tile_path(F.when(k % 2 == 0, "47PQQ").otherwise("47PQR")).alias("path"))


@query("s8_overlay", ARCHIVE + "SELECT tile, CAST(day AS VARCHAR) AS day, folder, scene FROM s QUALIFY row_number() OVER (PARTITION BY tile, day ORDER BY folder = 'OLD', scene) = 1")
def s8(spark, d):
    return archive.overlay(*_archive(spark, d)).select("tile", day_text(), "folder", "scene")


@query("s9_cutoff_policy", ARCHIVE + "SELECT tile, scene, folder FROM s WHERE folder = CASE WHEN day < DATE '2025-07-01' THEN 'OLD' ELSE 'NEW' END")
def s9(spark, d):
    old, new = _archive(spark, d)
    both = old.withColumn("folder", F.lit(archive.OLD)).unionByName(new.withColumn("folder", F.lit(archive.NEW)))
    return archive.cutoff_only(both, dt.date(2025, 7, 1)).select("tile", "scene", "folder")


@query("s10_folder_check", ARCHIVE + "SELECT tile, scene, folder = CASE WHEN day < DATE '2025-07-01' THEN 'OLD' ELSE 'NEW' END AS folder_ok FROM s")
def s10(spark, d):
    old, new = _archive(spark, d)
    both = old.withColumn("folder", F.lit(archive.OLD)).unionByName(new.withColumn("folder", F.lit(archive.NEW)))
    return archive.with_folder_check(both, dt.date(2025, 7, 1)).select("tile", "scene", "folder_ok")


@query("s11_year_set", ARCHIVE + "SELECT tile, scene FROM s WHERE year(day) = 2025")
def s11(spark, d):
    old, new = _archive(spark, d)
    return archive.in_years(old.unionByName(new), 2025, 2025).select("tile", "scene")


@query("j4_band_merge", ARCHIVE + "SELECT tile, CAST(day AS VARCHAR) AS day, scene FROM s QUALIFY row_number() OVER (PARTITION BY tile, day ORDER BY folder = 'OLD', scene) = 1")
def j4(spark, d):
    one = archive.overlay(*_archive(spark, d))
    merged = archive.merged_bands(one, one.withColumn("band_path", F.replace(F.col("band_path"), F.lit("_B08_"), F.lit("_B04_"))))
    return merged.select("tile", day_text(), F.regexp_extract("mask_path", "/(S2[^/]+)/", 1).alias("scene"))


@query("o5_argmax_tile", ARCHIVE + "SELECT tile, CAST(count(*) AS BIGINT) AS n_scenes FROM s GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def o5(spark, d):
    old, new = _archive(spark, d)
    return archive.busiest_tile(old.unionByName(new))


@query("r20_pending_tiles", ARCHIVE + "SELECT DISTINCT tile FROM s WHERE tile NOT IN ('47PQQ')")
def r20(spark, d):
    old, new = _archive(spark, d)
    every = old.unionByName(new).select("tile").distinct()
    return archive.pending(every, every.filter("tile = '47PQQ'"))


@query("o6_stride_sample", "SELECT plot_id FROM (SELECT s_suppkey AS plot_id, row_number() OVER (ORDER BY s_suppkey) - 1 AS i, count(*) OVER () AS n FROM supplier) WHERE i % greatest(1, n // 6) = 0 AND i < greatest(1, n // 6) * 6")
def o6(spark, d):
    return compare.every_nth(bridge.boxes(spark, d), 6)


@query("o10_month_intersect", OBS + "SELECT month FROM pm1 WHERE v IS NOT NULL INTERSECT SELECT month FROM pm2 WHERE v IS NOT NULL")
def o10(spark, d):
    return compare.shared_months(*bridge.plot_months(spark, d))


@query("o11_month_union", OBS + "SELECT month FROM pm1 UNION SELECT month FROM pm2")
def o11(spark, d):
    return compare.all_months(*bridge.plot_months(spark, d))


@query("o12_removed_dates", OBS + "SELECT CAST(day AS VARCHAR) AS day FROM pd GROUP BY day HAVING NOT bool_and((lc > 0) = (rc > 0))")
def o12(spark, d):
    return compare.removed_days(*bridge.sides(spark, d)).select(day_text())


@query("o13_matched_dates", OBS + "SELECT CAST(day AS VARCHAR) AS day FROM pd GROUP BY day HAVING bool_and((lc > 0) = (rc > 0))")
def o13(spark, d):
    return compare.matched_days(*bridge.sides(spark, d)).select(day_text())


@query("o14_still_unmatched", OBS + """, matched AS (SELECT day FROM pd GROUP BY day HAVING bool_and((lc > 0) = (rc > 0)))
SELECT count(*) FILTER ((lc > 0) <> (rc > 0)) AS n_before, count(*) FILTER ((lc > 0) <> (rc > 0) AND day IN (SELECT day FROM matched)) AS n_after,
       count(*) FILTER (day IN (SELECT day FROM matched)) AS n_kept FROM pd""")
def o14(spark, d):
    """Plots' days that one source lacks, before the filter and after it, and the days that stay."""
    left, right = bridge.sides(spark, d)
    kept = compare.matched_only(left, right)
    counted = {
        "n_before": compare.unmatched_days(left, right),
        "n_after": compare.unmatched_days(*kept),
        "n_kept": kept[0].select("plot_id", "day").union(kept[1].select("plot_id", "day")).distinct(),
    }
    each = [rows.select(*(F.lit(int(name == n)).alias(n) for n in counted)) for name, rows in counted.items()]
    return each[0].union(each[1]).union(each[2]).agg(*(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in counted))


@query("o15_unmatched_report", OBS + "SELECT plot_id, CAST(day AS VARCHAR) AS day, CASE WHEN lc > 0 THEN 'local_only' ELSE 'gee_only' END AS status, CAST(lc AS BIGINT) AS local_valid_pts, CAST(rc AS BIGINT) AS gee_valid_pts, round(lm, 6) AS local_mean, round(rm, 6) AS gee_mean FROM pd WHERE (lc > 0) <> (rc > 0)")
def o15(spark, d):
    return compare.unmatched_days(*bridge.sides(spark, d)).select("plot_id", day_text(), "status", "local_valid_pts", "gee_valid_pts", r6("local_mean"), r6("gee_mean"))


ONE = ", p AS (SELECT plot_id, point_id, month, arg_min(mean, tile_no) FILTER (mean IS NOT NULL) AS m FROM stats GROUP BY 1, 2, 3)"


def _wide(spark, d):
    """The wide table of means and its months: those of all scenes, cloudy ones included, as in a run."""
    days = bridge.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    months = sorted(r["month"] for r in monthly.months(days).collect())
    return monthly.wide(monthly.across_tiles(_stats(spark, d), "tile_no"), "mean", months), months


EVERY = ONE + ", k AS (SELECT DISTINCT strftime(day, '%Y-%m') AS month FROM obs), f AS (SELECT plot_id, point_id, k.month, p.m FROM (SELECT DISTINCT plot_id, point_id FROM p) CROSS JOIN k LEFT JOIN p USING (plot_id, point_id, month))"


@query("o17_pivot", OBS + EVERY + """ SELECT plot_id, point_id, count(*) AS n_months, string_agg(month, ',' ORDER BY month) AS months,
string_agg(coalesce(CAST(CAST(floor(m * CAST(1000000 AS DOUBLE) + CAST(0.5001 AS DOUBLE)) AS BIGINT) AS VARCHAR), '-'), ',' ORDER BY month) AS millionths FROM f GROUP BY 1, 2""")
def o17(spark, d):
    """A row of the wide table, its columns in order: their names, and their values in millionths."""
    table, months = _wide(spark, d)
    values = [F.coalesce(F.floor(F.col(f"`{m}`") * F.lit(1e6) + F.lit(0.5001)).cast("string"), F.lit("-")) for m in months]
    return table.select("plot_id", "point_id", F.lit(len(months)).cast("long").alias("n_months"), F.lit(",".join(months)).alias("months"), F.concat_ws(",", *values).alias("millionths"))


@query("o16_unpivot", OBS + EVERY + " SELECT plot_id, point_id, month, round(m, 6) AS ndvi FROM f")
def o16(spark, d):
    return monthly.long(*_wide(spark, d)).select("plot_id", "point_id", "month", r6("ndvi"))


@query("o9_union_months", OBS + """, s AS (SELECT tile_no, plot_id, point_id, month, mean FROM stats WHERE tile_no IN (0, 1) AND (tile_no = 0) = (month < '1996-07')),
k AS (SELECT DISTINCT month FROM s), f AS (SELECT tile_no, plot_id, point_id, k.month, s.mean FROM (SELECT DISTINCT tile_no, plot_id, point_id FROM s) CROSS JOIN k LEFT JOIN s USING (tile_no, plot_id, point_id, month))
SELECT tile_no, plot_id, point_id, string_agg(month, ',' ORDER BY month) AS months,
string_agg(coalesce(CAST(CAST(floor(mean * CAST(1000000 AS DOUBLE) + CAST(0.5001 AS DOUBLE)) AS BIGINT) AS VARCHAR), '-'), ',' ORDER BY month) AS millionths FROM f GROUP BY 1, 2, 3""")
def o9(spark, d):
    """Two written wide tables, one a tile, of other months each, as one; its rows as in o17."""
    path, paths = files.folder(spark, "wide"), []
    stats = _stats(spark, d).filter("tile_no IN (0, 1) AND (tile_no = 0) = (month < '1996-07')")
    for tile in (0, 1):
        own = stats.filter(F.col("tile_no") == tile)
        months = sorted(r["month"] for r in own.select("month").distinct().collect())
        paths.append(f"{path}/tile{tile}.parquet")
        monthly.wide(own, "mean", months, keys=["tile_no", *monthly.POINT]).write.parquet(paths[-1])
    table = tables.wide_tables(spark, paths)
    names = text.month_columns(table.columns)
    values = [F.coalesce(F.floor(F.col(f"`{m}`") * F.lit(1e6) + F.lit(0.5001)).cast("string"), F.lit("-")) for m in names]
    return table.select("tile_no", "plot_id", "point_id", F.lit(",".join(names)).alias("months"), F.concat_ws(",", *values).alias("millionths"))


@query("o18_plot_matrix", OBS + "SELECT plot_id, CAST(day AS VARCHAR) AS day, string_agg(CAST(point_id AS VARCHAR), ',' ORDER BY point_id) AS points, round(sum(v * (point_id + 1)), 6) AS mixed FROM loc GROUP BY 1, 2")
def o18(spark, d):
    rows = monthly.plot_matrix(bridge.sides(spark, d)[0], "v")
    mixed = F.aggregate(F.zip_with("values", "points", lambda v, p: v * (p + 1)), F.lit(0.0), lambda s, x: s + x)
    return rows.select("plot_id", day_text(), F.array_join(F.col("points").cast("array<string>"), ",").alias("points"), r6(mixed, "mixed"))


@query("o19_plot_ready", OBS + "SELECT plot_id, month, round(v, 6) AS v FROM pm1 WHERE v IS NOT NULL QUALIFY count(*) OVER (PARTITION BY plot_id) >= 2")
def o19(spark, d):
    return compare.plot_ready(bridge.plot_months(spark, d)[0], "v", ["plot_id"]).select("plot_id", "month", r6("v"))


# Text, dates, streaming -------------------------------------------------------------------------


@query("f3_dates", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate, '%Y-%m-01') AS first FROM orders")
def f3(spark, d):
    named = bridge.table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy/MM/dd").alias("name"))
    day = text.parsed_day(F.col("name"))
    return named.select("o_orderkey", day.cast("string").alias("day"), text.month_of(day).alias("month"), text.month_start(day).cast("string").alias("first"))


@query("f10_month_format", "SELECT o_orderkey, o_orderkey % 3 = 0 AS is_month FROM orders")
def f10(spark, d):
    k = F.col("o_orderkey")
    name = F.date_format("o_orderdate", "yyyy-MM")
    name = F.when(k % 3 == 1, F.concat(name, F.lit("-01"))).when(k % 3 == 2, F.replace(name, F.lit("-"), F.lit("/"))).otherwise(name)
    return bridge.table(spark, d, "orders").select("o_orderkey", text.is_month_name(name).alias("is_month"))


@query("f6_stem_normalise", "SELECT c_custkey, upper(replace(c_name, ' ', '_')) AS stem FROM (SELECT c_custkey, regexp_replace(c_name, '#[0-9]*', '') AS c_name FROM customer)")
def f6(spark, d):
    name = F.concat(F.regexp_replace("c_name", "#[0-9]*", ""), F.lit("_grid 2.parquet"))
    return bridge.table(spark, d, "customer").select("c_custkey", text.grid_stem(name).alias("stem"))


@query("f8_file_plot_id", "SELECT c_custkey, c_custkey AS plot_id FROM customer")
def f8(spark, d):
    path = F.concat(F.lit("/x/plot_"), F.col("c_custkey"), F.lit(".parquet"))
    return bridge.table(spark, d, "customer").select("c_custkey", text.file_plot_id(path).alias("plot_id"))


@query("s19_plot_files", OBS + """, top AS (SELECT tile_no, plot_id, point_id, strftime(day, '%Y-%m') AS month, max(v) AS v FROM ndvi GROUP BY 1, 2, 3, 4),
f AS (SELECT tile_no, plot_id, month, avg(v) AS v FROM top GROUP BY 1, 2, 3) SELECT plot_id, month, round(max(v), 6) AS v FROM f GROUP BY 1, 2""")
def s19(spark, d):
    """Monthly values of plots from a folder with a file a plot and tile, each with columns of its own days."""
    path = files.folder(spark, "plots")
    files.write_plot_files(bridge.observations(spark, d), path)
    return tables.plot_file_months(spark, path).select("plot_id", "month", r6("v"))


@query("st1_windowed_scenes", OBS + "SELECT plot_id, strftime(make_timestamp(CAST(floor(epoch(day) / 2592000) AS BIGINT) * 2592000000000), '%Y-%m-%d') AS window_start, round(avg(v), 6) AS mean, round(min(v), 6) AS min, round(max(v), 6) AS max, CAST(count(v) AS BIGINT) AS n FROM ndvi WHERE v IS NOT NULL GROUP BY 1, 2")
def st1(spark, d):
    """The streaming aggregation over the whole table at once; tests run it as a stream."""
    seen = bridge.observations(spark, d).select("plot_id", F.col("day").cast("timestamp_ntz").alias("ts"), F.col("v").alias("ndvi"))
    return streaming.windowed(seen).select("plot_id", F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), r6("mean"), r6("min"), r6("max"), "n")
