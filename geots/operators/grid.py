"""Land-plot polygons to sampling points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import crs, geometry, repair, text, wkb
from .order import numbered

CORNER, CENTRE, SNAPPED = "corner", "centre", "snapped"
LINES, POINTS = 64, 65_536  # of a band of scan lines


def with_default_id(plots: DataFrame, order: list[str], id_col: str = "plot_id") -> DataFrame:
    """``plots`` with ids 0, 1, ... in the order of ``order`` columns, unless it has an id column.

    The columns together must be unique; see ``order.numbered``.
    """
    return plots if id_col in plots.columns else numbered(plots, order, id_col)


def polygons(plots: DataFrame, geom: str = "geometry") -> DataFrame:
    """``plots`` with ``parts`` for the geometry column, made valid; rows without area go.

    Null geometries go first, then empty ones. ``valid`` tells whether the repair has come to an end.
    Rows are dealt to tasks before: a table of many polygons may come in one small file.
    """
    # Not deterministic for the planner, who would else repair a row again for each use of the result.
    repaired = repair.decoded_valid.asNondeterministic()(F.col(geom))
    dealt = plots.filter(F.col(geom).isNotNull()).repartition(int(plots.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kept = dealt.withColumn("__repaired", repaired)
    found = kept.withColumns({"parts": F.col("__repaired.parts"), "valid": F.col("__repaired.valid")}).drop("__repaired")
    return found.filter(F.size("parts") > 0)


def utm_zone(plots: DataFrame, boundary: float = 102.0) -> DataFrame:
    """(mean_lon, epsg): one row; by ``centroid_x`` where it has values, else by points inside."""
    lon = F.avg(geometry.representative_point(F.col("parts"))["x"])
    if "centroid_x" in plots.columns:
        lon = F.coalesce(F.avg(F.nanvl(F.col("centroid_x").cast("double"), F.lit(None).cast("double"))), lon)
    return plots.agg(lon.alias("mean_lon")).withColumn("epsg", crs.zone_of(F.col("mean_lon"), boundary))


def axis(low: Column, high: Column, spacing: float, start: str = SNAPPED) -> Column:
    """Grid positions from ``low`` up to, not including, ``high``."""
    first = first_centre(low, spacing, start)
    n = F.ceil((high - first) / spacing)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda k: first + k * F.lit(float(spacing)))).otherwise(F.array().cast("array<double>"))


def first_centre(low: Column, spacing: float, start: str = SNAPPED) -> Column:
    """Where an axis begins: at the bound, half a step on, or half a step on from its snapped value."""
    if start == CORNER:
        return low
    if start == CENTRE:
        return low + spacing / 2
    return snapped(low, spacing) + spacing / 2


def snapped(v: Column, spacing: float) -> Column:
    return F.floor(v / spacing) * F.lit(float(spacing))


def _bands(rings: Column, spacing: float, start: str) -> Column:
    """The scan lines of a polygon in bands: for each (band, x0, low, lines, edges that its lines meet).

    A band has at most LINES lines, and fewer in a wide polygon: its bounds hold about POINTS points.
    """
    step = F.lit(float(spacing))

    def measured(s: Column) -> Column:
        lines = F.greatest(F.ceil((s["b"]["ymax"] - s["y0"]) / spacing), F.lit(0).cast("long"))
        fitting = F.floor(POINTS * spacing / F.greatest(s["b"]["xmax"] - s["b"]["xmin"], step))
        tall = F.greatest(F.least(F.lit(LINES).cast("long"), fitting), F.lit(1).cast("long"))
        return F.struct(s["every"].alias("every"), s["x0"].alias("x0"), s["y0"].alias("y0"), lines.alias("lines"), tall.alias("tall"))

    def cut(s: Column) -> Column:
        def band(k: Column) -> Column:
            low = s["y0"] + k * s["tall"] * step
            n = F.least(s["tall"], s["lines"] - k * s["tall"])
            top = low + n * step  # a line's height more than needed, against rounding
            own = F.filter(s["every"], lambda e: (F.greatest(e["y1"], e["y2"]) >= low) & (F.least(e["y1"], e["y2"]) <= top))
            return F.struct(k.alias("band"), s["x0"].alias("x0"), low.alias("low"), n.alias("lines"), own.alias("edges"))

        numbers = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(s["lines"] / s["tall"]), F.lit(1).cast("long")) - 1)
        return F.transform(F.filter(numbers, lambda k: s["lines"] > 0), band)

    def bounded(b: Column) -> Column:
        return F.struct(
            geometry.polygon_edges(rings).alias("every"), b.alias("b"), first_centre(b["xmin"], spacing, start).alias("x0"), first_centre(b["ymin"], spacing, start).alias("y0")
        )

    known = geometry.given(geometry.bounds(F.flatten(rings)), bounded)
    return geometry.given(geometry.given(known, measured), cut)


def _points(spacing: float) -> Column:
    """A band's points (x, y): by line, then x."""

    def line(j: Column) -> Column:
        y = F.col("low") + j * F.lit(float(spacing))
        return F.transform(geometry.row_centres(F.col("edges"), y, F.col("x0"), spacing), lambda x: F.struct(x.alias("x"), y.alias("y")))

    return F.flatten(F.transform(F.sequence(F.lit(0).cast("long"), F.col("lines") - 1), line))


def grid(plots: DataFrame, key: str = "plot_id", spacing: float = 10, start: str = SNAPPED) -> DataFrame:
    """(key, point_id, x, y): grid points strictly inside each plot's ``parts`` (metres).

    Points are numbered from 0 within a row of ``plots``: by part, then y, then x. A plot that holds
    no grid point has no row. The scan lines of a part are cut into bands, each with the edges
    that its lines meet. A plot of one band is numbered where it stands. The bands of other plots
    are dealt to tasks, so that one huge plot keeps many of them busy; the bands' sizes alone are
    summed along the plot, and come back to the bands by a join on the same partitioning.
    """
    whole = plots.select(F.col(key).alias("id"), F.transform("parts", lambda rings: _bands(rings, spacing, start)).alias("bands"), F.xxhash64("parts").alias("shape"))
    total = F.aggregate("bands", F.lit(0), lambda n, b: n + F.size(b))
    parts = whole.select("id", "shape", total.alias("total"), F.posexplode("bands").alias("part", "bands"))
    rows = parts.select("id", "shape", "total", "part", F.explode("bands").alias("b")).select("id", "shape", "total", "part", "b.*")
    alone = rows.filter("total = 1").select("id", F.lit(0).cast("long").alias("before"), F.posexplode(_points(spacing)).alias("nth", "p"))
    # A number of partitions is named, as these small rows would else be put together that become many.
    place = ["shape", "part", "band"]
    dealt = rows.filter("total > 1").drop("total").repartition(int(plots.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id", *place)
    sizes = dealt.select("id", *place, F.size(_points(spacing)).alias("n")).dropDuplicates(["id", *place])
    earlier = Window.partitionBy("id", "shape").orderBy("part", "band").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("id").alias("own"), *place, F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("long").alias("before"))
    joined = dealt.join(offsets.withColumnsRenamed({c: f"{c}_" for c in place}), F.col("id").eqNullSafe(F.col("own")) & (F.col("shape") == F.col("shape_")) & (F.col("part") == F.col("part_")) & (F.col("band") == F.col("band_")))
    several = joined.select("id", "before", F.posexplode(_points(spacing)).alias("nth", "p"))
    return alone.unionByName(several).select(F.col("id").alias(key), (F.col("before") + F.col("nth")).cast("long").alias("point_id"), "p.x", "p.y")


def province_grid(points: DataFrame, province: str, epsg: int | Column) -> DataFrame:
    """The grid table: ids, projected and geographic coordinates, and the point's bytes (projected)."""
    uid = text.plot_uid(province, F.col("plot_id"))
    lon, lat = crs.to_lonlat(F.col("x"), F.col("y"), epsg)
    return points.select(
        F.lit(province).alias("province"),
        "plot_id",
        uid.alias("plot_uid"),
        "point_id",
        text.feature_id(uid, F.col("x"), F.col("y")).alias("feature_id"),
        F.col("x").alias("x_utm"),
        F.col("y").alias("y_utm"),
        lon.alias("lon"),
        lat.alias("lat"),
        wkb.point_wkb("x", "y").alias("geometry"),
    )


def build(plots: DataFrame, province: str, epsg: int, spacing: float = 10) -> DataFrame:
    """Polygons in degrees (``parts``) to the province's grid table."""
    metres = plots.withColumn("parts", crs.reprojected(F.col("parts"), epsg))
    return province_grid(grid(metres, spacing=spacing), province, epsg)


def point_master(points: DataFrame) -> DataFrame:
    """(plot_id, point_id, x, y, lat, lon, geometry) with geographic x and y."""
    return points.select("plot_id", "point_id", F.col("lon").alias("x"), F.col("lat").alias("y"), "lat", "lon", wkb.point_wkb("lon", "lat").alias("geometry"))
