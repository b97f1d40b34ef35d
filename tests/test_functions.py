"""Column expressions on hand-computed cases."""

import datetime as dt
import math
import random
import struct
import time

import pytest
from geots.config import Config
from geots.functions import crs, geometry, raster, text, wkb
from pyspark.sql import functions as F

CUTOFF = dt.date(2022, 1, 25)


def one(spark, *columns):
    row = spark.range(1).select(*columns).first()
    return row[0] if len(columns) == 1 else tuple(row)


@pytest.mark.parametrize(
    "nir,red,day,want",
    [
        (3000, 1000, dt.date(2021, 6, 1), 0.5),
        (3000, 1000, dt.date(2022, 1, 25), 0.5),
        (3000, 1500, dt.date(2022, 1, 26), 0.6),
        (1000, 1000, dt.date(2022, 1, 26), None),
        (950, 1100, dt.date(2022, 1, 26), -3.0),
        (0, 500, dt.date(2021, 1, 1), None),
        (500, 65535, dt.date(2021, 1, 1), None),
        (None, 500, dt.date(2021, 1, 1), None),
    ],
)
def test_index(spark, nir, red, day, want):
    value = raster.ndvi(F.lit(nir).cast("int"), F.lit(red).cast("int"), F.lit(day), CUTOFF, 1000, (0, 65535))
    got = one(spark, value)
    assert got is None if want is None else abs(got - want) < 1e-12


def test_pixels(spark):
    at = [F.lit(v) for v in (99.7, 98.3, 100.0, 109.9)]
    origin, step = F.lit(100.0), F.lit(1.0)
    assert one(spark, *(raster.pixel_trunc(v, origin, step) for v in at)) == (0, -1, 0, 9)
    assert one(spark, *(raster.pixel_floor(v, origin, step) for v in at)) == (-1, -2, 0, 9)
    assert one(spark, raster.clamp(F.lit(-1), F.lit(10)), raster.clamp(F.lit(12), F.lit(10))) == (0, 9)
    assert one(spark, raster.no_data(F.lit(5), F.lit(5)), raster.no_data(F.lit(5), F.lit(None).cast("int"))) == (None, 5)


def test_projection_control_points(spark):
    """The meridian's arc to 45 degrees, the equator, and symmetry about the central meridian."""
    x, y = crs.to_utm(F.lit(99.0), F.lit(45.0), 32647)
    assert one(spark, x) == pytest.approx(500000, abs=1e-6)
    assert one(spark, y) == pytest.approx(0.9996 * 4984944.378, abs=1e-3)
    east, west = (one(spark, *crs.to_utm(F.lit(99.0 + d), F.lit(13.7), 32647)) for d in (1.3, -1.3))
    assert east[0] - 500000 == pytest.approx(500000 - west[0], abs=1e-6) and east[1] == pytest.approx(west[1], abs=1e-6)
    # Quarter of the equator in the sphere's limit: x grows with the scale of the ellipsoid.
    assert one(spark, crs.to_utm(F.lit(99.001), F.lit(0.0), 32647)[0]) - 500000 == pytest.approx(0.9996 * 6378137 * math.radians(0.001), abs=1e-4)


def test_projection_round_trip(spark):
    df = spark.range(2000).select((96 + F.col("id") % 60 / 10.0).alias("lon"), (-20 + F.col("id") / 40.0).alias("lat"))
    for epsg in (32647, 32648, 32747):
        x, y = crs.to_utm(F.col("lon"), F.col("lat"), epsg)
        back = df.select("lon", "lat", x.alias("x"), y.alias("y"))
        lon, lat = crs.to_lonlat(F.col("x"), F.col("y"), epsg)
        worst = back.select(F.max(F.abs(lon - F.col("lon"))), F.max(F.abs(lat - F.col("lat")))).first()
        assert max(worst) < 1e-9


def test_zone(spark):
    assert one(spark, crs.zone_of(F.lit(101.99)), crs.zone_of(F.lit(102.0))) == (32647, 32648)


SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
HOLE = [(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)]


def parts(*polygons):
    return F.lit(1).isNotNull() & False if not polygons else F.array(*(F.array(*(F.array(*(geometry.point(F.lit(float(x)), F.lit(float(y))) for x, y in ring)) for ring in rings)) for rings in polygons))


@pytest.mark.parametrize("x,y,want", [(5, 2, True), (5, 5, False), (4, 5, False), (0, 5, False), (5, 10, False), (10, 10, False), (11, 5, False), (1, 4, True), (3, 6, True), (6, 6, False)])
def test_point_in_polygon(spark, x, y, want):
    assert one(spark, geometry.in_polygon(geometry.edges(parts([SQUARE, HOLE])), F.lit(float(x)), F.lit(float(y)))) is want


def test_area_centroid_bounds(spark):
    p = parts([SQUARE, HOLE], [[(20, 0), (24, 0), (24, 4), (20, 4), (20, 0)]])
    c = one(spark, geometry.centroid(p))
    assert one(spark, geometry.area(p)) == 112
    assert (c["x"], c["y"]) == (pytest.approx((96 * 5 + 16 * 22) / 112), pytest.approx((96 * 5 + 16 * 2) / 112))
    assert tuple(one(spark, geometry.bounds(geometry.vertices(p)))) == (0, 0, 24, 10)


def test_representative_point_is_inside(spark):
    ring = [(0, 0), (10, 0), (10, 10), (9, 10), (9, 1), (1, 1), (1, 10), (0, 10), (0, 0)]
    p = one(spark, geometry.representative_point(parts([ring])))
    assert one(spark, geometry.in_polygon(geometry.edges(parts([ring])), F.lit(p["x"]), F.lit(p["y"])))


def test_simple_polygons_are_those_without_crossings(spark):
    rng = random.Random(12)

    def side(a, b, c):
        return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    def simple(ring):
        es = list(zip(ring, ring[1:]))
        return not any(side(*e, f[0]) * side(*e, f[1]) < 0 and side(*f, e[0]) * side(*f, e[1]) < 0 for e in es for f in es)

    rings = []
    for i in range(60):
        ring = [(math.cos(t * 0.5) * rng.uniform(3, 5), math.sin(t * 0.5) * rng.uniform(3, 5) if i % 3 else 0.0) for t in range(12)]
        if i % 2:  # two vertices swapped
            j, k = rng.sample(range(12), 2)
            ring[j], ring[k] = ring[k], ring[j]
        rings.append([*ring, ring[0]])
    df = spark.createDataFrame([(i, [[(float(x), float(y)) for x, y in r]]) for i, r in enumerate(rings)], "i int, rings array<array<struct<x: double, y: double>>>")
    got = {r["i"]: r["s"] for r in df.select("i", geometry.is_simple_polygon(F.col("rings")).alias("s")).collect()}
    assert got == {i: simple(r) for i, r in enumerate(rings)} and 10 < sum(got.values()) < 50
    n = 4000
    round_ = F.transform(F.sequence(F.lit(0), F.lit(n)), lambda k: geometry.point(F.cos((k % n) * (2 * math.pi / n)), F.sin((k % n) * (2 * math.pi / n))))
    began = time.perf_counter()
    assert spark.range(1).select(geometry.is_simple_polygon(F.array(round_))).first()[0]
    assert time.perf_counter() - began < 30


def test_repair(spark):
    messy = parts([[(0, 0), (0, 0), (10, 0), (10, 10), (0, 10)], [(1, 1), (2, 2), (1, 1)]], [[(5, 5), (6, 6), (5, 5)]])
    fixed = one(spark, geometry.repaired(messy))
    assert [[[tuple(v) for v in r] for r in p] for p in fixed] == [[[(float(x), float(y)) for x, y in SQUARE]]]
    bow = [(0, 0), (10, 10), (10, 0), (0, 10), (0, 0)]
    assert one(spark, geometry.is_simple_polygon(parts([bow])[0])) is False
    assert one(spark, geometry.is_simple_polygon(parts([SQUARE, HOLE])[0])) is True


@pytest.mark.parametrize("move,want", [((20, 0), False), ((10, 0), True), ((10, 10), True), ((5, 5), True), ((2, 2), True), ((4.5, 4.5), True)])
def test_intersects(spark, move, want):
    small = [(move[0] + x, move[1] + y) for x, y in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]
    assert one(spark, geometry.intersects(parts([SQUARE]), parts([small]))) is want


def test_inside_a_hole_is_apart(spark):
    small = [(4.5, 4.5), (5.5, 4.5), (5.5, 5.5), (4.5, 5.5), (4.5, 4.5)]
    assert one(spark, geometry.intersects(parts([SQUARE, HOLE]), parts([small]))) is False


def test_a_second_part_inside_counts(spark):
    far = [(50, 50), (51, 50), (51, 51), (50, 51), (50, 50)]
    small = [(2, 2), (3, 2), (3, 3), (2, 3), (2, 2)]
    assert one(spark, geometry.intersects(parts([far], [small]), parts([SQUARE]))) is True
    assert one(spark, geometry.intersects(parts([SQUARE]), parts([far], [small]))) is True


def test_wkb():
    def ring(points):
        return struct.pack("<I", len(points)) + b"".join(struct.pack("<dd", *p) for p in points)

    polygon = struct.pack("<BII", 1, 3, 2) + ring(SQUARE) + ring(HOLE)
    point = struct.pack("<BI", 1, 1) + struct.pack("<dd", 1, 2)
    many = struct.pack("<BII", 1, 6, 2) + polygon * 2
    collection = struct.pack("<BII", 1, 7, 3) + point + many + polygon
    assert [len(wkb.polygons_of(x)) for x in (polygon, point, many, collection)] == [1, 0, 2, 3]
    big = struct.pack(">BII", 0, 0x20000003, 4326) + struct.pack(">II", 1, 4) + b"".join(struct.pack(">dd", *p) for p in SQUARE[:4])
    assert [tuple(v.values()) for v in wkb.polygons_of(big)[0][0]] == [tuple(map(float, p)) for p in SQUARE[:4]]
    assert wkb.polygons_of(wkb.polygon_bytes(wkb.polygons_of(many))) == wkb.polygons_of(many)
    assert wkb.polygons_of(None) is None
    with pytest.raises(ValueError):
        wkb.polygons_of(struct.pack("<BI", 1, 99))


def test_point_bytes(spark):
    got = spark.createDataFrame([(1.5, 2.0), (None, 2.0)], "x double, y double").select(wkb.point_wkb("x", "y").alias("g")).collect()
    assert bytes(got[0]["g"]) == struct.pack("<BIdd", 1, 1, 1.5, 2.0) and got[1]["g"] is None


def test_names(spark):
    uid = text.plot_uid("RAYONG", F.lit(1))
    assert one(spark, uid, text.feature_id(uid, F.lit(10.0), F.lit(20.0))) == ("RAYONG_1", "df07290cf7b369c6514a7d505c5a244a")
    assert one(spark, text.tile_path(F.lit("47PQQ"))) == "47/P/QQ"
    assert one(spark, text.scene_date(F.lit("/a/T47PQQ_20240131T03_B08_10m.jp2")), text.scene_date(F.lit("/a/T47PQQ_2024x131"))) == (dt.date(2024, 1, 31), None)
    assert one(spark, text.parsed_day(F.lit("2024/02/30")), text.month_start(F.lit(dt.date(2024, 2, 9)))) == (None, dt.date(2024, 2, 1))
    assert one(spark, text.grid_stem(F.lit("trat grid 2.parquet")), text.polygon_stem(F.lit("/x/trat a.gpkg"))) == ("TRAT", "TRAT_A")
    assert text.grid_for("/p/trat.gpkg", ["TRAT_OTHER.parquet", "TRAT_grid.parquet", "x.csv"]) == "TRAT_grid.parquet"
    assert text.grid_for("/p/trat.gpkg", ["RAYONG_grid.parquet"]) is None
    assert text.month_columns(["b", "2024-02", "2024-01"]) == ["2024-01", "2024-02"]
    report = text.month_columns_report(["2024-02", "2024-01", "2024-01", "x"])
    assert (report["sorted"], report["well_formed"], report["repeated"]) == (False, False, ["2024-01"])
    assert text.resolved("/fs7/a", {"/fs7": "/mnt/7"}, lambda p: p == "/mnt/7/a") == "/mnt/7/a"


def test_config():
    with pytest.raises(ValueError, match="OUTPUT_DIR"):
        Config.from_env({"PROVINCE": "x", "GOLDEN_DURIAN_PATH": "y"})
    got = Config.from_env({"PROVINCE": "trat", "GOLDEN_DURIAN_PATH": "p", "OUTPUT_DIR": "o", "YEAR_START": "2020", "DATE_END": "2021-05-06", "FORCE_REBUILD_POINTS": "1"})
    assert (got.province, got.date_start, got.date_end, got.rebuild_points) == ("TRAT", dt.date(2020, 1, 1), dt.date(2021, 5, 6), True)
