"""Operators on small tables, and whole runs through files."""

import datetime as dt
import json
import math
import random
import sqlite3
import struct

import numpy as np
import pyarrow.parquet as pq
import pytest
from geots.config import Config
from geots.functions import crs, geometry, wkb
from geots.operators import compare, grid, monthly, order, sampling, spatial
from geots.plans import run
from geots.sources import archive, sinks, tables
from geots.streaming import scenes as streaming
from pyspark.sql import functions as F

DAY = dt.date(2021, 1, 5)


def ring_column(points):
    return F.array(*(geometry.point(F.lit(float(x)), F.lit(float(y))) for x, y in points))


def star(rng, n=9, size=60.0):
    """A random star-shaped ring: simple, not convex."""
    at = [(rng.uniform(0.3, 1) * size, 2 * math.pi * k / n) for k in range(n)]
    pts = [(100 + r * math.cos(a), 200 + r * math.sin(a)) for r, a in at]
    return [*pts, pts[0]]


def inside(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 <= y) != (y2 <= y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x:
            odd = not odd
    return odd


def test_grid_of_random_polygons(spark):
    rng = random.Random(1)
    rings = {i: star(rng) for i in range(25)}
    df = spark.createDataFrame([(i, [[[{"x": x, "y": y} for x, y in r]]]) for i, r in rings.items()], "plot_id long, parts array<array<array<struct<x:double,y:double>>>>")
    got: dict = {}
    for r in grid.grid(df).collect():
        got.setdefault(r["plot_id"], []).append((r["point_id"], r["y"], r["x"]))
    for i, ring in rings.items():
        want = sorted((y + 5, x + 5) for x in range(0, 300, 10) for y in range(0, 400, 10) if inside(ring, x + 5, y + 5))
        assert sorted(got.get(i, [])) == [(n, *p) for n, p in enumerate(want)]


def test_edges_on_grid_lines_are_outside(spark):
    box = spark.range(1).select(F.lit(1).alias("plot_id"), F.array(F.array(ring_column([(5, 5), (25, 5), (25, 25), (5, 25), (5, 5)]))).alias("parts"))
    assert [(r["x"], r["y"]) for r in grid.grid(box).collect()] == [(15, 15)]
    thin = spark.range(1).select(F.lit(1).alias("plot_id"), F.array(F.array(ring_column([(6, 6), (9, 6), (9, 9), (6, 9), (6, 6)]))).alias("parts"))
    assert grid.grid(thin).count() == 0


def test_numbers_run_on_over_bands_and_parts(spark, monkeypatch):
    monkeypatch.setattr(grid, "LINES", 2)
    rng = random.Random(8)
    plots = {i: [star(rng, 7), [(x + 500 * (i % 3), y) for x, y in star(rng, 5)]] for i in range(12)}
    rows = [(None if i == 5 else i, [[[{"x": x, "y": y} for x, y in r]] for r in rings]) for i, rings in plots.items()]
    df = spark.createDataFrame([*rows, rows[3], (4, rows[6][1])], "plot_id long, parts array<array<array<struct<x:double,y:double>>>>")
    got: dict = {}
    for r in grid.grid(df).collect():
        got.setdefault(r["plot_id"], []).append((r["point_id"], r["x"], r["y"]))
    for i, rings in plots.items():
        want = [(x + 5, y + 5) for ring in rings for y in range(0, 400, 10) for x in range(0, 1600, 10) if inside(ring, x + 5, y + 5)]
        numbered = [(n, *p) for n, p in enumerate(want)]
        again = {3: numbered, 4: [(n, *p) for n, p in enumerate([(x + 5, y + 5) for ring in plots[6] for y in range(0, 400, 10) for x in range(0, 1600, 10) if inside(ring, x + 5, y + 5)])]}
        assert sorted(got.get(None if i == 5 else i, [])) == sorted(numbered + again.get(i, []))


def test_one_huge_plot_is_made_by_many_tasks(spark):
    """Half a million scan lines: bands in all partitions, and only their sizes in the task that sums."""
    ring = ring_column([(0, 0), (30, 0), (30, 5_000_000), (0, 5_000_000), (0, 0)])
    made = grid.grid(spark.range(1).select(F.col("id").alias("plot_id"), F.array(F.array(ring)).alias("parts")))
    spread = made.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.min("point_id").alias("a"), F.max("point_id").alias("b")).collect()
    n = sum(r["n"] for r in spread)
    assert n == 1_500_000 and min(r["a"] for r in spread) == 0 and max(r["b"] for r in spread) == n - 1
    assert len([r for r in spread if r["n"] > n / 16]) == 4  # of the session's four partitions
    assert made.select("point_id").distinct().count() == n


def test_axis(spark):
    def axis(low, high, start=grid.SNAPPED):
        return spark.range(1).select(grid.axis(F.lit(float(low)), F.lit(float(high)), 10, start)).first()[0]

    assert axis(12, 40) == [15, 25, 35] and axis(12, 35) == [15, 25] and axis(12, 15) == []
    assert axis(12, 40, grid.CORNER) == [12, 22, 32] and axis(12, 40, grid.CENTRE) == [17, 27, 37]


def test_numbering_and_totals(spark):
    df = spark.range(0, 1000, 7).withColumn("k", F.col("id") * 31 % 1009)
    got = [(r["nth"], r["k"]) for r in order.numbered(df, ["k"], "nth").orderBy("nth").collect()]
    assert [g[0] for g in got] == list(range(len(got))) and [g[1] for g in got] == sorted(g[1] for g in got)
    totals = order.running_total(df.select("k", F.lit(2).alias("v")), "k", "v", "s").orderBy("k").collect()
    assert [r["s"] for r in totals] == [2 * (i + 1) for i in range(len(got))]
    assert order.numbered(df.limit(0), ["k"], "nth").count() == 0


def test_tiles_join_is_brute_force(spark):
    rng = random.Random(4)
    boxes = {s: [(i, rng.uniform(-50, 50), rng.uniform(-50, 50), rng.uniform(1, 30), rng.uniform(1, 30)) for i in range(60)] for s in "ab"}

    def df(side):
        return spark.createDataFrame(boxes[side], f"{side} long, x double, y double, w double, h double").select(
            side, F.array(F.array(geometry.rectangle(F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h")))).alias("parts")
        )

    want = sorted((i, j) for i, x, y, w, h in boxes["a"] for j, u, v, p, q in boxes["b"] if x <= u + p and u <= x + w and y <= v + q and v <= y + h)
    got = sorted(tuple(r) for r in spatial.intersecting(df("a"), df("b"), "a", "b", 7.0).collect())
    assert got == want


def test_one_huge_box_beside_many_small_ones_costs_rows_in_proportion(spark):
    n = 20_000
    small = spark.range(n).select(F.col("id").alias("a"), (F.col("id") % 200 * 5.0).alias("x"), (F.floor(F.col("id") / 200) * 5.0).alias("y"))
    small = small.select("a", F.array(F.array(geometry.rectangle(F.col("x") + 1, F.col("y") + 1, F.col("x") + 2, F.col("y") + 2))).alias("parts"))
    big = spark.createDataFrame([(0, -1.0, -1.0, 998.5, 249.5), (1, 2000.0, 2000.0, 2001.0, 2001.0)], "b long, x double, y double, u double, v double")
    big = big.select("b", F.array(F.array(geometry.rectangle(F.col("x"), F.col("y"), F.col("u"), F.col("v")))).alias("parts"))
    for left, right, l, r in ((small, big, "a", "b"), (big, small, "b", "a")):
        got = {(p[l], p[r]) for p in spatial.intersecting(left, right, l, r, 5.0).collect()}
        assert got == {((i, 0) if l == "a" else (0, i)) for i in range(n) if i // 200 * 5 + 1 <= 249.5}
    dealt = spatial._celled(spatial._boxes(big, "b", "parts", 5.0), F.array("level"), 5.0, "b")
    assert dealt.count() <= 8  # one level of square cells of 5 would take 10,000
    plan = spatial.candidates(small, big, "a", "b", 5.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "parts" not in plan.split("Join")[1].splitlines()[0]


def test_join_of_repeated_and_null_keys_and_of_no_rows(spark):
    def square(key, x):
        ring = [(x, 0.0), (x + 1, 0.0), (x + 1, 1.0), (x, 1.0), (x, 0.0)]
        return (key, [[ring]])

    schema = "{} long, parts array<array<array<struct<x: double, y: double>>>>"
    a = spark.createDataFrame([square(1, 0.0), square(1, 0.0), square(1, 50.0), square(None, 0.5), (7, None), (8, []), (9, [[]])], schema.format("a"))
    b = spark.createDataFrame([square(2, 0.25), square(2, 50.25), square(3, 90.0)], schema.format("b"))
    assert {tuple(r) for r in spatial.intersecting(a, b, "a", "b", 2.0).collect()} == {(1, 2), (None, 2)}
    assert spatial.intersecting(a, b, "a", "b", 2.0).count() == 2
    assert spatial.intersecting(a.limit(0), b, "a", "b", 2.0).count() == 0
    assert spatial.intersecting(a, b.limit(0), "a", "b", 2.0).count() == 0


def test_bands_of_one_grid_are_looked_up_together(spark):
    rng = random.Random(9)
    grid_of = {"nir": (0.0, 10.0, 100.0, -10.0, 10, 10, 0), "red": (0.0, 10.0, 100.0, -10.0, 10, 10, 7)}
    meta = spark.createDataFrame([("T", b, *g) for b, g in grid_of.items()], "tile string, band string, gx double, gw double, gy double, gh double, nx int, ny int, nodata int")
    cells = [("T", s, b, x, y, rng.randrange(9)) for s in "ab" for b in grid_of for x in range(10) for y in range(10)]
    # One block of one scene's red is missing: points there have no row of that scene.
    cells = [c for c in cells if not (c[1] == "b" and c[2] == "red" and c[3] < 4 and c[4] < 4)]
    blocks = sampling.blocked(spark.createDataFrame(cells, "tile string, scene_id string, band string, px int, py int, dn int"), 4)
    points = spark.createDataFrame([("T", s, i, rng.uniform(-20, 120), rng.uniform(-20, 120)) for i in range(300) for s in "ab"], "tile string, scene_id string, i long, x double, y double")
    keys = ("tile", "scene_id")
    for config in (Config(block=4), Config(block=4, oob="clamp")):
        apart = sampling.sampled(sampling.sampled(points, blocks, meta, "nir", "n", config, keys), blocks, meta, "red", "r", config, keys)
        at_once = sampling.sampled_together(points, blocks, meta, {"nir": "n", "red": "r"}, config, keys)
        assert sorted(map(tuple, at_once.select("i", "scene_id", "n", "r").collect()), key=str) == sorted(map(tuple, apart.select("i", "scene_id", "n", "r").collect()), key=str)
    assert sampling.one_grid(meta, ["nir", "red"])
    assert not sampling.one_grid(meta.withColumn("gx", F.when(F.col("band") == "red", 5.0).otherwise(F.col("gx"))), ["nir", "red"])
    assert not sampling.one_grid(meta.filter("band = 'nir'"), ["nir", "red"])


def test_dedup_takes_the_first_tile_with_a_value(spark):
    rows = [("A", 1, 1, "m1", None), ("B", 1, 1, "m1", 0.4), ("A", 1, 1, "m2", 0.2), ("B", 1, 1, "m2", 0.4), ("A", 1, 1, "m3", None)]
    df = spark.createDataFrame(rows, "tile string, plot_id long, point_id long, month string, v double").withColumns({s: F.col("v") for s in monthly.STATS})
    got = {r["month"]: (r["mean"], r["median"]) for r in monthly.across_tiles(df).collect()}
    assert got == {"m1": (0.4, 0.4), "m2": (0.2, 0.2), "m3": (None, None)}


def test_monthly_statistics_and_points_never_clear(spark):
    rows = [("A", 1, 0, dt.date(2021, 1, 1), 0.2), ("A", 1, 0, dt.date(2021, 1, 9), 0.4), ("A", 1, 0, dt.date(2021, 1, 19), None)]
    stats = monthly.statistics(spark.createDataFrame(rows, "tile string, plot_id long, point_id long, day date, ndvi double"))
    points = spark.createDataFrame([("A", 1, 0), ("A", 1, 1)], "tile string, plot_id long, point_id long")
    months = spark.createDataFrame([("2021-01",), ("2021-02",)], "month string")
    got = {(r["point_id"], r["month"]): r["median"] for r in monthly.dense(stats, points, months).collect()}
    assert got == {(0, "2021-01"): pytest.approx(0.3), (0, "2021-02"): None, (1, "2021-01"): None, (1, "2021-02"): None}
    wide = monthly.wide(stats, "max", ["2021-01", "2021-02"]).first()
    assert wide["2021-01"] == 0.4 and wide["2021-02"] is None
    assert {r["month"]: r["v"] for r in monthly.long(monthly.wide(stats, "max", ["2021-01", "2021-02"]), ["2021-01", "2021-02"], value="v").collect()} == {"2021-01": 0.4, "2021-02": None}


def test_out_of_bounds_and_edge_blocks(spark):
    pixels = spark.range(35).select(F.lit("T").alias("tile"), F.lit(1).alias("scene_id"), F.lit("mask").alias("band"), (F.col("id") % 7).cast("int").alias("px"), F.floor(F.col("id") / 7).cast("int").alias("py"), F.col("id").cast("int").alias("dn"))
    meta = spark.createDataFrame([("T", "mask", 100.0, 10.0, 200.0, -10.0, 7, 5, 34)], "tile string, band string, gx double, gw double, gy double, gh double, nx int, ny int, nodata int")
    points = spark.createDataFrame([("T", i, 100.0 + x, 200.0 - y) for i, (x, y) in enumerate([(5, 5), (65, 45), (-3, 5), (-13, 5), (75, 5), (25, 33), (65, 35)])], "tile string, i int, x double, y double")
    blocks = sampling.blocked(pixels, 4)
    got = {r["i"]: r["v"] for r in sampling.sampled(points, blocks, meta, "mask", "v", Config(block=4)).collect()}
    assert got == {0: 0, 1: None, 2: 0, 5: 23, 6: 27}
    edge = {r["i"]: r["v"] for r in sampling.sampled(points, blocks, meta, "mask", "v", Config(block=4, oob="clamp")).collect()}
    assert edge == {0: 0, 1: None, 2: 0, 3: 0, 4: 6, 5: 23, 6: 27}
    again = sorted((r["px"], r["py"], r["dn"]) for r in sampling.pixels(blocks, meta, 4).collect())
    assert again == sorted((r["px"], r["py"], r["dn"]) for r in pixels.collect())


def test_matched_days(spark):
    local = spark.createDataFrame([(1, 0, dt.date(2021, 1, 1), 0.5), (2, 0, dt.date(2021, 1, 1), 0.1), (1, 0, DAY, 0.3)], "plot_id long, point_id long, day date, v double")
    remote = spark.createDataFrame([(1, 0, dt.date(2021, 1, 1), 0.7), (1, 0, DAY, 0.3), (2, 0, dt.date(2021, 1, 9), None)], "plot_id long, point_id long, day date, v double")
    assert sorted(r["day"] for r in compare.matched_days(local, remote).collect()) == [DAY, dt.date(2021, 1, 9)]
    assert [r["day"] for r in compare.removed_days(local, remote).collect()] == [dt.date(2021, 1, 1)]
    assert compare.still_unmatched(local, remote) and not compare.still_unmatched(*compare.matched_only(local, remote))
    table = {r["plot_id"]: (r["gee_only"], r["local_only"]) for r in compare.unmatched_table(compare.unmatched_days(local, remote)).collect()}
    assert table == {2: (0, 1)}


def scene_path(root, scene, day, masks=1, bands=1):
    folder = root / "47/P/QQ" / scene / "GRANULE/L2A/IMG_DATA"
    for kind, n, name in (("R20m", masks, "OMNI_SCL_20m.tif"), ("R10m", bands, "B08_10m.jp2"), ("R10m", 1, "B04_10m.jp2")):
        (folder / kind).mkdir(parents=True, exist_ok=True)
        for k in range(n):
            (folder / kind / f"T47PQQ_{day}T0{k}_{name}").write_bytes(b"x")


def test_catalog_of_two_archives(spark, tmp_path):
    old, new = tmp_path / "old", tmp_path / "new"
    scene_path(old, "S2B_MSIL2A_20240101", "20240101")
    scene_path(old, "S2B_MSIL2A_20240106", "20240106")
    scene_path(old, "S2A_MSIL2A_20240103", "20240103")  # another satellite
    scene_path(old, "S2B_20240104", "20240104")  # too few parts
    scene_path(old, "S2B_MSIL2A_20240105", "20240105", masks=2)
    scene_path(old, "S2B_MSIL2A_2024x", "2024x107")
    scene_path(old, "S2B_MSIL2A_20180101", "20180101")  # out of range
    scene_path(new, "S2B_MSIL2A_20240106_N", "20240106")
    got = archive.catalog(spark, Config(archive_old=str(old), archive_new=str(new))).collect()
    assert {(r["day"].isoformat(), "/new/" in r["nir_path"]) for r in got} == {("2024-01-01", False), ("2024-01-06", True)}
    assert all("_B04_" in r["red_path"] and r["tile"] == "47PQQ" for r in got)


def test_whole_run_writes_four_tables(spark, tmp_path):
    epsg = 32647
    ring = [(500000, 1500000), (500040, 1500000), (500040, 1500040), (500000, 1500040), (500000, 1500000)]
    metres = spark.range(1).select(F.lit("p1").alias("plot_id"), F.array(F.array(ring_column(ring))).alias("parts"))
    plots = metres.select("plot_id", wkb.encoded(crs.reprojected(F.col("parts"), epsg, forward=False)).alias("geometry"))
    plots.write.parquet(f"{tmp_path}/plots.parquet")
    degrees = tables.polygons(spark, f"{tmp_path}/plots.parquet")
    assert degrees.filter("valid").count() == 1
    made = grid.build(degrees, "TRAT", epsg)
    sinks.write_geoparquet(made, f"{tmp_path}/grid.parquet", ["Point"], epsg)
    assert spark.read.parquet(f"{tmp_path}/grid.parquet").count() == 16
    tile = F.array(F.array(ring_column([(499000, 1499000), (510000, 1499000), (510000, 1510000), (499000, 1510000), (499000, 1499000)])))
    tiles = spark.createDataFrame([("A", epsg), ("B", epsg)], "tile string, epsg int").withColumn("parts", crs.reprojected(tile, epsg, forward=False))
    days = [dt.date(2021, 1, 5), dt.date(2021, 1, 15), dt.date(2021, 2, 5)]
    scenes = spark.createDataFrame([(t, 10 * k + n, d) for k, t in enumerate("AB") for n, d in enumerate(days)], "tile string, scene_id long, day date")
    pixel = scenes.select("tile", "scene_id", F.explode(F.array(*map(F.lit, ("mask", "nir", "red")))).alias("band"), F.explode(F.sequence(F.lit(0), F.lit(63))).alias("at"))
    dn = F.when(F.col("band") == "mask", F.when((F.col("scene_id") % 10 == 2) | (F.col("tile") == "A") & (F.col("scene_id") == 0), 1).otherwise(0)).when(F.col("band") == "nir", 3000 + F.col("scene_id")).otherwise(1000)
    pixels = pixel.select("tile", "scene_id", "band", (F.col("at") % 8).cast("int").alias("px"), F.floor(F.col("at") / 8).cast("int").alias("py"), dn.cast("int").alias("dn"))
    meta = spark.createDataFrame([(t, b, 500000.0, 10.0, 1500080.0, -10.0, 8, 8, None) for t in "AB" for b in ("mask", "nir", "red")], "tile string, band string, gx double, gw double, gy double, gh double, nx int, ny int, nodata int")
    config = Config(province="TRAT", polygons=f"{tmp_path}/plots.parquet", output_dir=f"{tmp_path}/out", grid_file=f"{tmp_path}/grid.parquet", block=4)
    assert run.run(spark, config, tiles, scenes, sampling.blocked(pixels, 4), meta) == {s: 16 for s in monthly.STATS}
    table = spark.read.parquet(f"{tmp_path}/out/TRAT/ndvi_mean.parquet")
    assert table.columns == ["plot_id", "point_id", "lat", "lon", "2021-01", "2021-02", "geometry"]
    assert {(round(r["2021-01"], 6), r["2021-02"]) for r in table.collect()} == {(round((2001) / (4001), 6), None)}
    names = [p for p in (tmp_path / "out/TRAT/ndvi_mean.parquet").iterdir() if p.suffix == ".parquet"]
    assert all(json.loads(pq.read_metadata(p).metadata[b"geo"])["primary_column"] == "geometry" for p in names)
    assert spark.read.parquet(f"{tmp_path}/out/TRAT/point_master.parquet").count() == 16
    told = json.loads((tmp_path / "out/TRAT/performance_summary.json").read_text())
    assert (told["tiles_processed"], told["scenes_processed"], told["points_written"]) == (2, 6, 64)
    assert not (tmp_path / "out/TRAT/_stats.parquet").exists()


def small_run(spark, tmp_path, **settings):
    """Two tiles of one box of points: points, scenes, pixels and settings of a run."""
    ring = ring_column([(99.0, 13.5), (99.0003, 13.5), (99.0003, 13.5003), (99.0, 13.5003), (99.0, 13.5)])
    plots = spark.range(1).select(F.lit(7).cast("long").alias("plot_id"), F.array(F.array(ring)).alias("parts"))
    tiles = spark.createDataFrame([("A",), ("B",)], "tile string").select("tile", F.array(F.array(ring_column([(98, 13), (100, 13), (100, 14), (98, 14), (98, 13)]))).alias("parts"), F.lit(32647).alias("epsg"))
    pq.write_table(plots.select("plot_id", wkb.encoded("parts").alias("geometry")).toArrow(), tmp_path / "trat.parquet")
    (tmp_path / "grid_points").mkdir()
    points = grid.build(plots, "TRAT", 32647)
    pq.write_table(points.toArrow(), tmp_path / "grid_points/Trat_grid 2.parquet")
    at = points.agg(F.min("x_utm").alias("x"), F.max("y_utm").alias("y")).first()
    gx, gy = at["x"] - 5.0, at["y"] + 5.0
    scenes = spark.createDataFrame([(t, 10 * k + i, dt.date(2021, 1 + k, 5)) for i, t in enumerate("AB") for k in range(2)], "tile string, scene_id long, day date")
    n = F.col("px") * 31 + F.col("py") * 17 + F.col("scene_id") * 5
    cells = scenes.select("tile", "scene_id").crossJoin(spark.createDataFrame([("mask",), ("nir",), ("red",)], "band string")).crossJoin(spark.range(8).select(F.col("id").cast("int").alias("px"))).crossJoin(spark.range(8).select(F.col("id").cast("int").alias("py")))
    pixels = cells.withColumn("dn", F.when(F.col("band") == "mask", n % 2).when(F.col("band") == "nir", 2000 + n).otherwise(1000 + n % 7).cast("int"))
    config = Config(province="TRAT", polygons=f"{tmp_path}/trat.parquet", output_dir=f"{tmp_path}/out", block=16, **settings)
    return config, tiles, scenes, pixels, (gx, gy)


def four(spark, tmp_path):
    return {s: sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out/TRAT/ndvi_{s}.parquet").drop("geometry").collect())) for s in monthly.STATS}


def test_a_run_that_was_ended_goes_on_where_it_stood(spark, tmp_path, monkeypatch):
    """Tiles in the log are not done again; changed scenes are; results are those of one run. The grid is found beside the polygons."""
    monkeypatch.setattr(run, "TILES", 1)
    config, tiles, scenes, pixels, (gx, gy) = small_run(spark, tmp_path)
    meta = spark.createDataFrame([(t, b, gx, 10.0, gy, -10.0, 8, 8, None) for t in "AB" for b in ("mask", "nir", "red")], "tile string, band string, gx double, gw double, gy double, gh double, nx int, ny int, nodata int")
    blocks = sampling.blocked(pixels, 16)
    written = run.run(spark, config, tiles, scenes, blocks, meta)
    want, asked = four(spark, tmp_path), []
    assert sum(v is not None for r in want["mean"] for v in r[4:]) > 4 and set(written.values()) == {len(want["mean"])}

    def failing(points):
        tile = points.select("tile").first()[0]
        asked.append(tile)
        if tile == "B" and asked.count("B") == 1:
            raise RuntimeError("the machine is gone")
        return blocks.filter(F.col("tile") == tile)

    with pytest.raises(RuntimeError):
        run.run(spark, config, tiles, scenes, failing, meta)
    assert (tmp_path / "out/TRAT/_done.parquet").exists()
    run.run(spark, config, tiles, scenes, failing, meta)
    assert asked == ["A", "B", "B"] and four(spark, tmp_path) == want
    told = json.loads((tmp_path / "out/TRAT/performance_summary.json").read_text())
    assert (told["tiles_processed"], told["tiles_resumed"], told["scenes_processed"]) == (2, 1, 4) and 0 < told["index_points"] <= told["clear_points"]
    assert not [p.name for p in (tmp_path / "out/TRAT").iterdir() if p.name.startswith("_")]
    asked.clear()
    with pytest.raises(RuntimeError):
        run.run(spark, config, tiles, scenes, failing, meta)
    run.run(spark, config, tiles, scenes.filter("scene_id <> 10"), failing, meta)  # A has lost a scene and is done again
    assert asked == ["A", "B", "A", "B"] and four(spark, tmp_path) != want


def test_a_run_from_raster_files(spark, tmp_path, monkeypatch):
    """As from blocks; a file that is cut off leaves its scene without values and is named."""
    from geots import __main__ as command
    from geots.plans import files

    config, tiles, scenes, pixels, (gx, gy) = small_run(spark, tmp_path)
    made = {}
    for r in pixels.groupBy("tile", "scene_id", "band").agg(F.sort_array(F.collect_list(F.struct("py", "px", "dn"))).alias("c")).collect():
        path = tmp_path / f"{r['tile']}{r['scene_id']}{r['band']}.tif"
        path.write_bytes(files.tiff_bytes(np.array([c["dn"] for c in r["c"]]).reshape(8, 8), 16, (gx, gy), (10.0, -10.0), 32647, None))
        made[r["tile"], r["scene_id"], r["band"]] = path
    rasters = spark.createDataFrame([(*k, str(p)) for k, p in made.items()], "tile string, scene_id long, band string, path string")
    blocks, meta, broken = run.from_rasters(rasters, config)
    run.run(spark, config, tiles, scenes, blocks, meta)
    found = four(spark, tmp_path)
    assert broken.count() == 0
    plain = [(t, b, gx, 10.0, gy, -10.0, 8, 8, None) for t in "AB" for b in ("mask", "nir", "red")]
    run.run(spark, config, tiles, scenes, sampling.blocked(pixels, 16), spark.createDataFrame(plain, "tile string, band string, gx double, gw double, gy double, gh double, nx int, ny int, nodata int"))
    assert four(spark, tmp_path) == found
    cut = made["A", 10, "nir"]
    cut.write_bytes(cut.read_bytes()[:40])
    made["B", 11, "mask"].unlink()
    for name, df in (("rasters", rasters), ("scenes", scenes)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    pq.write_table(tiles.select(F.col("tile").alias("Name"), wkb.encoded("parts").alias("geometry"), "epsg").toArrow(), tmp_path / "tiles.parquet")
    for name, value in {"PROVINCE": "trat", "GOLDEN_DURIAN_PATH": config.polygons, "OUTPUT_DIR": config.output_dir}.items():
        monkeypatch.setenv(name, value)
    monkeypatch.setattr(Config, "from_env", classmethod(lambda cls: config))
    command.main(["monthly", *(f"--{n}={tmp_path}/{n}.parquet" for n in ("scenes", "tiles", "rasters"))])
    after = four(spark, tmp_path)["mean"]
    assert [r[:5] for r in after] == [r[:5] for r in found["mean"]]  # January as before
    assert {r[5] for r in after} == {None} and {r[5] for r in found["mean"]} != {None}
    with pytest.raises(SystemExit):
        command.main(["monthly", "--scenes=x", "--tiles=y"])


def test_wide_tables_of_differing_months(spark, tmp_path):
    spark.createDataFrame([(1, 0, 0.5, 0.25)], "plot_id long, point_id long, `2021-02` double, `2021-01` double").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([(2, 0, 0.75)], "plot_id long, point_id long, `2021-03` double").write.parquet(f"{tmp_path}/b")
    got = tables.wide_tables(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    assert got.columns == ["plot_id", "point_id", "2021-01", "2021-02", "2021-03"]
    assert sorted(map(tuple, got.collect())) == [(1, 0, 0.25, 0.5, None), (2, 0, None, None, 0.75)]


def test_command_line_grid(spark, tmp_path):
    from geots import __main__ as command

    (tmp_path / "in").mkdir()
    ring = ring_column([(99.0, 13.5), (99.0004, 13.5), (99.0004, 13.5004), (99.0, 13.5004), (99.0, 13.5)])
    for name in ("b", "a"):
        plots = spark.range(1).select(wkb.encoded(F.array(F.array(ring))).alias("geometry"))
        pq.write_table(plots.toArrow(), tmp_path / "in" / f"{name}.parquet")
    command.main(["grid", "--polygon-dir", str(tmp_path / "in"), "--grid-dir", str(tmp_path)])
    got = spark.read.parquet(f"{tmp_path}/a_grid.parquet")
    assert got.count() > 9 and {(r["province"], r["plot_id"]) for r in got.collect()} == {("A", 0)}
    lon, lat = got.agg(F.avg("lon"), F.avg("lat")).first()
    assert lon == pytest.approx(99.0002, abs=1e-4) and lat == pytest.approx(13.5002, abs=1e-4)
    before = got.inputFiles()
    command.main(["grid", "--polygon-file", str(tmp_path / "in/a.parquet"), "--grid-dir", str(tmp_path)])
    assert spark.read.parquet(f"{tmp_path}/a_grid.parquet").inputFiles() == before
    folder = tables.polygon_folder(spark, str(tmp_path / "in"))
    assert {r["province"] for r in folder.collect()} == {"A", "B"}
    (tmp_path / "none").mkdir()
    with pytest.raises(SystemExit):
        command.main(["grid", "--polygon-dir", str(tmp_path / "none")])


def test_block_bytes(spark):
    from geots.functions import blocks

    rows = [(struct.pack("<3H", 1, 2, 65535), "u16"), (struct.pack("<2f", 0.5, -1), "f32"), (None, "u8")]
    got = spark.createDataFrame(rows, "data binary, kind string").select(blocks.samples("data", "kind").alias("v")).collect()
    assert [r["v"] for r in got] == [[1, 2, 65535], [0.5, -1], None]


def test_grid_checks(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/bad.parquet")
    with pytest.raises(ValueError, match="lat"):
        tables.grid(spark, f"{tmp_path}/bad.parquet")
    spark.createDataFrame([], "plot_id long, point_id long, lon double, lat double").write.parquet(f"{tmp_path}/none.parquet")
    with pytest.raises(ValueError, match="no row"):
        tables.grid(spark, f"{tmp_path}/none.parquet")


def test_legacy_readers(spark, tmp_path):
    spark.createDataFrame([(1, 0, 0.5, None)], "plot_id long, point_id long, `2021/01/05` double, `2021/02/30` double").write.parquet(f"{tmp_path}/wide.parquet")
    assert [(r["day"], r["v"]) for r in tables.wide_days(spark, f"{tmp_path}/wide.parquet").filter("v is not null").collect()] == [(DAY, 0.5)]
    import pyarrow as pa

    (tmp_path / "plots").mkdir()
    for i, day in ((7, "2021/01/05"), (8, "2021/01/06")):
        pq.write_table(pa.table({"x": [1.0], "y": [2.0], day: [0.25]}), tmp_path / "plots" / f"ndvi_{i}.parquet")
    got = tables.plot_files(spark, str(tmp_path / "plots")).filter("v is not null")
    assert {(r["plot_id"], r["day"].isoformat(), r["v"]) for r in got.collect()} == {(7, "2021-01-05", 0.25), (8, "2021-01-06", 0.25)}


def test_bytes_of_parts_that_differ_in_rings(spark):
    box = [{"x": float(x), "y": float(y)} for x, y in ((0, 0), (4, 0), (4, 4), (0, 0))]
    rows = [(1, [[box, box[:3] + box[:1]], [box]]), (2, None), (3, [[box]])]
    df = spark.createDataFrame(rows, "plot_id long, parts array<array<array<struct<x:double,y:double>>>>")
    got = {r["plot_id"]: r["p"] for r in df.select("plot_id", wkb.decoded(wkb.encoded("parts")).alias("p")).collect()}
    assert {k: v and [[[{"x": p["x"], "y": p["y"]} for p in ring] for ring in rings] for rings in v] for k, v in got.items()} == dict(rows)


def test_default_ids(spark):
    df = spark.createDataFrame([(x,) for x in "dbca"], "name string")
    assert sorted((r["plot_id"], r["name"]) for r in grid.with_default_id(df, ["name"]).collect()) == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]
    kept = spark.createDataFrame([("x", 9)], "name string, plot_id long")
    assert grid.with_default_id(kept, ["name"]).first()["plot_id"] == 9


def test_utm_zone(spark):
    east = F.array(F.array(ring_column([(103, 10), (103.1, 10), (103.1, 10.1), (103, 10)])))
    plots = spark.createDataFrame([(None,), (100.0,)], "centroid_x double").withColumn("parts", east)
    assert grid.utm_zone(plots).first()["epsg"] == 32647
    assert grid.utm_zone(plots.drop("centroid_x")).first()["epsg"] == 32648


def test_geopackage(spark, tmp_path):
    point_ring = struct.pack("<I", 4) + b"".join(struct.pack("<dd", *p) for p in ((0, 0), (1, 0), (1, 1), (0, 0)))
    polygon = struct.pack("<BII", 1, 3, 1) + point_ring
    blob = b"GP\x00\x03" + struct.pack("<i", 4326) + struct.pack("<4d", 0, 1, 0, 1) + polygon
    with sqlite3.connect(tmp_path / "a.gpkg") as db:
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES ('plots', 'geom')")
        db.execute("CREATE TABLE plots (fid INTEGER PRIMARY KEY, geom BLOB)")
        db.executemany("INSERT INTO plots VALUES (?, ?)", [(1, blob), (2, None)])
    got = grid.polygons(tables.geopackage(spark, str(tmp_path / "a.gpkg"), "plots")).collect()
    assert [(r["fid"], r["valid"], len(r["parts"][0][0])) for r in got] == [(1, True, 4)]


def test_reports(spark, tmp_path):
    sinks.write_csv(spark.range(3), f"{tmp_path}/r.csv", ["id"])
    assert len(list((tmp_path / "r.csv").glob("*.csv"))) == 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_csv(spark.range(5000).withColumn("id", 4999 - F.col("id")).repartition(3), f"{tmp_path}/many.csv", ["id"], single=False)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [p.read_text().split() for p in sorted((tmp_path / "many.csv").glob("*.csv"))]
    assert len(parts) > 1 and {p[0] for p in parts} == {"id"} and [int(x) for p in parts for x in p[1:]] == list(range(5000))
    summary = json.loads(sinks.run_summary("TRAT", "2024-01-01", 90.0, {"tiles_processed": 2}, {"read": 1.0, "write": 3.0}))
    assert summary["timing"]["write"]["percent"] == 75 and summary["total_elapsed_min"] == 1.5
    assert json.loads(sinks.run_summary("T", "d", 0, {}, {"x": 0.0}))["timing"]["x"]["percent"] == 0
    sinks.put_text(spark, f"{tmp_path}/s.txt", sinks.summary_text({"n": 2, "mae": 0.5}, [{"month": "2021-01", "n": 2, "mae": 0.5, "bias": -0.1, "max_abs": 0.7}]))
    assert "2021-01" in (tmp_path / "s.txt").read_text()
    sinks.remove(spark, f"{tmp_path}/r.csv")
    assert not (tmp_path / "r.csv").exists()


def test_stream_equals_table(spark, tmp_path):
    rows = [(p, dt.datetime(2021, 1, 1) + dt.timedelta(days=d), d / 100) for p in (1, 2) for d in range(0, 200, 3)]
    df = spark.createDataFrame(rows, "plot_id long, ts timestamp, ndvi double")
    df.filter("ts < '2021-04-01'").write.parquet(f"{tmp_path}/in")
    options = {"path": f"{tmp_path}/out", "checkpoint": f"{tmp_path}/state"}
    source = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    streaming.start(source, **options).awaitTermination()
    df.filter("ts >= '2021-04-01'").write.mode("append").parquet(f"{tmp_path}/in")
    spark.createDataFrame([(1, dt.datetime(2021, 1, 2), 9.0)], df.schema).write.mode("append").parquet(f"{tmp_path}/in")  # late
    streaming.start(source, **options).awaitTermination()
    got = {(r["plot_id"], r["window_start"]): (r["n"], round(r["max"], 6)) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = {(r["plot_id"], r["window_start"]): (r["n"], round(r["max"], 6)) for r in streaming.windowed(df).collect()}
    assert got and all(want[k] == v for k, v in got.items()) and len(want) - len(got) <= 4
