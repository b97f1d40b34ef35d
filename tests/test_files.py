"""Readers of vector, raster and legacy files against plain readers of the same files."""

import os
import random
import sqlite3
import struct
import zlib
from contextlib import closing

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from geots.config import Config
from geots.functions import wkb
from geots.operators import grid, sampling
from geots.plans import bridge, files
from geots.sources import geotiff, tables, vector
from pyspark.sql import functions as F

PARTS = "plot_id long, parts array<array<array<struct<x:double,y:double>>>>"


def box(x, y, w, h, clockwise=False):
    ring = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    return ring[::-1] if clockwise else ring


def struct_rings(polygons):
    return [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings] for rings in polygons]


def some_plots(n, seed=1):
    """Boxes, some with holes, some in two parts of which the second lies in the first one's hole."""
    rng, out = random.Random(seed), []
    for i in range(n):
        x, y = rng.randrange(10**6), rng.randrange(10**6)
        rings = [box(x, y, 50, 40)] + ([box(x + 5, y + 5, 20, 20)] if i % 3 == 0 else [])
        out.append((i * 7 + 3, struct_rings([rings] + ([[box(x + 10, y + 10, 5, 5)]] if i % 6 == 0 else []))))
    return out


def normal(parts):
    """Polygons as sorted sets of corners, whatever vertex or direction a ring begins with."""
    return sorted(sorted(sorted({(v["x"], v["y"]) for v in ring}) for ring in rings) for rings in parts)


def read_back(df):
    return {int(r["attributes"]["plot_id"]): normal(wkb.polygons_of(r["geometry"])) for r in df.collect()}


@pytest.fixture
def folder(spark, tmp_path):
    plots = some_plots(240)
    df = spark.createDataFrame(plots, PARTS)
    files.write_packages(df.filter("plot_id % 3 = 0"), str(tmp_path), 32648, parts=1)
    files.write_shapes(df.filter("plot_id % 3 = 1"), str(tmp_path), 'PROJCS["WGS_1984_UTM_Zone_47N",GEOGCS[...]]', parts=1)
    rest = df.filter("plot_id % 3 = 2").select("plot_id", wkb.encoded("parts").alias("geometry"), F.lit(None).cast("string").alias("note"))
    pq.write_table(rest.toArrow(), tmp_path / "rest.parquet")
    return tmp_path, plots


def test_a_folder_of_three_kinds_is_one_table(spark, folder):
    path, plots = folder
    df = tables.polygon_folder(spark, str(path))
    assert df.columns == ["file", "fid", "epsg", "geometry", "attributes", "province"]
    assert read_back(df) == {i: normal(p) for i, p in plots}
    told = {os.path.basename(r["file"]).split(".")[1]: r for r in df.collect()}
    assert {k: (r["province"].split("_")[0], r["epsg"]) for k, r in told.items()} == {"gpkg": ("PACKAGE", 32648), "shp": ("SHAPES", 32647), "parquet": ("REST", None)}
    assert all("note" not in r["attributes"] for r in df.collect())
    assert df.select("file", "fid").distinct().count() == len(plots)


def test_one_file_is_read_by_many_tasks(spark, folder):
    path, plots = folder
    for kind, modulus in (("gpkg", 0), ("shp", 1)):
        name = next(str(p) for p in path.iterdir() if p.suffix == f".{kind}")
        df = vector.read(spark, name, records=15)
        assert df.rdd.getNumPartitions() >= 6
        sizes = df.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) <= 15
        assert read_back(df) == {i: normal(p) for i, p in plots if i % 3 == modulus}


def test_polygons_of_every_kind(spark, folder):
    """Plot ids from the attributes; metres go back to degrees by what the file says of itself."""
    path, plots = folder
    for kind, modulus in (("gpkg", 0), ("shp", 1)):
        found = tables.polygons(spark, next(str(p) for p in path.iterdir() if p.suffix == f".{kind}")).select("plot_id", "parts").collect()
        assert {r["plot_id"] for r in found} == {i for i, _ in plots if i % 3 == modulus}
        assert all(-180 <= v["x"] <= 180 for r in found for rings in r["parts"] for ring in rings for v in ring)


def test_package_of_many_layers_and_odd_names(spark, tmp_path):
    polygon = wkb.polygon_bytes(struct_rings([[box(0, 0, 1, 1)]]))
    with closing(sqlite3.connect(tmp_path / "a.gpkg")) as db:
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
        for name in ('pl"ots', "empty", "two"):
            q = '"' + name.replace('"', '""') + '"'
            db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'the geom')", (name,))
            db.execute(f'CREATE TABLE {q} ("k""ey" INTEGER PRIMARY KEY, "the geom" BLOB, "a b" REAL, raw BLOB)')
            if name != "empty":
                db.executemany(f"INSERT INTO {q} VALUES (?, ?, ?, ?)", [(-5, b"GP\0\1" + bytes(4) + polygon, 0.5, None), (10**12, None, None, b"\1\2"), (7, b"GP\0\3" + bytes(36) + polygon, None, None)])
        db.commit()
    rows = vector.read(spark, str(tmp_path / "a.gpkg"), records=1).collect()
    assert sorted((r["layer"], r["fid"], r["geometry"] is None, tuple(sorted(r["attributes"].items()))) for r in rows) == sorted(
        (n, k, k == 10**12, a) for n in ('pl"ots', "two") for k, a in ((-5, (("a b", "0.5"),)), (7, ()), (10**12, (("raw", "0102"),)))
    )
    assert {r["layer"] for r in vector.read(spark, str(tmp_path / "a.gpkg"), layer="two").collect()} == {"two"}
    assert [(r["fid"], r["epsg"]) for r in vector.read(spark, str(tmp_path / "a.gpkg"), layer="empty").collect()] == []


def test_shapefile_oddities(spark, tmp_path):
    plots = [(i, struct_rings([[box(10 * i, 0, 5, 5)]])) for i in range(4)]
    files.write_shapes(spark.createDataFrame(plots, PARTS), str(tmp_path), "", parts=1)
    stem = next(p for p in tmp_path.iterdir() if p.suffix == ".shp").with_suffix("")
    table = bytearray(stem.with_suffix(".dbf").read_bytes())
    table[65 + 19 * 1] = ord("*")  # deleted
    stem.with_suffix(".dbf").write_bytes(table)
    shapes = bytearray(stem.with_suffix(".shp").read_bytes())
    at = struct.unpack_from(">i", stem.with_suffix(".shx").read_bytes(), 100 + 8 * 2)[0] * 2 + 8
    struct.pack_into("<i", shapes, at, 0)  # no shape
    stem.with_suffix(".shp").write_bytes(shapes)
    rows = sorted(vector.read(spark, str(stem) + ".shp").collect(), key=lambda r: r["fid"])
    assert [(r["fid"], r["geometry"] is None, r["epsg"]) for r in rows] == [(0, False, None), (2, True, None), (3, False, None)]
    struct.pack_into("<i", shapes, at, 1)
    stem.with_suffix(".shp").write_bytes(shapes)
    with pytest.raises(Exception, match="shape type 1 is no polygon"):
        vector.read(spark, str(stem) + ".shp").collect()
    os.remove(stem.with_suffix(".dbf"))
    struct.pack_into("<i", shapes, at, 15)  # heights behind the points are passed over
    stem.with_suffix(".shp").write_bytes(shapes)
    assert [r["attributes"] for r in vector.read(spark, str(stem) + ".shp").collect()] == [{}] * 4
    os.remove(stem.with_suffix(".shx"))
    with pytest.raises(Exception, match="no .shx index"):
        vector.read(spark, str(stem) + ".shp").collect()


def test_projection_texts():
    assert vector.projection_epsg('PROJCS["x",GEOGCS["y",AUTHORITY["EPSG","4326"]],AUTHORITY["EPSG","32648"]]') == 32648
    assert vector.projection_epsg('PROJCS["WGS_1984_UTM_Zone_3S",GEOGCS["GCS_WGS_1984"]]') == 32703
    assert vector.projection_epsg('GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984"]]') == 4326
    assert vector.projection_epsg('LOCAL_CS["none"]') is None


def test_folders_without_polygons(spark, tmp_path):
    with pytest.raises(ValueError, match="no polygon file"):
        tables.polygon_folder(spark, str(tmp_path))
    assert vector.read(spark, str(tmp_path)).count() == 0
    with pytest.raises(ValueError, match="not mounted"):
        vector.mounted("hdfs://host/x.shp")


def test_grids_of_a_folder_of_all_kinds(spark, tmp_path):
    from geots import __main__ as command

    plots = [(i, struct_rings([[box(99 + i / 100, 13.5, 0.0004, 0.0004)]])) for i in range(3)]
    df = spark.createDataFrame(plots, PARTS)
    for name in ("in", "out"):
        (tmp_path / name).mkdir()
    files.write_packages(df, str(tmp_path / "in"), 4326, parts=1)
    files.write_shapes(df, str(tmp_path / "in"), 'GEOGCS["GCS_WGS_1984"]', parts=1)
    pq.write_table(df.select("plot_id", wkb.encoded("parts").alias("geometry")).toArrow(), tmp_path / "in/table.parquet")
    command.main(["grid", "--polygon-dir", str(tmp_path / "in"), "--grid-dir", str(tmp_path / "out")])
    made = {p.name: spark.read.parquet(str(p)) for p in (tmp_path / "out").iterdir()}
    assert len(made) == 3
    rows = [sorted((r["plot_id"], r["point_id"], r["x_utm"], r["y_utm"]) for r in t.collect()) for t in made.values()]
    assert len(rows[0]) > 20 and rows[0] == rows[1] == rows[2]


# One file a plot ---------------------------------------------------------------------------------


def test_thousands_of_files_with_days_of_their_own(spark, tmp_path):
    """No schema of all files is made: the plan is as wide as for two files."""
    rng, want = np.random.default_rng(1), []
    for i in range(2000):
        day = np.datetime64("2001-01-01") + i
        values = [None if x > 0.9 else float(x) for x in rng.random(2)]
        name = str(day).replace("-", "/")
        (tmp_path / str(i % 7)).mkdir(exist_ok=True)
        pq.write_table(pa.table({"x": [1.0, 2.0], "y": [3.0, float(i)], "note": ["a", "b"], name: pa.array(values, pa.float64())}), tmp_path / str(i % 7) / f"ndvi_{i}.parquet")
        want += [(i, k, 1.0 + k, 3.0 if k == 0 else float(i), str(day), v) for k, v in enumerate(values)]
    df = tables.plot_files(spark, str(tmp_path))
    got = [(r["plot_id"], r["row"], r["x"], r["y"], str(r["day"]), r["v"]) for r in df.collect()]
    assert sorted(got, key=lambda r: r[:2]) == want
    two = tmp_path / "two"
    two.mkdir()
    for i in (1, 2):
        pq.write_table(pa.table({"x": [1.0], f"2001/01/0{i}": [0.5]}), two / f"a_{i}.parquet")
    plan = [f._jdf.queryExecution().optimizedPlan().toString().count("#") for f in (df, tables.plot_files(spark, str(two)))]
    assert plan[0] == plan[1] and df.rdd.getNumPartitions() < 100


def test_melting_in_pieces_and_odd_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "CELLS", 5)
    days = [f"2020/01/{d:02d}" for d in range(1, 30)]
    pq.write_table(pa.table({"y": pa.array([1, 2], pa.int32()), **{d: pa.array([k, float("nan")], pa.float32()) for k, d in enumerate(days)}, "2020/02/31": [1.0, 2.0]}), tmp_path / "b_7.parquet")
    pq.write_table(pa.table({"x": [1.0]}), tmp_path / "c_8.parquet")
    pq.write_table(pa.table({"x": pa.array([], pa.float64()), days[0]: pa.array([], pa.float64())}), tmp_path / "d_9.parquet")
    pq.write_table(pa.table({"x": [1.0], days[0]: [1.0]}), tmp_path / "nameless.parquet")
    pq.write_table(pa.table({"x": [1.0], days[0]: [1.0]}), tmp_path / "e_99999999999999999999999.parquet")
    got = tables.plot_files(spark, str(tmp_path)).collect()
    assert len(got) == 60 and {r["plot_id"] for r in got} == {7} and {r["x"] for r in got} == {None} and {r["y"] for r in got} == {1.0, 2.0}
    assert sorted((str(r["day"]), r["v"]) for r in got if r["row"] == 0 and r["day"]) == [(d.replace("/", "-"), float(k)) for k, d in enumerate(days)]
    assert [r["v"] for r in got if r["row"] == 1 and r["day"]] == [None] * 29 and sum(r["day"] is None for r in got) == 2


def test_months_of_plot_files(spark, tmp_path):
    for tile, shift in (("a", 0.0), ("b", 0.25)):
        pq.write_table(pa.table({"x": [1.0, 2.0, 3.0], "y": [1.0, 1.0, 1.0], "2020/01/01": [0.1 + shift, None, None], "2020/01/09": [0.2, 0.4 + shift, None], "2020/02/01": pa.array([None] * 3, pa.float64())}), tmp_path / f"{tile}_5.parquet")
    got = {r["month"]: (r["plot_id"], r["v"]) for r in tables.plot_file_months(spark, str(tmp_path)).collect()}
    assert got == {"2020-01": (5, pytest.approx((0.35 + 0.65) / 2)), "2020-02": (5, None)}


def test_months_are_dealt_by_file_and_not_by_cell(spark, tmp_path):
    """The plan has one exchange of file names and one of files' months; hidden names are no plots, folders in folders are."""
    rng, want = np.random.default_rng(2), {}
    for i in range(40):
        days = [str(d).replace("-", "/") for d in np.datetime64("2001-01-20") + rng.choice(60, 20, False)] + ["2001/02/30"]
        values = np.where(rng.random((21, 9)) < 0.4, np.nan, rng.random((21, 9)).round(3))
        values[:, 0] = np.nan
        folder = tmp_path / "deep" / str(i % 3) if i % 4 else tmp_path
        folder.mkdir(parents=True, exist_ok=True)
        kind = pa.float32() if i % 5 == 0 else pa.float64()
        pq.write_table(pa.table({"x": np.zeros(9)} | {d: pa.array(v, kind, from_pandas=i % 2 == 0) for d, v in zip(days, values)}), folder / f"tile{i % 2}_{i // 2}.parquet")
        for month in {d[:7] for d in days[:-1]}:
            own = values[[k for k, d in enumerate(days[:-1]) if d[:7] == month]]
            tops = [t for t in np.fmax.reduce(own).tolist() if t == t]
            want.setdefault((i // 2, month.replace("/", "-")), []).extend([sum(tops) / len(tops)] if tops else [])
    (tmp_path / "_out").mkdir()
    for hidden in (tmp_path / "_out" / "a_500.parquet", tmp_path / ".b_501.parquet"):
        pq.write_table(pa.table({"x": [1.0], "2001/01/01": [0.5]}), hidden)
    df = tables.plot_file_months(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 2 and "content" not in plan
    got = {(r["plot_id"], r["month"]): r["v"] for r in df.collect()}
    assert got == {k: pytest.approx(max(v), abs=1e-6) if v else None for k, v in want.items()}


def test_plot_files_lie_in_folders_by_plot(spark, tmp_path):
    rows = [(t, p, k, np.datetime64("2001-01-30").item(), None if (p + k) % 5 == 0 else p + k / 8) for t in (0, 1) for p in range(30) for k in range(t, 4)]
    files.write_plot_files(spark.createDataFrame(rows, "tile_no int, plot_id long, point_id int, day date, v double"), str(tmp_path))
    assert {f.name for f in tmp_path.iterdir()} <= {str(k) for k in range(1000)} and len(list(tmp_path.rglob("*.parquet"))) == 60
    got = sorted((int(r["file"].split("/tile")[1][0]), r["plot_id"], int(r["x"]), r["y"], r["v"]) for r in tables.plot_files(spark, str(tmp_path)).fillna(-1.0, ["v"]).collect())
    assert got == sorted((t, p, k, float(p), -1.0 if v is None else v) for t, p, k, _, v in rows)


# GeoTIFF -----------------------------------------------------------------------------------------

CASES = [(64, 64, 16, True, 16), (70, 45, 32, True, 16), (70, 45, 16, False, 16), (33, 20, 16, True, 48), (100, 7, 16, True, 32)]


@pytest.mark.parametrize("nx,ny,inside,tiled,block", CASES)
def test_blocks_equal_those_of_single_pixels(spark, tmp_path, nx, ny, inside, tiled, block):
    values = np.random.default_rng(nx).integers(0, 65535, (ny, nx))
    (tmp_path / "a.tif").write_bytes(files.tiff_bytes(values, inside, (500000.0, 1400000.0), (10.0, -20.0), 32647, 65535, tiled))
    listed = spark.createDataFrame([("T", 1, "nir", f"file:{tmp_path}/a.tif"), ("T", 2, "nir", None)], "tile string, scene_id long, band string, path string")
    found = geotiff.index(listed, block)
    got = {(r["bx"], r["by"]): r["data"] for r in geotiff.blocks(found, block).collect()}
    pixels = spark.createDataFrame([("T", 1, "nir", x, y, int(values[y, x])) for y in range(ny) for x in range(nx)], "tile string, scene_id long, band string, px int, py int, dn int")
    assert got == {(r["bx"], r["by"]): r["data"] for r in sampling.blocked(pixels, block).collect()}
    about = geotiff.meta(found).collect()
    assert [tuple(r) for r in about] == [("T", "nir", 500000.0, 10.0, 1400000.0, -20.0, nx, ny, 65535.0, 32647)]


def test_only_blocks_with_points_are_read(spark, tmp_path):
    values = np.arange(64 * 64).reshape(64, 64)
    (tmp_path / "a.tif").write_bytes(files.tiff_bytes(values, 16, (0.0, 640.0), (10.0, -10.0), 32647, None))
    found = geotiff.index(spark.createDataFrame([("T", 1, "nir", f"{tmp_path}/a.tif")], "tile string, scene_id long, band string, path string"), 16)
    points = spark.createDataFrame([("T", 5.0, 635.0), ("T", 6.0, 634.0), ("T", 639.0, 1.0), ("T", -50.0, 0.0), ("U", 5.0, 5.0)], "tile string, x double, y double")
    own = geotiff.needed(found, points, geotiff.meta(found), Config(block=16), ["nir", "red"])
    assert sorted((r["bx"], r["by"]) for r in own.collect()) == [(0, 0), (3, 3)]
    assert {r["data"][0] for r in geotiff.blocks(own, 16, "double").collect()} == {0.0, 48 * 64 + 48.0}


def big_tiff(values, dtype, tags):
    """A Big TIFF in the other byte order, one strip."""
    body = values.astype(dtype).tobytes()
    size = np.dtype(dtype).itemsize
    every = [(256, 3, [values.shape[1]]), (257, 3, [values.shape[0]]), (258, 3, [8 * size]), (273, 16, [16]), (279, 16, [len(body)]), (339, 3, [{"u": 1, "i": 2, "f": 3}[np.dtype(dtype).kind]]), *tags]
    start = 16 + len(body)
    out, tail, room = struct.pack(">Q", len(every)), b"", start + 8 + 20 * len(every) + 8
    for tag, kind, told in sorted(every):
        data = told if kind == 2 else np.array(told, {3: ">u2", 12: ">f8", 16: ">u8"}[kind]).tobytes()
        n = len(told)
        out += struct.pack(">HHQ", tag, kind, n) + (data.ljust(8, b"\0") if len(data) <= 8 else struct.pack(">Q", room + len(tail)))
        tail += data if len(data) > 8 else b""
    return b"MM" + struct.pack(">HHHQ", 43, 8, 0, start) + body + out + bytes(8) + tail


def test_big_files_the_other_way_round(spark, tmp_path):
    values = np.linspace(-1, 1, 35).reshape(5, 7)
    tags = [(34264, 12, [10.0, 0, 0, 100.0, 0, -10.0, 0, 200.0, 0, 0, 0, 0, 0, 0, 0, 1]), (34735, 3, [1, 1, 0, 2, 1025, 0, 1, 2, 2048, 0, 1, 4326]), (42113, 2, b"-9999 \0")]
    (tmp_path / "b.tif").write_bytes(big_tiff(values, ">f4", tags))
    found = geotiff.index(spark.createDataFrame([(3, 1, "nir", f"{tmp_path}/b.tif")], "tile int, scene_id long, band string, path string"), 16)
    row = geotiff.blocks(found, 16, "double").first()
    assert row["tile"] == 3 and np.array_equal(np.array(row["data"]).reshape(5, 7), values.astype(np.float32).astype(float))
    # The tie is a pixel's middle.
    assert tuple(geotiff.meta(found).first())[2:] == (95.0, 10.0, 205.0, -10.0, 7, 5, -9999.0, 4326)


@pytest.mark.parametrize("tags,message", [([(259, 3, [5])], "compression 5"), ([], "no place on the ground"), ([(34264, 12, [1.0, 0.5] + [0.0] * 14)], "turned")])
def test_what_is_not_read_says_so(tmp_path, tags, message):
    content = big_tiff(np.ones((2, 2)), ">u2", tags)
    with pytest.raises(ValueError, match=message):
        list(geotiff.file_blocks(lambda a, n: content[a : a + n], 16))
    with pytest.raises(ValueError, match="no TIFF"):
        geotiff.directory(lambda a, n: zlib.compress(b"x" * 40)[a : a + n].ljust(n, b"\0"))


def test_queries_read_all_files(spark):
    """The folders of the registered queries hold every plot and raster of the bridge."""
    d = "/root/testdata/sf0.001"
    path = files.folder(spark, "test")
    listed = files.write_rasters(bridge.pixels(spark, d), path, 16, (0.0, 0.0), (1.0, -1.0), 32647, 3999)
    assert listed.count() == len([n for n in os.listdir(path) if n.endswith(".tif")]) == 60


def test_plots_of_one_file_become_points_in_several_tasks(spark):
    """The suppliers lie in one small file; their points are not made, kept and looked up by one task."""
    points = grid.grid(bridge.plots(spark, "/root/testdata/sf0.01")).select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(points) >= 4 and max(r["count"] for r in points) < sum(r["count"] for r in points) / 2
