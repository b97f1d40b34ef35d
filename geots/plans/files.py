"""Files of the formats that the readers take, written by tasks from the bridge's tables.

They stand in for a user's folders in the registered queries. A file is written beside its name
and then moved there, so that a task that runs twice does no harm.
"""

from __future__ import annotations

import itertools
import os
import shutil
import sqlite3
import struct
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import closing
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import wkb
from ..shared import map_batches, mounted, shared_dir

FOLDERS = 1000  # of plot files


def folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one."""
    path = f"{mounted(shared_dir(spark))}/geots-{label}-{uuid.uuid4().hex}"
    os.makedirs(path)
    return path


def put(path: str, content: bytes) -> None:
    beside = f"{path}.{uuid.uuid4().hex}"
    with open(beside, "wb") as f:
        f.write(content)
    os.replace(beside, path)


def write_each(df: DataFrame, write, parts: int) -> int:
    """Let ``write(number of the task, rows)`` make a file of each part's rows; how many rows there were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        if rows:
            write(TaskContext.get().partitionId(), rows)
        yield pa.RecordBatch.from_arrays([pa.array([len(rows)])], names=["n"])

    return df.repartition(parts).mapInArrow(run, "n long").agg(F.sum("n")).first()[0]


def write_packages(plots: DataFrame, path: str, epsg: int, parts: int = 2) -> None:
    """``plots`` (plot_id, parts) as GeoPackages with a layer "plots"."""

    def write(k: int, rows: list[dict]) -> None:
        own = os.path.join(tempfile.mkdtemp(), "own.gpkg")
        header = b"GP\0\1" + struct.pack("<i", epsg)
        with closing(sqlite3.connect(own)) as db:
            db.execute("CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT, organization_coordsys_id INTEGER, definition TEXT)")
            db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES ('', ?, 'EPSG', ?, '')", (epsg, epsg))
            db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z INTEGER, m INTEGER)")
            db.execute("INSERT INTO gpkg_geometry_columns VALUES ('plots', 'geom', 'GEOMETRY', ?, 0, 0)", (epsg,))
            db.execute("CREATE TABLE plots (fid INTEGER PRIMARY KEY, geom BLOB, plot_id INTEGER, note TEXT)")
            db.executemany("INSERT INTO plots (geom, plot_id) VALUES (?, ?)", [(header + wkb.polygon_bytes(r["parts"]), r["plot_id"]) for r in rows])
            db.commit()
        shutil.copy(own, f"{path}/own-{k}.tmp")
        os.replace(f"{path}/own-{k}.tmp", f"{path}/package_{k}.gpkg")
        shutil.rmtree(os.path.dirname(own))

    write_each(plots, write, parts)


def shape_record(parts: list) -> bytes:
    """A polygon record: outer rings clockwise, holes the other way."""
    rings = []
    for polygon in parts:
        for k, ring in enumerate(polygon):
            points = np.array([(v["x"], v["y"]) for v in ring], "<f8")
            (x1, y1), (x2, y2) = points[:-1].T, points[1:].T
            clockwise = float((x1 - points[0, 0]) @ (y2 - points[0, 1]) - (x2 - points[0, 0]) @ (y1 - points[0, 1])) < 0
            rings.append(points if clockwise == (k == 0) else points[::-1])
    every = np.concatenate(rings)
    starts = np.cumsum([0, *(len(r) for r in rings[:-1])]).astype("<i4")
    return struct.pack("<i4d2i", 5, *every.min(0), *every.max(0), len(rings), len(every)) + starts.tobytes() + every.tobytes()


def write_shapes(plots: DataFrame, path: str, projection: str, parts: int = 2) -> None:
    """``plots`` (plot_id, parts) as shapefiles with a field plot_id."""

    def write(k: int, rows: list[dict]) -> None:
        records = [shape_record(r["parts"]) for r in rows]
        at = np.cumsum([50, *(4 + len(r) // 2 for r in records)])

        def head(words: int) -> bytes:
            return struct.pack(">i20xi", 9994, words) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8)

        put(f"{path}/shapes_{k}.shx", head(50 + 4 * len(records)) + b"".join(struct.pack(">2i", int(a), len(r) // 2) for a, r in zip(at, records)))
        field = struct.pack("<11sc4xBB14x", b"plot_id", b"N", 18, 0)
        table = struct.pack("<B3xiHH20x", 3, len(rows), 65, 19) + field + b"\r" + b"".join(b" " + str(r["plot_id"]).rjust(18).encode() for r in rows)
        put(f"{path}/shapes_{k}.dbf", table)
        put(f"{path}/shapes_{k}.prj", projection.encode())
        put(f"{path}/shapes_{k}.shp", head(int(at[-1])) + b"".join(struct.pack(">2i", i + 1, len(r) // 2) + r for i, r in enumerate(records)))

    write_each(plots, write, parts)


def write_plot_files(observations: DataFrame, path: str) -> None:
    """(tile_no, plot_id, point_id, day, v) as a file a tile and plot, with a column for each of its days.

    The files lie in folders by plot, at most FOLDERS of them.
    """

    def write(tile: int, plot: int, rows: list[tuple]) -> None:
        points, days = ({v: k for k, v in enumerate(sorted({r[c] for r in rows}))} for c in (0, 1))
        cells = np.full((len(days), len(points)), np.nan)
        for point, day, v in rows:
            cells[days[day], points[point]] = np.nan if v is None else v
        places = np.array([list(points), [np.nan if plot is None else plot] * len(points)], float)
        flat = pa.array(np.concatenate((places, cells)).ravel(), from_pandas=True)
        columns = [flat.slice(k, len(points)) for k in range(0, len(flat), len(points))]
        table = pa.Table.from_arrays(columns, names=["x", "y", *days])
        sink = pa.BufferOutputStream()
        # A file of a few values is mostly descriptions of columns, so these are short.
        pq.write_table(table, sink, use_dictionary=False, write_statistics=False, store_schema=False, compression="none")
        folder = f"{path}/{(plot or 0) % FOLDERS}"
        os.makedirs(folder, exist_ok=True)
        put(f"{folder}/tile{tile}_{plot}.parquet", sink.getvalue())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for (tile, plot), own in itertools.groupby(rows, key=itemgetter(0, 1)):
            write(tile, plot, [r[2:] for r in own])
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    named = observations.select("tile_no", "plot_id", "point_id", F.date_format("day", "yyyy/MM/dd").alias("name"), "v")
    dealt = named.repartition("tile_no", "plot_id").sortWithinPartitions("tile_no", "plot_id")
    map_batches(dealt, run, "n long").agg(F.sum("n")).collect()


def tiff_bytes(values: np.ndarray, block: int, origin: tuple[float, float], step: tuple[float, float], epsg: int, nodata: int | None, tiled: bool = True) -> bytes:
    """A one-band GeoTIFF of unsigned 16-bit numbers: deflated tiles with horizontal differences, or plain strips."""
    ny, nx = values.shape
    tall, wide = (block, block) if tiled else (block, nx)
    pieces = []
    for by in range(0, ny, tall):
        for bx in range(0, nx, wide):
            own = values[by : by + tall, bx : bx + wide].astype("<u2")
            if tiled:
                own = np.pad(own, ((0, tall - own.shape[0]), (0, wide - own.shape[1])))
                own = np.concatenate((own[:, :1], own[:, 1:] - own[:, :-1]), 1)
                pieces.append(zlib.compress(own.tobytes()))
            else:
                pieces.append(own.tobytes())
    sizes = [len(p) for p in pieces]
    offsets = [8 + sum(sizes[:k]) for k in range(len(sizes))]
    keys = [1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, epsg]
    layout = [(322, 3, [wide]), (323, 3, [tall]), (324, 4, offsets), (325, 4, sizes)] if tiled else [(273, 4, offsets), (278, 3, [tall]), (279, 4, sizes)]
    tags = [
        (256, 3, [nx]), (257, 3, [ny]), (258, 3, [16]), (259, 3, [8 if tiled else 1]), (262, 3, [1]), (277, 3, [1]), (317, 3, [2 if tiled else 1]), (339, 3, [1]), *layout,
        (33550, 12, [step[0], -step[1], 0.0]), (33922, 12, [0.0, 0.0, 0.0, origin[0], origin[1], 0.0]), (34735, 3, keys),
    ]
    if nodata is not None:
        tags.append((42113, 2, str(nodata)))
    body = b"".join(pieces)
    body += b"\0" * (len(body) % 2)
    start, entries, tail = 8 + len(body), b"", b""
    room = start + 2 + 12 * len(tags) + 4
    for tag, kind, told in sorted(tags):
        data = told.encode() + b"\0" if kind == 2 else np.array(told, {3: "<u2", 4: "<u4", 12: "<f8"}[kind]).tobytes()
        count = len(data) if kind == 2 else len(told)
        if len(data) <= 4:
            entries += struct.pack("<HHI", tag, kind, count) + data.ljust(4, b"\0")
        else:
            entries += struct.pack("<HHII", tag, kind, count, room + len(tail))
            tail += data + b"\0" * (len(data) % 2)
    return b"II*\0" + struct.pack("<I", start) + body + struct.pack("<H", len(tags)) + entries + b"\0\0\0\0" + tail


def write_rasters(pixels: DataFrame, path: str, block: int, origin: tuple[float, float], step: tuple[float, float], epsg: int, nodata: int) -> DataFrame:
    """(tile, scene_id, band, px, py, dn) as a GeoTIFF a tile, scene and band; (tile, scene_id, band, path). Odd scenes are strips."""

    def run(part: pa.Table) -> pa.Table:
        px, py, dn = (part.column(c).to_numpy() for c in ("px", "py", "dn"))
        values = np.full((py.max() + 1, px.max() + 1), nodata, np.uint16)
        values[py, px] = dn
        tile, scene, band = (part.column(c)[0].as_py() for c in ("tile", "scene_id", "band"))
        name = f"{path}/T{tile}_{scene}_{band}.tif"
        put(name, tiff_bytes(values, block, origin, step, epsg, nodata, tiled=scene % 2 == 0))
        return pa.table({"tile": [tile], "scene_id": [scene], "band": [band], "path": [name]})

    return pixels.groupBy("tile", "scene_id", "band").applyInArrow(run, "tile long, scene_id long, band string, path string")
