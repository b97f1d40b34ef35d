"""GeoPackage layers and shapefiles as tables, each file read by many tasks.

A Python data source plans its own partitions: a GeoPackage layer by ranges of its integer key, a
shapefile by ranges of records, whose places its .shx index holds. A task opens the file by name
and reads its own range only, so that one large file is spread like many small ones. The files
must lie in a folder that the driver and all executors have mounted.

All files give the same columns, so that no schema is merged: (file, layer, epsg, fid, geometry,
attributes). ``geometry`` is WKB; ``attributes`` holds the other fields that are not null, as text.
"""

from __future__ import annotations

import glob
import os
import re
import sqlite3
import struct
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.wkb import MULTI_POLYGON, POLYGON
from ..shared import mounted

SCHEMA = "file string, layer string, epsg int, fid long, geometry binary, attributes map<string,string>"
RECORDS = 50_000  # of a task
BATCH, BATCH_BYTES = 1000, 4 << 20  # records of a batch, and bytes of geometry from which it is sent on
_ARROW = pa.schema([("file", pa.string()), ("layer", pa.string()), ("epsg", pa.int32()), ("fid", pa.int64()), ("geometry", pa.binary()), ("attributes", pa.map_(pa.string(), pa.string()))])

# The shape types of polygons (plain, with heights, with measures) and of no shape.
NO_SHAPE, POLYGON_SHAPES = 0, (5, 15, 25)


@dataclass
class Part(InputPartition):
    """A range of keys (GeoPackage, ends included) or of records (shapefile, end excluded) of one file."""

    file: str
    layer: str
    epsg: int | None
    low: int
    high: int


# GeoPackage --------------------------------------------------------------------------------------


def _opened(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{quote(path)}?mode=ro&immutable=1", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def layer_columns(db: sqlite3.Connection, layer: str) -> tuple[str, str, list[str]]:
    """The geometry column, the key and the other columns of a layer."""
    geom = db.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()
    about = db.execute(f"PRAGMA table_info({_quoted(layer)})").fetchall()
    key = [r[1] for r in about if r[5]]
    if not geom or len(key) != 1:
        raise ValueError(f"{layer} is no layer with a geometry and a key")
    return geom[0], key[0], [r[1] for r in about if r[1] not in (geom[0], key[0])]


def _layer_epsg(db: sqlite3.Connection, layer: str) -> int | None:
    try:
        found = db.execute(
            "SELECT organization, organization_coordsys_id FROM gpkg_geometry_columns JOIN gpkg_spatial_ref_sys USING (srs_id) WHERE table_name = ?", (layer,)
        ).fetchone()
    except sqlite3.OperationalError:  # no table of reference systems
        return None
    return int(found[1]) if found and str(found[0]).upper() == "EPSG" else None


def package_parts(path: str, layer: str | None, records: int) -> Iterator[Part]:
    """Ranges of the layers' keys, as many as their rows need."""
    with closing(_opened(path)) as db:
        for (name,) in db.execute("SELECT table_name FROM gpkg_geometry_columns ORDER BY table_name").fetchall():
            if layer in (None, name):
                _, key, _ = layer_columns(db, name)
                low, high, n = db.execute(f"SELECT min({_quoted(key)}), max({_quoted(key)}), count(*) FROM {_quoted(name)}").fetchone()
                if n:
                    step = -(-(high - low + 1) // -(-n // records))
                    yield from (Part(path, name, _layer_epsg(db, name), a, min(high, a + step - 1)) for a in range(low, high + 1, step))


def package_geometry(blob: bytes) -> bytes:
    """A GeoPackage blob without its header: magic, version, flags, reference system, envelope."""
    envelope = (0, 32, 48, 48, 64)[blob[3] >> 1 & 7]
    return blob[8 + envelope :]


def _package_rows(part: Part) -> Iterator[tuple]:
    with closing(_opened(part.file)) as db:
        geom, key, others = layer_columns(db, part.layer)
        names = ", ".join(map(_quoted, (key, geom, *others)))
        rows = db.execute(f"SELECT {names} FROM {_quoted(part.layer)} WHERE {_quoted(key)} BETWEEN ? AND ? ORDER BY {_quoted(key)}", (part.low, part.high))
        for fid, blob, *values in rows:
            told = [(n, v.hex() if isinstance(v, bytes) else str(v)) for n, v in zip(others, values) if v is not None]
            yield fid, None if blob is None else package_geometry(blob), told


# Shapefile ---------------------------------------------------------------------------------------


def _beside(path: str, extension: str) -> str | None:
    """The file of another extension that belongs to a shapefile."""
    stem = path.rpartition(".")[0]
    return next((p for p in (f"{stem}.{extension}", f"{stem}.{extension.upper()}") if os.path.exists(p)), None)


def projection_epsg(text: str) -> int | None:
    """The EPSG code that a .prj text names: its own, or that of a UTM zone or of geographic WGS 84."""
    own = re.findall(r'AUTHORITY\["EPSG",\s*"(\d+)"\]\]\s*$', text.strip())
    if own:
        return int(own[0])
    zone = re.search(r"WGS[_ ]1984[_ ]UTM[_ ]Zone[_ ](\d+)([NS])", text)
    if zone:
        return (32600 if zone[2] == "N" else 32700) + int(zone[1])
    return 4326 if text.startswith("GEOGCS") and "WGS_1984" in text.upper().replace(" ", "_") else None


def shape_parts(path: str, records: int) -> Iterator[Part]:
    index, about = _beside(path, "shx"), _beside(path, "prj")
    if index is None:
        raise ValueError(f"{path} has no .shx index")
    epsg = None
    if about:
        with open(about, encoding="utf-8", errors="replace") as f:
            epsg = projection_epsg(f.read())
    n = (os.path.getsize(index) - 100) // 8
    layer = os.path.basename(path).rpartition(".")[0]
    yield from (Part(path, layer, epsg, a, min(n, a + records)) for a in range(0, n, records))


def _fields(dbf) -> tuple[int, int, list[tuple[str, str, int]]]:
    """Bytes of the header and of a record, and (name, kind, width) of the fields of a .dbf file."""
    head, record = struct.unpack("<HH", dbf.read(32)[8:12])
    described = dbf.read(head - 32)
    found = []
    for at in range(0, len(described), 32):
        if described[at] == 0x0D:
            break
        name, kind, width = struct.unpack_from("<11sc4xB", described, at)
        found.append((name.split(b"\0")[0].decode("latin-1"), kind.decode(), width))
    return head, record, found


def _shape_rows(part: Part) -> Iterator[tuple]:
    with open(_beside(part.file, "shx"), "rb") as f:
        f.seek(100 + 8 * part.low)
        offsets = np.frombuffer(f.read(8 * (part.high - part.low)), ">i4").reshape(-1, 2)[:, 0].astype(np.int64) * 2
    table, page = _beside(part.file, "dbf"), _beside(part.file, "cpg")
    encoding = "utf-8"
    if page:
        with open(page, encoding="ascii", errors="replace") as f:
            encoding = "latin-1" if "1252" in (told := f.read().strip()) or "8859" in told else "utf-8"
    with open(part.file, "rb") as shapes, open(table or os.devnull, "rb") as dbf:
        head, width, fields = _fields(dbf) if table else (0, 0, [])
        dbf.seek(head + width * part.low)
        for k, offset in enumerate(offsets.tolist()):
            record = dbf.read(width)
            if record[:1] == b"*":  # deleted
                continue
            told, at = [], 1
            for name, kind, size in fields:
                value = record[at : at + size].decode(encoding, "replace").strip(" \0")
                at += size
                if value and not (kind in "NF" and value.startswith("*")) and not (kind == "L" and value == "?"):
                    told.append((name, value))
            shapes.seek(offset + 4)
            content = shapes.read(2 * struct.unpack(">i", shapes.read(4))[0])
            yield part.low + k, shape_wkb(content), told


def shape_wkb(content: bytes) -> bytes | None:
    """A polygon record as WKB: outer rings run clockwise, and a hole belongs to the smallest one around it."""
    kind = struct.unpack_from("<i", content)[0]
    if kind == NO_SHAPE:
        return None
    if kind not in POLYGON_SHAPES:
        raise ValueError(f"shape type {kind} is no polygon")
    n_rings, n_points = struct.unpack_from("<2i", content, 36)
    starts = np.frombuffer(content, "<i4", n_rings, 44).tolist()
    points = np.frombuffer(content, "<f8", 2 * n_points, 44 + 4 * n_rings).reshape(-1, 2)
    rings = [points[a:b] for a, b in zip(starts, [*starts[1:], n_points])]
    areas = [_area(r) for r in rings]
    outer = [k for k, a in enumerate(areas) if a <= 0]
    polygons = {k: [rings[k]] for k in outer}
    for k, area in enumerate(areas):
        if area > 0:
            around = [o for o in outer if -areas[o] >= area and _holds(rings[o], rings[k])]
            home = max(around, key=lambda o: areas[o], default=None)
            polygons.setdefault(k if home is None else home, []).append(rings[k])
    each = [struct.pack("<BII", 1, POLYGON, len(p)) + b"".join(struct.pack("<I", len(r)) + r.astype("<f8").tobytes() for r in p) for p in polygons.values()]
    return each[0] if len(each) == 1 else struct.pack("<BII", 1, MULTI_POLYGON, len(each)) + b"".join(each)


def _area(ring: np.ndarray) -> float:
    """Twice the signed area about the first vertex: positive for a ring that runs counter-clockwise."""
    x, y = (ring - ring[0]).T if len(ring) else np.zeros((2, 0))
    return float(x[:-1] @ y[1:] - x[1:] @ y[:-1])


def _holds(ring: np.ndarray, inner: np.ndarray) -> bool:
    """Whether the middle of an edge of ``inner`` lies inside ``ring`` (even-odd)."""
    px, py = (inner[0] + inner[1]) / 2
    (x1, y1), (x2, y2) = ring[:-1].T, ring[1:].T
    cross = (y1 <= py) != (y2 <= py)
    x = x1[cross] + (py - y1[cross]) * (x2 - x1)[cross] / (y2 - y1)[cross]
    return bool(np.count_nonzero(x > px) % 2)


# The data source ---------------------------------------------------------------------------------


def listed(path: str, extensions: tuple[str, ...] = ("gpkg", "shp")) -> list[str]:
    """The vector files of a folder (or the file itself): by extension in the order given, then by name."""
    path = mounted(path)
    if not os.path.isdir(path):
        return [path]
    names = sorted(glob.glob(f"{glob.escape(path)}/*"))
    return [n for e in extensions for n in names if n.lower().endswith(f".{e}")]


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.files = listed(options["path"])
        self.layer, self.records = options.get("layer"), int(options.get("records", RECORDS))

    def partitions(self) -> list[InputPartition]:
        found = [p for f in self.files for p in (shape_parts(f, self.records) if f.lower().endswith(".shp") else package_parts(f, self.layer, self.records))]
        return found or [Part("", "", None, 0, 0)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if not part.file:
            return
        rows, held = [], 0
        for fid, geometry, told in _shape_rows(part) if part.file.lower().endswith(".shp") else _package_rows(part):
            rows.append((part.file, part.layer, part.epsg, fid, geometry, told))
            held += len(geometry or b"")
            if len(rows) >= BATCH or held > BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


class VectorFiles(DataSource):
    """``spark.read.format("vector_files")``; options: layer (of GeoPackages), records (of a task)."""

    @classmethod
    def name(cls) -> str:
        return "vector_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))


def read(spark: SparkSession, path: str, layer: str | None = None, records: int = RECORDS) -> DataFrame:
    """(file, layer, epsg, fid, geometry, attributes) of a GeoPackage, a shapefile or a folder of both.

    ``fid`` is a GeoPackage row's key or a shapefile record's number, from 0. Null geometries stay
    null; deleted records of a shapefile go; a shape that is no polygon is an error, as is a
    shapefile without its index; a folder without such files gives no rows.
    """
    spark.dataSource.register(VectorFiles)
    reader = spark.read.format("vector_files").option("records", records)
    return (reader.option("layer", layer) if layer else reader).load(path)
