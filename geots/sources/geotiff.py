"""GeoTIFF rasters as tables of blocks, of which only those are read that a query needs.

``index`` reads the directories of many files in parallel and gives a row for each square block:
where in the file the bytes lie that it is made of. Being a table, it is pruned like any other: a
semi-join with the blocks that points fall into (``needed``) leaves the ranges to read. ``blocks``
reads those ranges and gives the table of blocks that ``operators.sampling`` takes. ``meta`` gives
the rasters' places on the ground, their reference system and no-data value, from the same rows.

Read are one sample of classic and Big TIFF files, tiled or in strips, plain or deflated, with or
without horizontal differences; other compressions are an error that names them. A block that
spans strips reads them whole. Files must be in a folder that driver and executors have mounted.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..config import Config
from ..operators import sampling
from ..shared import map_batches, mounted

# Numbers of the format. Bytes and NumPy kinds of directory entries, by type.
KINDS = {1: "u1", 2: "S1", 3: "u2", 4: "u4", 5: "u8", 6: "i1", 8: "i2", 9: "i4", 11: "f4", 12: "f8", 13: "u4", 16: "u8", 17: "i8", 18: "u8"}
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, STRIP_ROWS, STRIP_BYTES, PLANES, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, SAMPLE_FORMAT = 322, 323, 324, 325, 339
PIXEL_SCALE, TIEPOINT, TRANSFORMATION, GEO_KEYS, NO_DATA = 33550, 33922, 34264, 34735, 42113
RASTER_TYPE, GEOGRAPHIC, PROJECTED, POINT_PIXELS, USER_DEFINED = 1025, 2048, 3072, 2, 32767
PLAIN, DEFLATE, OLD_DEFLATE = 1, 8, 32946

#: What reading a damaged, cut off, absent or unsupported file raises.
BROKEN = (OSError, ValueError, KeyError, IndexError, struct.error, zlib.error)

_PIECE = "struct<offset:long,size:long,x:int,y:int>"
_GRID = "gx double, gw double, gy double, gh double, nx int, ny int, nodata double, epsg int"
_LAYOUT = "kind string, samples int, compression int, predictor int, wide int, tall int"
INDEX = f"tile {{tile}}, scene_id long, band string, path string, bx int, by int, {_GRID}, {_LAYOUT}, pieces array<{_PIECE}>, problem string"


def directory(read: Callable[[int, int], bytes]) -> tuple[str, dict[int, np.ndarray]]:
    """Byte order and the entries of the first directory; ``read`` takes an offset and a size."""
    head = read(0, 16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack(f"{order or '<'}H", head[2:4])[0]
    if order is None or version not in (42, 43):
        raise ValueError("no TIFF file")
    big = version == 43
    at = struct.unpack(order + "Q", head[8:16])[0] if big else struct.unpack(order + "I", head[4:8])[0]
    count, word, entry = ("Q", "Q", 20) if big else ("H", "I", 12)
    n = struct.unpack(order + count, read(at, struct.calcsize(count)))[0]
    rows = read(at + struct.calcsize(count), n * entry)
    found = {}
    for k in range(n):
        tag, kind, items = struct.unpack_from(f"{order}HH{word}", rows, k * entry)
        if kind not in KINDS:
            continue
        size = np.dtype(KINDS[kind]).itemsize * items
        room = struct.calcsize(word)
        data = rows[k * entry + entry - room :][:room]
        if size > room:
            data = read(struct.unpack(order + word, data)[0], size)
        found[tag] = np.frombuffer(data[:size], np.dtype(KINDS[kind]).newbyteorder(order))
    return order, found


def placed(tags: dict[int, np.ndarray]) -> tuple[float, float, float, float, int | None]:
    """Origin and step in x, origin and step in y, and the EPSG code if the keys name one."""
    keys = {int(k): (int(where), int(v)) for k, where, _, v in tags.get(GEO_KEYS, np.empty(0, int))[4:].reshape(-1, 4).tolist()}
    code = next((v for key in (PROJECTED, GEOGRAPHIC) for where, v in [keys.get(key, (1, 0))] if not where and v not in (0, USER_DEFINED)), None)
    if TRANSFORMATION in tags:
        m = tags[TRANSFORMATION].tolist()
        if m[1] or m[4]:
            raise ValueError("the raster is turned against its reference system")
        gx, gw, gy, gh = m[3], m[0], m[7], m[5]
    elif PIXEL_SCALE in tags and TIEPOINT in tags:
        (sx, sy), (i, j, _, x, y) = tags[PIXEL_SCALE].tolist()[:2], tags[TIEPOINT].tolist()[:5]
        gx, gw, gy, gh = x - i * sx, sx, y + j * sy, -sy
    else:
        raise ValueError("the raster has no place on the ground")
    if keys.get(RASTER_TYPE, (0, 1))[1] == POINT_PIXELS:  # the tie is a pixel's middle
        gx, gy = gx - gw / 2, gy - gh / 2
    return float(gx), float(gw), float(gy), float(gh), code


def file_blocks(read: Callable[[int, int], bytes], block: int) -> Iterator[dict]:
    """A row of ``INDEX`` for each block of ``block`` squared pixels, without the columns that name the raster."""
    order, tags = directory(read)

    def one(tag: int, default: int) -> int:
        return int(tags[tag][0]) if tag in tags else default

    nx, ny, samples = one(WIDTH, 0), one(HEIGHT, 0), one(SAMPLES, 1)
    compression, predictor = one(COMPRESSION, PLAIN), one(PREDICTOR, 1)
    if compression not in (PLAIN, DEFLATE, OLD_DEFLATE) or predictor not in (1, 2):
        raise ValueError(f"compression {compression} with predictor {predictor} is not read")
    if samples > 1 and one(PLANES, 1) != 1:
        raise ValueError("samples in planes are not read")
    letter = {1: "u", 2: "i", 3: "f"}[one(SAMPLE_FORMAT, 1)]
    kind = f"{order}{letter}{one(BITS, 1) // 8}"
    if TILES in tags:
        wide, tall, offsets, sizes = one(TILE_WIDTH, 0), one(TILE_HEIGHT, 0), tags[TILES], tags[TILE_BYTES]
    else:
        wide, tall, offsets, sizes = nx, min(one(STRIP_ROWS, ny), ny), tags[STRIPS], tags[STRIP_BYTES]
    gx, gw, gy, gh, epsg = placed(tags)
    told = tags[NO_DATA].tobytes().split(b"\0")[0].strip() if NO_DATA in tags else b""
    fixed = {"gx": gx, "gw": gw, "gy": gy, "gh": gh, "nx": nx, "ny": ny, "nodata": float(told) if told else None, "epsg": epsg}
    fixed |= {"kind": kind, "samples": samples, "compression": compression, "predictor": predictor, "wide": wide, "tall": tall}
    across = -(-nx // wide)
    for by in range(-(-ny // block)):
        for bx in range(-(-nx // block)):
            rows = range(by * block // tall, -(-min(ny, (by + 1) * block) // tall))
            columns = range(bx * block // wide, -(-min(nx, (bx + 1) * block) // wide))
            pieces = [{"offset": int(offsets[r * across + c]), "size": int(sizes[r * across + c]), "x": c * wide, "y": r * tall} for r in rows for c in columns]
            yield {"bx": bx, "by": by, **fixed, "pieces": pieces, "problem": None}


def _reader(f) -> Callable[[int, int], bytes]:
    def read(at: int, size: int) -> bytes:
        f.seek(at)
        return f.read(size)

    return read


def index(files: DataFrame, block: int, broken: str = "error") -> DataFrame:
    """A row for each block of the rasters ``files`` (tile, scene_id, band, path); see ``INDEX``.

    A null path has no blocks; a file named twice has its blocks twice. A file that cannot be read
    is an error or, with ``broken`` "skip", one row of no place with the ``problem`` told.
    """
    own = files.select("tile", F.col("scene_id").cast("long").alias("scene_id"), "band", "path").filter("path is not null")
    schema = T._parse_datatype_string(INDEX.format(tile=own.schema["tile"].dataType.simpleString()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    with open(mounted(row["path"]), "rb") as f:
                        found = [row | b for b in file_blocks(_reader(f), block)]
                except BROKEN as e:
                    if broken != "skip":
                        raise
                    found = [dict.fromkeys(schema.names) | row | {"problem": f"{type(e).__name__}: {e}"}]
                for at in range(0, len(found), 4096):
                    part = found[at : at + 4096]
                    arrays = [pa.array([r[n] for r in part], k) for n, k in zip(schema.names, _arrow(schema))]
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return map_batches(own, run, schema)


def _arrow(schema: T.StructType) -> list[pa.DataType]:
    return [to_arrow_type(f.dataType) for f in schema]


def meta(found: DataFrame) -> DataFrame:
    """(tile, band, gx, gw, gy, gh, nx, ny, nodata, epsg): one row a tile and band, from ``index``.

    A tile's scenes lie on one grid; the first in order of their ids speaks for all.
    """
    names = ["gx", "gw", "gy", "gh", "nx", "ny", "nodata", "epsg"]
    return found.filter("bx = 0 and by = 0").groupBy("tile", "band").agg(F.min_by(F.struct(*names), "scene_id").alias("m")).select("tile", "band", "m.*")


def needed(found: DataFrame, points: DataFrame, about: DataFrame, config: Config, bands: list[str]) -> DataFrame:
    """Rows of ``index`` whose block holds a point (tile, x, y) in one of ``bands``.

    Bands on one grid are looked at together, so that points are gone through once a grid.
    """
    place = ["tile", "gx", "gw", "gy", "gh", "nx", "ny"]
    grids = about.filter(F.col("band").isin(bands)).groupBy(*place).agg(F.collect_set("band").alias("bands")).withColumn("band", F.lit("all"))
    at = sampling.placed(points.select("tile", "x", "y"), grids, "all", config)
    held = at.select("tile", "bands", *(F.floor(F.col(p) / config.block).cast("int").alias(c) for p, c in (("px", "bx"), ("py", "by")))).distinct()
    wanted = held.select("tile", F.explode("bands").alias("band"), "bx", "by").distinct()
    return found.join(wanted, ["tile", "band", "bx", "by"], "left_semi")


def decoded(data: bytes, kind: str, samples: int, compression: int, predictor: int, wide: int) -> np.ndarray:
    """The first sample of a tile or strip, as rows."""
    raw = data if compression == PLAIN else zlib.decompress(data)
    values = np.frombuffer(raw, kind).reshape(-1, wide, samples)
    if predictor == 2:
        values = np.cumsum(values, 1, dtype=values.dtype.newbyteorder("="))
    return values[:, :, 0]


def _block(read: Callable[[int, int], bytes], row: dict, block: int) -> np.ndarray:
    """A block's values, cropped at the raster's edge."""
    x0, y0 = row["bx"] * block, row["by"] * block
    x1, y1 = min(x0 + block, row["nx"]), min(y0 + block, row["ny"])
    out = np.zeros((y1 - y0, x1 - x0), np.dtype(row["kind"]).newbyteorder("="))
    for p in row["pieces"]:
        if not p["size"]:  # left out of the file: zeros
            continue
        own = decoded(read(p["offset"], p["size"]), row["kind"], row["samples"], row["compression"], row["predictor"], row["wide"])
        a, b = max(x0, p["x"]), min(x1, p["x"] + row["wide"])
        c, d = max(y0, p["y"]), min(y1, p["y"] + len(own))
        out[c - y0 : d - y0, a - x0 : b - x0] = own[c - p["y"] : d - p["y"], a - p["x"] : b - p["x"]]
    return out


def blocks(found: DataFrame, block: int, kind: str = "int", broken: str = "error", bands: list[str] | None = None) -> DataFrame:
    """(tile, scene_id, band, bx, by, data): the blocks of rows of ``index``, their bytes read and decoded.

    ``data`` is an array of ``kind`` ("int", "long" or "double"). Rows of a file are read in order of
    their place in it where they come in one task; each is read by itself, so any task can do it again.
    A block that cannot be read is an error or, with ``broken`` "skip", a null. Where ``bands`` are
    given each is a branch of its own, so that a later filter by band decodes no other.
    """
    names = ["tile", "scene_id", "band", "path", "bx", "by", "nx", "ny", *(part.split()[0] for part in _LAYOUT.split(", ")), "pieces"]
    own = found.select(*names)
    numbers = {"int": np.int32, "long": np.int64, "double": np.float64}[kind]
    schema = T.StructType([*(own.schema[n] for n in ("tile", "scene_id", "band", "bx", "by")), T.StructField("data", T.ArrayType(T._parse_datatype_string(kind)))])
    run = partial(_decode, block=block, numbers=numbers, skip=broken == "skip")
    if bands is None:
        return map_batches(own, run, schema)
    return functools.reduce(DataFrame.unionByName, (map_batches(own.filter(F.col("band") == b), run, schema).withColumn("band", F.lit(b)) for b in bands))


def _decode(batches: Iterator[pa.RecordBatch], block: int, numbers: type, skip: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 16):
            part = batch.slice(at, 16)
            data, path, f = [], None, None
            try:
                for row in part.to_pylist():
                    try:
                        if row["path"] != path:
                            if f:
                                f.close()
                            path, f = None, None
                            path, f = row["path"], open(mounted(row["path"]), "rb")  # noqa: SIM115
                        data.append(_block(_reader(f), row, block).astype(numbers).ravel())
                    except BROKEN:
                        if not skip:
                            raise
                        data.append(None)
            finally:
                if f:
                    f.close()
            kind = pa.list_(pa.from_numpy_dtype(numbers))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("tile", "scene_id", "band", "bx", "by")), pa.array(data, kind)], names=["tile", "scene_id", "band", "bx", "by", "data"])
