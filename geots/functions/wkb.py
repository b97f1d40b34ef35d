"""Well-known binary: geometry columns decoded and encoded in Arrow batches."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PARTS = T.ArrayType(T.ArrayType(T.ArrayType(_VERTEX)))

# Geometry types of the format.
POINT, POLYGON, MULTI_POLYGON, COLLECTION = 1, 3, 6, 7


class _Parser:
    """Reads one geometry; keeps its polygons and steps over points and lines."""

    def __init__(self, data: bytes):
        self.data, self.at, self.polygons = data, 0, []

    def take(self, kind: str):
        value = struct.unpack_from(kind, self.data, self.at)
        self.at += struct.calcsize(kind)
        return value[0]

    def coordinates(self, order: str, dims: int) -> np.ndarray:
        n = self.take(order + "I")
        values = np.frombuffer(self.data, order + "f8", n * dims, self.at).reshape(n, dims)
        self.at += 8 * n * dims
        return values

    def geometry(self) -> None:
        order = "<" if self.take("B") else ">"
        code = self.take(order + "I")
        if code & 0x20000000:  # a reference system number stands before the rest
            self.take(order + "I")
        dims = 2 + bool(code & 0x80000000) + bool(code & 0x40000000) + (0, 1, 1, 2)[(code & 0xFFFF) // 1000 % 4]
        kind = (code & 0xFFFF) % 1000
        if kind == POLYGON:
            rings = [self.coordinates(order, dims) for _ in range(self.take(order + "I"))]
            if rings:
                self.polygons.append([r[:, :2] for r in rings])
        elif kind == POINT:
            self.at += 8 * dims
        elif kind == 2:
            self.coordinates(order, dims)
        elif kind in (4, 5, MULTI_POLYGON, COLLECTION):
            for _ in range(self.take(order + "I")):
                self.geometry()
        else:
            raise ValueError(f"geometry type {code}")


def rings_of(data: bytes | None) -> list[list[np.ndarray]] | None:
    """A geometry's polygons as lists of rings: arrays of (x, y)."""
    if data is None:
        return None
    parser = _Parser(bytes(data))
    parser.geometry()
    return parser.polygons


def polygons_of(data: bytes | None) -> list | None:
    found = rings_of(data)
    return found if found is None else [[[{"x": x, "y": y} for x, y in r.tolist()] for r in rings] for rings in found]


@F.pandas_udf(PARTS)
def decoded(wkb: pd.Series) -> pd.Series:
    """``parts`` of a geometry column: polygons, multipolygons, and the polygons of collections.

    Points and lines have no parts; null stays null; bytes that are no geometry raise an error.
    """
    return wkb.map(polygons_of, na_action="ignore")


def polygon_bytes(parts) -> bytes | None:
    """A geometry's bytes: one polygon as such, several as a multipolygon."""
    if parts is None:
        return None

    def polygon(rings) -> bytes:
        out = [struct.pack("<BII", 1, POLYGON, len(rings))]
        for ring in rings:
            values = np.array([(v["x"], v["y"]) for v in ring], "<f8")
            out.append(struct.pack("<I", len(values)) + values.tobytes())
        return b"".join(out)

    each = [polygon(rings) for rings in parts]
    return each[0] if len(each) == 1 else struct.pack("<BII", 1, MULTI_POLYGON, len(each)) + b"".join(each)


@F.arrow_udf(T.BinaryType())
def encoded(parts: pa.Array) -> pa.Array:
    """A geometry's bytes; null stays null. Parts may differ in their number of rings."""
    return pa.array((polygon_bytes(p.as_py()) for p in parts), pa.binary())


@F.pandas_udf(T.BinaryType())
def point_wkb(x: pd.Series, y: pd.Series) -> pd.Series:
    """A point's bytes; null where a coordinate is null."""
    rows = np.zeros(len(x), np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")]))
    rows["order"], rows["kind"], rows["x"], rows["y"] = 1, POINT, x, y
    size, data = rows.dtype.itemsize, rows.tobytes()
    out = pd.Series([data[i : i + size] for i in range(0, len(data), size)], index=x.index, dtype=object)
    return out.where(x.notna() & y.notna(), None)
