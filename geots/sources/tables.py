"""Readers of polygon, grid and legacy tables."""

from __future__ import annotations

import functools
import itertools
import os
from collections.abc import Iterator
from datetime import date
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs, text
from ..operators import grid as grid_operator
from ..operators import monthly
from ..shared import map_batches, mounted
from . import vector

GRID_COLUMNS = ("plot_id", "point_id", "lon", "lat")
CELLS = 100_000  # values of a batch of melted columns


def polygons(spark: SparkSession, path: str, epsg: int | None = None, id_order: list[str] | None = None) -> DataFrame:
    """Plots of a GeoParquet table, a GeoPackage or a shapefile: repaired ``parts`` in degrees, with a ``plot_id``.

    ``epsg`` is the source's reference system: by default what a GeoPackage or shapefile says of
    itself, and geographic coordinates otherwise. UTM metres are projected back. Without a
    ``plot_id`` plots are numbered in the order of ``id_order`` (by default the file's keys, or
    the geometry's bytes of a GeoParquet table).
    """
    if is_vector(path):
        plots = vector.read(spark, path)
        if epsg is None:  # one row a file's layer
            found = sorted({r["epsg"] for r in plots.select("epsg").distinct().collect()} - {None})
            if len(found) > 1:
                raise ValueError(f"{path} has layers of several reference systems: {found}")
            epsg = found[0] if found else 4326
        if plots.filter(F.col("attributes")["plot_id"].isNotNull()).isEmpty():
            plots = grid_operator.with_default_id(plots, id_order or ["file", "layer", "fid"])
        else:
            plots = plots.withColumn("plot_id", F.col("attributes")["plot_id"].cast("double").cast("long"))
    else:
        plots = spark.read.parquet(path)
        if "plot_id" not in plots.columns:
            plots = grid_operator.with_default_id(plots, id_order or ["geometry"])
    found = grid_operator.polygons(plots)
    return found if epsg in (None, 4326) else found.withColumn("parts", crs.reprojected(F.col("parts"), epsg, forward=False))


def is_vector(path: str) -> bool:
    return path.lower().endswith((".gpkg", ".shp"))


def polygon_folder(spark: SparkSession, path: str) -> DataFrame:
    """(province, file, fid, epsg, geometry, attributes) of all polygon files of a folder, of all three kinds.

    ``province`` is the file's name in upper case. ``fid`` is a row's number in a Parquet file, a
    key in a GeoPackage, a record's number in a shapefile; ``attributes`` holds the other fields
    that are not null, as text. A folder without such a file is an error.
    """
    # A Parquet table may be a folder of files; its own name counts.
    name = F.regexp_extract("file", r"(?i)([^/]+)\.(?:parquet|gpkg|shp)(?:/[^/]*)?$", 1)
    found = []
    if names := parquet_files(spark, path):
        table = spark.read.option("mergeSchema", "true").parquet(*names)
        others = [c for c in table.columns if c != "geometry"]
        told = F.map_from_arrays(F.array(*(F.lit(c) for c in others)).cast("array<string>"), F.array(*(F.col(f"`{c}`").cast("string") for c in others)).cast("array<string>"))
        found.append(
            table.select(
                F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("fid"), F.lit(None).cast("int").alias("epsg"), "geometry", F.map_filter(told, lambda k, v: v.isNotNull()).alias("attributes")
            )
        )
    if "://" not in path and vector.listed(path):
        found.append(vector.read(spark, path).select("file", "fid", "epsg", "geometry", "attributes"))
    if not found:
        raise ValueError(f"no polygon file in {path}")
    return (found[0] if len(found) == 1 else found[0].unionByName(found[1])).withColumn("province", F.upper(name))


def parquet_files(spark: SparkSession, path: str) -> list[str]:
    """The Parquet files and tables of a folder, sorted by name; none if there is no such folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in files.listStatus(root)] if files.exists(root) else []
    return sorted(p.toString() for p in found if p.getName().endswith(".parquet"))


def geopackage(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """(fid, geometry): a layer of a GeoPackage file."""
    return vector.read(spark, path, layer).select("fid", "geometry")


def tile_index(spark: SparkSession, path: str) -> DataFrame:
    """Tiles (``Name`` as ``tile``) with ``parts``; coordinates in degrees."""
    return grid_operator.polygons(spark.read.parquet(path).withColumnRenamed("Name", "tile"))


def grid(spark: SparkSession, path: str) -> DataFrame:
    """The four columns that a run needs of a grid table; fails where one is missing or no row is."""
    table = spark.read.parquet(path)
    missing = sorted(set(GRID_COLUMNS) - set(table.columns))
    if missing:
        raise ValueError(f"the grid {path} has no column {', '.join(missing)}")
    table = table.select(*GRID_COLUMNS)
    if table.isEmpty():
        raise ValueError(f"the grid {path} has no row")
    return table


def wide_days(spark: SparkSession, path: str) -> DataFrame:
    """(plot_id, point_id, day, v) of a table with one column a day; other columns are left out."""
    table = spark.read.option("mergeSchema", "true").parquet(path)
    days = text.date_columns(table.columns)
    rows = table.unpivot(["plot_id", "point_id"], [F.col(f"`{c}`").cast("double").alias(c) for c in days], "name", "v")
    return rows.select("plot_id", "point_id", text.parsed_day(F.col("name")).alias("day"), "v")


def wide_tables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Wide tables of differing months as one. Each is planned by its own columns: no schemas are merged."""
    return monthly.united([spark.read.parquet(p) for p in paths])


def wide_months(spark: SparkSession, path: str) -> DataFrame:
    """(plot_id, point_id, month, v) of one of a run's four tables."""
    table = spark.read.option("mergeSchema", "true").parquet(path)
    names = text.month_columns(table.columns)
    return table.unpivot(["plot_id", "point_id"], [F.col(f"`{c}`").cast("double").alias(c) for c in names], "month", "v")


def plot_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, plot_id, row, x, y, day, v) of a folder with one file a plot and tile, whose plot id ends its name.

    Every file has columns of its own days. It is melted by its own footer, inside the task that
    it is dealt to, so that no schema of all files is ever put together: the plan is as wide for
    two files as for many thousands. ``row`` numbers a file's points. A day that a file lacks has no
    row, one that holds nothing has a null. Files whose name has no number, or without columns of
    days, are no plots; columns that are neither days nor x and y are not read.
    """
    rows = map_batches(_named(spark, path), _melted, "file string, plot_id long, row int, x double, y double, name string, v double")
    return rows.select("file", "plot_id", "row", "x", "y", text.parsed_day(F.col("name")).alias("day"), "v")


def _named(spark: SparkSession, path: str) -> DataFrame:
    """(path, plot_id) of a folder's plot files, dealt to tasks by number; also their ``content`` where the folder is not mounted.

    Of a mounted folder the driver looks at the folders in it alone. Tasks list those, and the files
    are opened by name, so neither their names nor their sizes are gathered in one place. A file of another
    folder comes from Spark's reader and must fit an executor's memory.
    """
    root = mounted(path) if path.startswith("file:") else path
    if not os.path.isdir(root):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    else:
        root = os.path.abspath(root)
        with os.scandir(root) as entries:
            folders = [(root, False), *((e.path, True) for e in entries if e.is_dir() and not _hidden(e.name))]
        listed = map_batches(spark.createDataFrame(folders, "path string, whole boolean"), _listed, "path string")
        # A number of partitions is named, as names are short and what they name is not.
        found = listed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    named = found.withColumn("plot_id", text.file_plot_id(F.col("path"))).filter("plot_id is not null")
    return named.select("path", "plot_id", *(c for c in found.columns if c == "content"))


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over, too."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _failed(error: OSError) -> None:
    raise error


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The Parquet files of folders, some at a time; of ``whole`` ones also those of the folders inside."""
    for batch in batches:
        for top, whole in zip(batch.column("path").to_pylist(), batch.column("whole").to_pylist()):
            for folder, inner, names in os.walk(top, onerror=_failed, followlinks=True):
                inner[:] = [n for n in inner if whole and not _hidden(n)]
                names = [f"file:{folder}/{n}" for n in names if n.endswith(".parquet") and not _hidden(n)]
                for at in range(0, len(names), CELLS):
                    yield pa.RecordBatch.from_arrays([pa.array(names[at : at + CELLS], pa.string())], names=["path"])


_MELTED = ["file", "plot_id", "row", "x", "y", "name", "v"]


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Scalar, pa.Scalar, pq.ParquetFile, list[str], list[str]]]:
    """(path, plot, file, its columns, those of days) of files with days and rows."""
    for batch in batches:
        held = batch.column("content") if "content" in batch.schema.names else [None] * batch.num_rows
        for path, plot, content in zip(batch.column("path"), batch.column("plot_id"), held):
            with pq.ParquetFile(pa.OSFile(mounted(path.as_py())) if content is None else pa.BufferReader(content.as_buffer())) as source:
                names = source.schema_arrow.names
                days = text.date_columns(names)
                if days and source.metadata.num_rows:
                    yield path, plot, source, names, days


def _melted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A file's columns of days one under the other, some at a time."""
    for path, plot, source, names, days in _opened(batches):
        n = source.metadata.num_rows
        at = source.read([c for c in ("x", "y") if c in names], use_threads=False)
        x, y = (at.column(c).cast(pa.float64()).combine_chunks() if c in names else pa.nulls(n, pa.float64()) for c in ("x", "y"))
        together = max(1, CELLS // n)
        for k in range(0, len(days), together):
            own = days[k : k + together]
            table, rows = source.read(own, use_threads=False), pa.array(np.tile(np.arange(n, dtype=np.int32), len(own)))
            # NaN stands for no value in these files.
            values = pa.chunked_array([c for d in own for c in table.column(d).cast(pa.float64()).chunks], pa.float64()).combine_chunks()
            values = pc.if_else(pc.is_nan(values), pa.scalar(None, pa.float64()), values)
            columns = [pa.repeat(path, len(rows)), pa.repeat(plot, len(rows)), rows, x.take(rows), y.take(rows), pa.array(np.repeat(np.array(own, object), n), pa.string()), values]
            yield pa.RecordBatch.from_arrays(columns, names=_MELTED)


def plot_file_months(spark: SparkSession, path: str) -> DataFrame:
    """(plot_id, month, v): the mean over a file's points of their monthly maximum, and of a plot's files the largest.

    Plots and months without any value have a null. A file's own months are found where it is read, so
    a row a file and month is dealt, and no cell.
    """
    means = map_batches(_named(spark, path), _file_months, "plot_id long, month string, v double")
    return means.groupBy("plot_id", "month").agg(F.max("v").alias("v"))


@functools.lru_cache(100_000)
def _month(name: str) -> str | None:
    """The month of a column of a day; null where the name is no day."""
    try:
        date(*map(int, name.split("/")))
    except ValueError:
        return None
    return name[:7].replace("/", "-")


def _whole_months(days: list[tuple[str, str]], most: int) -> Iterator[list[tuple[str, str]]]:
    """Sorted (month, day) some at a time, at most ``most`` of them, but those of a month together."""
    own: list[tuple[str, str]] = []
    for _, group in itertools.groupby(days, key=itemgetter(0)):
        month = list(group)
        if own and len(own) + len(month) > most:
            yield own
            own = []
        own += month
    if own:
        yield own


def _file_months(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(plot_id, month, v) of each file: the mean of its points' largest values of a month, null if no point has one."""
    schema = pa.schema([("plot_id", pa.int64()), ("month", pa.string()), ("v", pa.float64())])
    plots, months, means = [], [], []
    for _, plot, source, _, days in _opened(batches):
        named = sorted((month, day) for day in days if (month := _month(day)))
        for own in _whole_months(named, max(1, CELLS // source.metadata.num_rows)):
            table = source.read([day for _, day in own], use_threads=False)
            columns = [table.column(day) for _, day in own]
            chunks = [k for c in columns for k in (c if c.type == pa.float64() else c.cast(pa.float64())).chunks]
            cells = pa.concat_arrays(chunks).to_numpy(zero_copy_only=False).reshape(len(own), -1)  # NaN stands for no value
            starts = [k for k, (month, _) in enumerate(own) if not k or month != own[k - 1][0]]
            tops = np.fmax.reduceat(cells, starts)
            held = ~np.isnan(tops)
            sums, counts = np.where(held, tops, 0.0).sum(1).tolist(), held.sum(1).tolist()
            plots += [plot.as_py()] * len(starts)
            months += [own[k][0] for k in starts]
            means += [total / n if n else None for total, n in zip(sums, counts)]
        if len(plots) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((plots, months, means), schema)], schema=schema)
            plots, months, means = [], [], []
    if plots:
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((plots, months, means), schema)], schema=schema)
