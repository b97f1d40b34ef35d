"""Command line: ``python -m geots grid ...`` and ``python -m geots monthly ...``."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import Config
from .operators import grid
from .plans import run
from .sources import sinks, tables, vector


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="geots")
    jobs = top.add_subparsers(dest="job", required=True)
    g = jobs.add_parser("grid", help="grid points of polygon files")
    source = g.add_mutually_exclusive_group(required=True)
    source.add_argument("--polygon-file")
    source.add_argument("--polygon-dir")
    g.add_argument("--grid-dir", default=".")
    g.add_argument("--output-file")
    g.add_argument("--overwrite", action="store_true")
    m = jobs.add_parser("monthly", help="monthly statistics; further settings come from the environment")
    for name in ("scenes", "tiles"):
        m.add_argument(f"--{name}", required=True, help=f"table of {name}")
    m.add_argument("--blocks", help="table of blocks, with --meta")
    m.add_argument("--meta", help="table of the blocks' places")
    m.add_argument("--rasters", help="table of GeoTIFF files (tile, scene_id, band, path) instead of both")
    return top


def polygon_files(spark: SparkSession, folder: str) -> list[str]:
    """The polygon files of a folder: Parquet, then GeoPackages, then shapefiles; an error where there is none."""
    names = tables.parquet_files(spark, folder) + ([] if "://" in folder else vector.listed(folder))
    if not names:
        raise SystemExit(f"no polygon file in {folder}")
    return names


def make_grid(spark: SparkSession, path: str, grid_dir: str, output: str | None, overwrite: bool) -> str:
    """Write the grid of one polygon file; an existing one stays unless ``overwrite``."""
    stem = os.path.splitext(os.path.basename(path.rstrip("/")))[0]
    target = output or f"{grid_dir}/{stem}_grid.parquet"
    plots = tables.polygons(spark, path)
    epsg = grid.utm_zone(plots).first()["epsg"] or 32647
    sinks.write_geoparquet(grid.build(plots, stem.upper(), epsg), target, ["Point"], epsg, mode="overwrite" if overwrite else "ignore")
    return target


def main(args: list[str] | None = None) -> None:
    options = parser().parse_args(args)
    spark = SparkSession.builder.appName("geots").getOrCreate()
    if options.job == "grid":
        for path in [options.polygon_file] if options.polygon_file else polygon_files(spark, options.polygon_dir):
            print(make_grid(spark, path, options.grid_dir, options.output_file, options.overwrite))
        return
    if bool(options.rasters) == bool(options.blocks and options.meta):
        raise SystemExit("give either --rasters or --blocks and --meta")
    config = Config.from_env()
    if options.rasters:
        blocks, meta, broken = run.from_rasters(spark.read.parquet(options.rasters), config)
        for r in broken.orderBy("path").limit(20).collect():  # the first of them; the table has all
            print(f"not read: {r['path']}: {r['problem']}")
    else:
        blocks, meta = (spark.read.parquet(getattr(options, n)) for n in ("blocks", "meta"))
    tiles = tables.tile_index(spark, options.tiles)
    if "epsg" not in tiles.columns:  # the tile's name begins with its zone
        tiles = tiles.withColumn("epsg", F.lit(32600) + F.substring("tile", 1, 2).cast("int"))
    for name, rows in run.run(spark, config, tiles, spark.read.parquet(options.scenes), blocks, meta).items():
        print(f"{name}: {rows} rows")


if __name__ == "__main__":
    main()
