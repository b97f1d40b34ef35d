"""Writers: Parquet by tile, GeoParquet, CSV reports, run summaries."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_GROUP = 200_000


def write_tiles(observations: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Observations in a folder a tile, snappy; only the tiles at hand are overwritten."""
    observations.write.mode(mode).option("compression", "snappy").option("partitionOverwriteMode", "dynamic").partitionBy("tile").parquet(path)


def geo_footer(kinds: list[str], epsg: int = 4326, column: str = "geometry") -> str:
    """The ``geo`` entry of a GeoParquet file's footer (version 1.0.0)."""
    crs = None if epsg == 4326 else {"id": {"authority": "EPSG", "code": epsg}}
    about = {"encoding": "WKB", "geometry_types": kinds} | ({"crs": crs} if crs else {})
    return json.dumps({"version": "1.0.0", "primary_column": column, "columns": {column: about}})


def write_geoparquet(df: DataFrame, path: str, kinds: list[str], epsg: int = 4326, mode: str = "overwrite") -> None:
    """``df`` as GeoParquet: Spark writes the files, then tasks add the footer's ``geo`` entry.

    A footer is changed by writing a file again beside it, a row group at a time, and moving it
    over the first; doing so twice, as after a lost executor, does no harm. With mode ``ignore``
    an existing table stays as it is.
    """
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if mode == "ignore" and files.exists(folder):
        return
    df.write.mode(mode).option("compression", "snappy").parquet(path)
    names = [str(f.getPath().toString()) for f in files.listStatus(folder) if f.getPath().getName().endswith(".parquet")]
    footer = geo_footer(kinds, epsg)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [add_footer(name, footer) for name in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], names=["rows"])

    listed = spark.createDataFrame([(n,) for n in names], "path string").repartition(max(1, len(names)), "path")
    listed.mapInArrow(run, "rows long").agg(F.sum("rows")).collect()


def add_footer(name: str, footer: str) -> int:
    """Write the file again with the ``geo`` entry; its number of rows."""
    fs, path = pyarrow.fs.FileSystem.from_uri(name if "://" in name else f"file://{name.removeprefix('file:')}")
    with fs.open_input_file(path) as source:
        old = pq.ParquetFile(source)
        schema = old.schema_arrow
        metadata = {**(schema.metadata or {}), b"geo": footer.encode()}
        with pq.ParquetWriter(path + ".geo", schema.with_metadata(metadata), filesystem=fs, compression="snappy") as out:
            for batch in old.iter_batches(ROW_GROUP):
                out.write_batch(batch)
        rows = old.metadata.num_rows
    fs.move(path + ".geo", path)
    folder, _, base = path.rpartition("/")
    stale = f"{folder}/.{base}.crc"  # the old bytes' checksum
    if fs.get_file_info(stale).type != pyarrow.fs.FileType.NotFound:
        fs.delete_file(stale)
    return rows


def write_csv(df: DataFrame, path: str, order: list | None = None, single: bool = True) -> None:
    """A report as CSV files with a header each, which in the order of their names are in ``order``.

    One file, written by one task, for results of bounded size: summaries and top lists. With
    ``single`` false tasks write ranges of the report, for those that grow with points and days.
    """
    rows = df.orderBy(*order) if order else df
    (rows.coalesce(1) if single else rows).write.mode("overwrite").option("header", "true").csv(path)


def summary_text(overall: dict, monthly: list[dict]) -> str:
    """The comparison's summary: overall errors, then a line a month."""
    lines = ["overall", *(f"  {k:<8}{v:.6f}" if isinstance(v, float) else f"  {k:<8}{v}" for k, v in overall.items()), "month      n       mae      bias   max_abs"]
    lines += [f"{m['month']}  {m['n']:>7}  {m['mae']:.5f}  {m['bias']:+.5f}  {m['max_abs']:.5f}" for m in monthly]
    return "\n".join(lines) + "\n"


def run_summary(province: str, run_date: str, elapsed_s: float, counts: dict, timing: dict[str, float]) -> str:
    """A run's figures as JSON; each stage with its seconds and its share of all stages' seconds."""
    total = sum(timing.values())
    shares = {k: {"seconds": round(s, 3), "percent": round(100 * s / total, 2) if total else 0.0} for k, s in timing.items()}
    return json.dumps({"province": province, "run_date": run_date, "total_elapsed_min": round(elapsed_s / 60, 3), **counts, "timing": shares}, indent=2)


def put_text(spark: SparkSession, path: str, content: str) -> None:
    """A small text file, through the cluster's own file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(content.encode()))
    out.close()


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete intermediate tables; called after a run has succeeded, never on failure."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
