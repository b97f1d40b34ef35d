"""The folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Where it is unset a session on one machine gets a temporary folder, which later calls find in
    its settings; on a cluster, whose executors would not see that folder, this is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.conf.get("geots.shared.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and all executors of {master} share")
        found = tempfile.mkdtemp(prefix="geots-")
        spark.conf.set("geots.shared.dir", found)
    return found.rstrip("/")


def mounted(path: str) -> str:
    """``path`` as files are opened by name: formats that Spark has no reader for need a mounted folder."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"{path} is not mounted: this format is read by offsets in files that driver and executors can open")
    return path


#: Bytes of an Arrow batch: what a Python worker holds at once, beside the longest value.
BATCH_BYTES = 8 << 20


def map_batches(df: DataFrame, run, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` in batches of bounded bytes, however long single values are.

    Spark reads the bound from the session when a plan runs, so the session keeps it; all callers
    want the same one.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)
