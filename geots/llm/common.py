"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..shared import map_batches, shared_dir

__all__ = ["Scratch", "map_batches", "shared_dir", "table", "with_columns"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written to the shared folder: a lost executor rereads them, nothing is recomputed."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/geots-{label}-{uuid.uuid4().hex}"
        self.count = 0

    def table(self, df: DataFrame) -> DataFrame:
        """Write and reread ``df``; lineage ends here."""
        self.count += 1
        path = f"{self.root}/t{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete scratch tables that no later step reads."""
        jvm = self.spark._jvm
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df.scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def with_columns(df: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
    """Schema of ``df`` with ``fields`` added."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in fields)])
