"""Statistics of observations as scenes arrive, with a watermark for late ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed(observations: DataFrame, days: int = 30, late_days: int = 10, ts: str = "ts", value: str = "ndvi", keys: tuple[str, ...] = ("plot_id",)) -> DataFrame:
    """Mean, extremes and count a key and window of ``days``, closed ``late_days`` after its end.

    Works on a stream (append mode: a window is told once, when the watermark passes it; later
    scenes are dropped) and on a table alike.
    """
    seen = observations.filter(F.col(value).isNotNull())
    if observations.isStreaming:
        seen = seen.withWatermark(ts, f"{late_days} days")
    return (
        seen.groupBy(*keys, F.window(ts, f"{days} days").alias("w"))
        .agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.count(value).alias("n"))
        .select(*keys, F.col("w.start").alias("window_start"), "mean", "min", "max", "n")
    )


def start(observations: DataFrame, path: str, checkpoint: str, **options):
    """A query that writes closed windows to ``path``; what is there when it starts, then stops."""
    return windowed(observations, **options).writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
