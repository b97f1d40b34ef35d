"""Raster blocks from raw bytes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sample types of rasters.
SAMPLES = {"u8": "u1", "u16": "<u2", "i16": "<i2", "u32": "<u4", "i32": "<i4", "f32": "<f4", "f64": "<f8"}


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def samples(data: pd.Series, kind: pd.Series) -> pd.Series:
    """The values of a block's little-endian bytes; null bytes give null, an unknown type an error."""
    return pd.Series([None if d is None else np.frombuffer(d, SAMPLES[k]).astype(np.float64) for d, k in zip(data, kind)], dtype=object)
