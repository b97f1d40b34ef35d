"""Column expressions on raster positions and band values."""

from __future__ import annotations

import datetime as dt
import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def pixel_trunc(v: Column, origin: Column, step: Column) -> Column:
    """Pixel number of a coordinate, cut towards zero: an offset in (-1, 0) is pixel 0."""
    return ((v - origin) / step).cast("int")


def pixel_floor(v: Column, origin: Column, step: Column) -> Column:
    """Pixel number of a coordinate, rounded down: an offset in (-1, 0) is pixel -1."""
    return F.floor((v - origin) / step).cast("int")


def pixel_corner(pixel: Column, origin: Column, step: Column) -> Column:
    """Coordinate at which a pixel begins."""
    return origin + pixel * step


def inside(px: Column, py: Column, nx: Column, ny: Column) -> Column:
    return px.between(0, nx - 1) & py.between(0, ny - 1)


def clamp(pixel: Column, n: Column) -> Column:
    """The nearest pixel of the raster."""
    return F.least(F.greatest(pixel, F.lit(0)), n - 1)


def no_data(value: Column, declared: Column) -> Column:
    """Null where the value is the band's declared no-data value."""
    return F.when(declared.isNull() | (value != declared), value)


def valid_pair(nir: Column, red: Column, sentinels: Sequence[int]) -> Column:
    """False where either band holds a value that means no data; null bands are not valid."""
    return F.coalesce(~nir.isin(*sentinels) & ~red.isin(*sentinels), F.lit(False)) if sentinels else nir.isNotNull() & red.isNotNull()


def dn_corrected(value: Column, day: Column, after: dt.date, offset: int) -> Column:
    """Band value less ``offset`` on days after (not on) ``after``. Never clamped at 0."""
    return F.when(day > F.lit(after), value - offset).otherwise(value)


def normalized_difference(nir: Column, red: Column) -> Column:
    """(nir - red) / (nir + red); null where the sum is 0 or a band is null."""
    n, r = nir.cast("double"), red.cast("double")
    return F.try_divide(n - r, n + r)


def is_clear(mask: Column, clear: Sequence[int]) -> Column:
    return functools.reduce(operator.or_, (mask == v for v in clear))


def ndvi(nir: Column, red: Column, day: Column, after: dt.date, offset: int, sentinels: Sequence[int]) -> Column:
    """The index of a pair of raw band values: sentinels first, then the offset, then the ratio."""
    pair = normalized_difference(dn_corrected(nir, day, after, offset), dn_corrected(red, day, after, offset))
    return F.when(valid_pair(nir, red, sentinels), pair)
