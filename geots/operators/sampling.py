"""Points x scenes: raster values at points, cloud mask, index.

Rasters are tables of square blocks: (tile, scene_id, band, bx, by, data) with ``data`` the block's
values row by row. Where a band's grid lies is a row of ``meta``: (tile, band, gx, gw, gy, gh, nx,
ny, nodata). Points meet blocks by an equi-join on (tile, band, bx, by), so that neither
points x scenes nor single pixels are ever shuffled before the mask has been applied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import raster


def placed(points: DataFrame, meta: DataFrame, band: str, config: Config = Config(), floor: bool = False) -> DataFrame:
    """``points`` (tile, x, y, ...) with ``px``, ``py`` in the tile's grid of ``band`` and its size.

    Points outside the raster go (oob ``null``: they have no value) or take the edge pixel
    (``clamp``). ``meta`` has a row a tile and band.
    """
    own = meta.filter(F.col("band") == band).drop("band")
    number = raster.pixel_floor if floor else raster.pixel_trunc
    found = points.join(own, "tile").withColumns({"px": number(F.col("x"), F.col("gx"), F.col("gw")), "py": number(F.col("y"), F.col("gy"), F.col("gh"))})
    if config.oob == "clamp":
        return found.withColumns({"px": raster.clamp(F.col("px"), F.col("nx")), "py": raster.clamp(F.col("py"), F.col("ny"))})
    return found.filter(raster.inside(F.col("px"), F.col("py"), F.col("nx"), F.col("ny")))


def block_value(data: Column, px: Column, py: Column, width: Column | int, block: int) -> Column:
    """The value at a pixel of a block that is ``width`` pixels wide."""
    wide = F.lit(width) if isinstance(width, int) else width
    return F.get(data, ((py % block) * wide + px % block).cast("int"))


def sampled(points: DataFrame, blocks: DataFrame, meta: DataFrame, band: str, value: str, config: Config = Config(), keys: tuple[str, ...] = ("tile",)) -> DataFrame:
    """``points`` with ``value``: the band's value under each, null where it is no data.

    ``keys`` are the columns that points and blocks share: ("tile",) fans points out to the tile's
    scenes and adds ``scene_id``; ("tile", "scene_id") looks one scene up. The order of the
    block's columns is row by row, a block at the right edge being narrower.
    """
    return sampled_together(points, blocks, meta, {band: value}, config, keys)


def sampled_together(points: DataFrame, blocks: DataFrame, meta: DataFrame, values: dict[str, str], config: Config = Config(), keys: tuple[str, ...] = ("tile",)) -> DataFrame:
    """As ``sampled`` for several bands (band -> column) of one grid: points meet all of them in one exchange.

    The bands' blocks are put side by side first; a point has a row where every band has a block.
    The bands must have the same grid in each tile (see ``one_grid``); their no-data values may differ.
    """
    bands = list(values)
    about = meta.withColumnRenamed("nodata", "nodata_0")
    for k, band in enumerate(bands[1:], 1):
        about = about.join(meta.filter(F.col("band") == band).select("tile", F.col("nodata").alias(f"nodata_{k}")), "tile")
    at = placed(points, about, bands[0], config)
    at = at.withColumns({"bx": F.floor(F.col("px") / config.block).cast("int"), "by": F.floor(F.col("py") / config.block).cast("int")})
    block = ["tile", "scene_id", "bx", "by"]
    side_by_side = None
    for k, band in enumerate(bands):
        own = blocks.filter(F.col("band") == band).select(*block, F.col("data").alias(f"data_{k}"))
        side_by_side = own if side_by_side is None else side_by_side.join(own, block)
    width = F.least(F.lit(config.block), F.col("nx") - F.col("bx") * config.block)
    got = [raster.no_data(block_value(F.col(f"data_{k}"), F.col("px"), F.col("py"), width, config.block), F.col(f"nodata_{k}")).alias(values[band]) for k, band in enumerate(bands)]
    kept = [c for c in points.columns if c not in values.values()] + [c for c in ("scene_id",) if c not in points.columns]
    return at.join(side_by_side, [*keys, "bx", "by"]).select(*kept, *got)


def one_grid(meta: DataFrame, bands: list[str]) -> bool:
    """Whether the bands have one and the same grid in each tile. ``meta`` has a row a tile and band."""
    grids = meta.filter(F.col("band").isin(bands)).groupBy("tile").agg(F.countDistinct("gx", "gw", "gy", "gh", "nx", "ny").alias("grids"), F.countDistinct("band").alias("bands"))
    return grids.filter((F.col("grids") > 1) | (F.col("bands") < len(bands))).isEmpty()


def pixels(blocks: DataFrame, meta: DataFrame, block: int) -> DataFrame:
    """(tile, scene_id, band, px, py, dn): blocks taken apart, for full-band reads."""
    wide = F.least(F.lit(block), F.col("nx") - F.col("bx") * block)
    each = blocks.join(meta.select("tile", "band", "nx"), ["tile", "band"]).select("tile", "scene_id", "band", "bx", "by", wide.alias("w"), F.posexplode("data").alias("at", "dn"))
    return each.select("tile", "scene_id", "band", (F.col("bx") * block + F.col("at") % F.col("w")).cast("int").alias("px"), (F.col("by") * block + F.floor(F.col("at") / F.col("w"))).cast("int").alias("py"), "dn")


def blocked(pixel_table: DataFrame, block: int) -> DataFrame:
    """Blocks from a table of single pixels; absent pixels are null. For imports and tests.

    One group is one block, which holds ``block`` squared pixels at most.
    """
    keyed = pixel_table.withColumns({"bx": F.floor(F.col("px") / block).cast("int"), "by": F.floor(F.col("py") / block).cast("int")})
    return (
        keyed.groupBy("tile", "scene_id", "band", "bx", "by")
        .agg(F.sort_array(F.collect_list(F.struct("py", "px", "dn"))).alias("cells"))
        .select("tile", "scene_id", "band", "bx", "by", F.transform("cells", lambda c: c["dn"]).alias("data"))
    )


def observations(points: DataFrame, scenes: DataFrame, blocks: DataFrame, meta: DataFrame, config: Config = Config()) -> DataFrame:
    """(tile, plot_id, point_id, day, ndvi): a row for each point and scene with a clear sky there.

    The mask is looked up first and only clear points meet the two bands: both at once where they
    share their grid in every tile, else one after the other. A null index (no data,
    zero sum) has a row, a cloudy point none: ``monthly.statistics`` brings all points back.
    """
    own = points.select("tile", "plot_id", "point_id", "x", "y")
    seen = sampled(own, blocks, meta, "mask", "mask", config).filter(raster.is_clear(F.col("mask"), config.clear_values)).drop("mask")
    seen = seen.join(scenes.select("tile", "scene_id", "day"), ["tile", "scene_id"])
    if one_grid(meta, ["nir", "red"]):
        both = sampled_together(seen, blocks, meta, {"nir": "nir", "red": "red"}, config, ("tile", "scene_id"))
    else:
        nir = sampled(seen, blocks, meta, "nir", "nir", config, ("tile", "scene_id"))
        both = sampled(nir, blocks, meta, "red", "red", config, ("tile", "scene_id"))
    value = raster.ndvi(F.col("nir"), F.col("red"), F.col("day"), config.offset_after, config.dn_offset, config.dn_sentinels)
    return both.select("tile", "plot_id", "point_id", "day", value.alias("ndvi"))


def clear_counts(points: DataFrame, blocks: DataFrame, meta: DataFrame, config: Config = Config()) -> DataFrame:
    """(tile, scene_id, n_points, n_clear): points that a scene's raster covers, and clear ones."""
    seen = sampled(points, blocks, meta, "mask", "mask", config)
    clear = F.coalesce(raster.is_clear(F.col("mask"), config.clear_values), F.lit(False))
    return seen.groupBy("tile", "scene_id").agg(F.count(F.lit(1)).alias("n_points"), F.count_if(clear).alias("n_clear"))


def mosaic(images: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """One value a key: that of the image that comes last in ``order`` among those with a value."""
    return images.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, order).alias(value))
