"""Spatial joins on equi-joined cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from .order import numbered


LEVELS = 60  # of cells, each twice as wide as those of the level below


def _boxes(df: DataFrame, key: str, parts: str, cell: float) -> DataFrame:
    """(key, shape, b, level): boxes, and the first level whose cells are as wide as the box."""
    b = F.col("b")
    wide = F.greatest(b["xmax"] - b["xmin"], b["ymax"] - b["ymin"])
    level = F.when(wide > cell, F.least(F.ceil(F.log2(wide / cell)), F.lit(LEVELS))).otherwise(0).cast("int")
    boxes = df.filter(F.size(parts) > 0).select(F.col(key).alias("key"), F.xxhash64(parts).alias("shape"), geometry.bounds(geometry.vertices(F.col(parts))).alias("b"))
    return boxes.filter(b["xmin"].isNotNull()).withColumn("level", level)


def _celled(boxes: DataFrame, levels: Column, cell: float, side: str) -> DataFrame:
    """A row for each of ``levels`` and each cell of that level which the box covers."""
    size = cell * F.pow(F.lit(2.0), F.col("at"))
    b = F.col("b")
    rows = boxes.withColumn("at", F.explode(levels))
    rows = rows.withColumn("cx", F.explode(F.sequence(F.floor(b["xmin"] / size), F.floor(b["xmax"] / size))))
    rows = rows.withColumn("cy", F.explode(F.sequence(F.floor(b["ymin"] / size), F.floor(b["ymax"] / size))))
    return rows.select("at", "cx", "cy", *(F.col(c).alias(f"{c}_{side}") for c in ("key", "shape", "b")))


def candidates(left: DataFrame, right: DataFrame, left_key: str, right_key: str, cell: float, parts: str = "parts") -> DataFrame:
    """(key_a, shape_a, key_b, shape_b) of rows whose bounding boxes meet, each pair of rows once.

    Boxes are dealt to square cells of levels: those of level k are 2**k times ``cell`` wide, and a
    box's own level is the first whose cells are as wide as the box, so it covers at most four
    there. A box is also dealt to those wider levels that the other side has boxes of its own
    on, and a pair meets on the wider of its two levels: one side's own cells with the other's,
    never two boxes that both came up from below. So a box as large as a country costs four rows,
    and a small one beside it a few more. Keys and boxes alone are dealt. A pair that shares
    several cells is kept only in the first one that both boxes cover. A cell with many boxes is
    split by adaptive execution, as the joins are inner ones.
    """
    a, b = _boxes(left, left_key, parts, cell), _boxes(right, right_key, parts, cell)
    # At most LEVELS + 1 numbers a side.
    levels_a, levels_b = (sorted(r["level"] for r in side.select("level").distinct().collect()) for side in (a, b))

    def above(levels: list[int], own: bool) -> Column:
        """The other side's levels from a box's own one on, or beyond it."""
        every = F.array(*(F.lit(n) for n in levels)).cast("array<int>")
        return F.filter(every, lambda n: n >= F.col("level") if own else n > F.col("level"))

    own = F.array("level")
    size = cell * F.pow(F.lit(2.0), F.col("at"))
    x, y = F.col("b_a"), F.col("b_b")
    first = (F.col("cx") == F.floor(F.greatest(x["xmin"], y["xmin"]) / size)) & (F.col("cy") == F.floor(F.greatest(x["ymin"], y["ymin"]) / size))
    boxes = (x["xmin"] <= y["xmax"]) & (y["xmin"] <= x["xmax"]) & (x["ymin"] <= y["ymax"]) & (y["ymin"] <= x["ymax"])
    wider_a = _celled(a, own, cell, "a").join(_celled(b, above(levels_a, True), cell, "b"), ["at", "cx", "cy"])
    wider_b = _celled(a, above(levels_b, False), cell, "a").join(_celled(b, own, cell, "b"), ["at", "cx", "cy"])
    return wider_a.unionByName(wider_b).filter(first & boxes).select("key_a", "shape_a", "key_b", "shape_b")


def intersecting(left: DataFrame, right: DataFrame, left_key: str, right_key: str, cell: float, parts: str = "parts") -> DataFrame:
    """(left_key, right_key) of geometries that share a point, each pair of keys once.

    Pairs of rows whose boxes meet come from ``candidates``; their geometries are fetched by key
    and content afterwards, and their edges are tested. Rows with null or empty geometries have no
    pair. A key may have several rows, and a null key is a key like any other.
    """
    met = candidates(left, right, left_key, right_key, cell, parts)
    a = left.select(F.col(left_key).alias("ka"), F.xxhash64(parts).alias("sa"), F.col(parts).alias("parts_a"))
    b = right.select(F.col(right_key).alias("kb"), F.xxhash64(parts).alias("sb"), F.col(parts).alias("parts_b"))
    both = met.join(a, F.col("key_a").eqNullSafe(F.col("ka")) & (F.col("shape_a") == F.col("sa"))).join(b, F.col("key_b").eqNullSafe(F.col("kb")) & (F.col("shape_b") == F.col("sb")))
    exact = geometry.intersects(F.col("parts_a"), F.col("parts_b"))
    return both.filter(exact).select(F.col("key_a").alias(left_key), F.col("key_b").alias(right_key)).distinct()


def tile_points(points: DataFrame, plot_tiles: DataFrame, key: str = "plot_id", tile: str = "tile") -> DataFrame:
    """The points of each tile: those of plots that the tile intersects, each once a tile."""
    return points.join(plot_tiles.select(key, tile).distinct(), key)


def slots(plot_tiles: DataFrame, key: str = "plot_id", tile: str = "tile") -> DataFrame:
    """Plots of a tile numbered from 0 by id; a repeated plot has one slot.

    All tiles' plots are numbered together, and each tile's first number is taken off.
    """
    every = numbered(plot_tiles.select(tile, key).distinct(), [tile, key], "slot")
    first = every.groupBy(tile).agg(F.min("slot").alias("__first"))
    return every.join(first, tile).withColumn("slot", F.col("slot") - F.col("__first")).drop("__first")
