"""Polygons as nested arrays, and Column expressions on them.

A geometry is ``parts``: an array of polygons, each an array of closed rings (the outer one and
holes), each an array of (x, y). Inside and outside follow the even-odd rule, which is what a
valid polygon with holes means.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A closed ring."""
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))


def vertices(parts: Column) -> Column:
    return F.flatten(F.flatten(parts))


def ring_edges(ring: Column) -> Column:
    """Edges of a closed ring; empty for fewer than two vertices."""
    pairs = F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))
    return pairs


def polygon_edges(rings: Column) -> Column:
    """Edges of one polygon: of its outer ring and its holes."""
    return F.flatten(F.transform(rings, ring_edges))


def edges(parts: Column) -> Column:
    """Edges of all polygons of a geometry."""
    return F.flatten(F.transform(parts, polygon_edges))


def bounds(points: Column) -> Column:
    """(xmin, ymin, xmax, ymax) of an array of points."""
    xs, ys = F.transform(points, lambda v: v["x"]), F.transform(points, lambda v: v["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def crossing_x(e: Column, y: Column) -> Column:
    """Where the line of a non-horizontal edge meets height ``y``."""
    return e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))


def _crosses(e: Column, y: Column) -> Column:
    return (e["y1"] <= y) != (e["y2"] <= y)


def on_edge(all_edges: Column, x: Column, y: Column) -> Column:
    """Whether the point lies on an edge or a vertex."""
    return F.exists(
        all_edges,
        lambda e: F.when(e["y1"] == e["y2"], (e["y1"] == y) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))).otherwise(
            y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])) & (crossing_x(e, y) == x)
        ),
    )


def in_polygon(all_edges: Column, x: Column, y: Column) -> Column:
    """Whether the point lies strictly inside: boundaries of rings and holes are outside."""
    right = F.aggregate(all_edges, F.lit(0), lambda n, e: n + F.when(_crosses(e, y) & (crossing_x(e, y) > x), 1).otherwise(0))
    return (right % 2 == 1) & ~on_edge(all_edges, x, y)


def row_centres(all_edges: Column, y: Column, x_first: Column, spacing: float) -> Column:
    """The numbers x_first + k * spacing strictly inside the polygon at height ``y``, ascending.

    A scan line: its crossings with the edges, sorted, bound the runs inside, so that only points
    inside are generated, however empty the bounding box is.
    """
    cross = F.array_sort(F.transform(F.filter(all_edges, lambda e: _crosses(e, y)), lambda e: crossing_x(e, y)))
    starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(cross) - 2, F.lit(0))), lambda i: (i % 2 == 0) & (i + 1 < F.size(cross)))

    def run(i: Column) -> Column:
        a, b = F.get(cross, i), F.get(cross, i + 1)
        low = F.greatest(F.floor((a - x_first) / spacing), F.lit(0))
        high = F.ceil((b - x_first) / spacing)
        ks = F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
        return F.filter(F.transform(ks, lambda k: x_first + k * F.lit(float(spacing))), lambda x: (x > a) & (x < b))

    centres = F.flatten(F.transform(starts, run))
    return F.filter(centres, lambda x: ~on_edge(all_edges, x, y))


def signed_area(ring: Column) -> Column:
    return F.aggregate(ring_edges(ring), F.lit(0.0), lambda s, e: s + (e["x1"] * e["y2"] - e["x2"] * e["y1"]) / 2)


def area(parts: Column) -> Column:
    """Area of the outer rings less their holes."""
    return F.aggregate(
        parts,
        F.lit(0.0),
        lambda s, rings: s + F.aggregate(F.transform(rings, lambda r: F.abs(signed_area(r))), F.lit(0.0), lambda t, a: t - a) + 2 * F.abs(signed_area(F.get(rings, F.lit(0)))),
    )


def centroid(parts: Column) -> Column:
    """Centre of area (x, y); null without area. Computed about the first vertex, for precision."""
    origin = F.get(F.get(F.get(parts, F.lit(0)), F.lit(0)), F.lit(0))
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def moment(acc: Column, e: Column, sign: Column) -> Column:
        x1, y1, x2, y2 = e["x1"] - origin["x"], e["y1"] - origin["y"], e["x2"] - origin["x"], e["y2"] - origin["y"]
        c = sign * (x1 * y2 - x2 * y1)
        return F.struct((acc["a"] + c / 2).alias("a"), (acc["x"] + (x1 + x2) * c / 6).alias("x"), (acc["y"] + (y1 + y2) * c / 6).alias("y"))

    def polygon(acc: Column, rings: Column) -> Column:
        first = F.get(rings, F.lit(0))
        outer = F.when(signed_area(first) < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
        with_outer = F.aggregate(ring_edges(first), acc, lambda s, e: moment(s, e, outer))
        holes = F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0)))
        return F.aggregate(holes, with_outer, lambda s, r: F.aggregate(ring_edges(r), s, lambda t, e: moment(t, e, F.when(signed_area(r) < 0, F.lit(1.0)).otherwise(F.lit(-1.0)))))

    total = F.aggregate(parts, zero, polygon)
    return F.when(total["a"] != 0, F.struct((origin["x"] + total["x"] / total["a"]).alias("x"), (origin["y"] + total["y"] / total["a"]).alias("y")))


def given(value: Column, use) -> Column:
    """``use`` of a value that is computed once, also where ``use`` goes over arrays with it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def representative_point(parts: Column) -> Column:
    """A point on the surface: the middle of the widest run inside of a part, at its mid height.

    That height lies halfway between the heights of vertices next to the middle of the part's
    bounding box, so that the line meets no vertex and the point is inside, on no edge. Of equally
    wide runs it is the one of the first part, then the leftmost; null for a geometry without area.
    """

    def height(every: Column) -> Column:
        ys = F.transform(every, lambda e: e["y1"])
        middle = (F.array_min(ys) + F.array_max(ys)) / 2
        return given(middle, lambda m: (F.array_max(F.filter(ys, lambda y: y <= m)) + F.array_min(F.filter(ys, lambda y: y > m))) / 2)

    def widest(s: Column) -> Column:
        def runs(cross: Column) -> Column:
            starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(cross) - 2, F.lit(0))), lambda i: (i % 2 == 0) & (i + 1 < F.size(cross)))
            return F.transform(starts, lambda i: F.struct((F.get(cross, i + 1) - F.get(cross, i)).alias("w"), ((F.get(cross, i) + F.get(cross, i + 1)) / 2).alias("x"), s["y"].alias("y")))

        return given(F.array_sort(F.transform(F.filter(s["every"], lambda e: _crosses(e, s["y"])), lambda e: crossing_x(e, s["y"]))), runs)

    def of_part(rings: Column) -> Column:
        known = given(polygon_edges(rings), lambda every: F.struct(every.alias("every"), height(every).alias("y")))
        return given(known, widest)

    def wider(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["w"] > best["w"]), run).otherwise(best)

    every_run = F.flatten(F.transform(parts, of_part))
    none = F.lit(None).cast("struct<w: double, x: double, y: double>")
    return given(F.aggregate(every_run, none, wider), lambda s: F.when(s.isNotNull(), F.struct(s["x"].alias("x"), s["y"].alias("y"))))


def is_closed(ring: Column) -> Column:
    return (F.size(ring) >= 4) & (F.get(ring, F.lit(0)) == F.element_at(ring, -1))


def _any_crossing(every: Column) -> Column:
    """Whether two edges properly cross.

    Edges are put into as many bands of equal height as the root of their number, each into all
    bands that it meets: two edges that cross do so in a band of both, so a band's own are compared.
    """

    def within(s: Column, k: Column) -> Column:
        low, high = s["low"] + k * s["step"], F.when(k == s["n"] - 1, s["high"]).otherwise(s["low"] + (k + 1) * s["step"])
        own = F.filter(s["every"], lambda e: (F.greatest(e["y1"], e["y2"]) >= low) & (F.least(e["y1"], e["y2"]) <= high))
        return given(own, lambda band: F.exists(band, lambda e: F.exists(band, lambda f: _proper(e, f))))

    def measured(edges_: Column) -> Column:
        low = F.array_min(F.transform(edges_, lambda e: F.least(e["y1"], e["y2"])))
        high = F.array_max(F.transform(edges_, lambda e: F.greatest(e["y1"], e["y2"])))
        n = F.greatest(F.ceil(F.sqrt(F.size(edges_))), F.lit(1).cast("long"))
        return F.struct(edges_.alias("every"), low.alias("low"), high.alias("high"), n.alias("n"), ((high - low) / n).alias("step"))

    return given(given(every, measured), lambda s: F.exists(F.sequence(F.lit(0).cast("long"), s["n"] - 1), lambda k: within(s, k)))


def is_simple_polygon(rings: Column) -> Column:
    """Structure and crossings: every ring closed, and no two edges that properly cross."""
    return F.coalesce(F.forall(rings, is_closed) & ~_any_crossing(polygon_edges(rings)), F.lit(False))


def repaired(parts: Column) -> Column:
    """Rings closed, repeated vertices and rings without area dropped, polygons without a ring gone.

    Crossings are left, and the even-odd rule then decides what is inside; ``repair.made_valid``
    resolves them.
    """

    def ring(r: Column) -> Column:
        distinct = F.filter(F.transform(r, lambda v, i: F.struct(v.alias("v"), F.when(i > 0, F.get(r, i - 1)).alias("before"))), lambda p: p["before"].isNull() | (p["v"] != p["before"]))
        open_ring = F.transform(distinct, lambda p: p["v"])
        return F.when((F.size(open_ring) > 0) & (F.get(open_ring, F.lit(0)) != F.element_at(open_ring, -1)), F.concat(open_ring, F.slice(open_ring, 1, 1))).otherwise(open_ring)

    def has_area(r: Column) -> Column:
        return (F.size(r) >= 4) & (signed_area(r) != 0)

    cleaned = F.transform(parts, lambda rings: F.transform(rings, ring))
    with_outer = F.filter(cleaned, lambda rings: (F.size(rings) > 0) & F.coalesce(has_area(F.get(rings, F.lit(0))), F.lit(False)))
    return F.transform(with_outer, lambda rings: F.filter(rings, has_area))


def _side(x1, y1, x2, y2, x, y) -> Column:
    return (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)


def _sides(e: Column, f: Column) -> tuple[Column, ...]:
    return (
        _side(e["x1"], e["y1"], e["x2"], e["y2"], f["x1"], f["y1"]),
        _side(e["x1"], e["y1"], e["x2"], e["y2"], f["x2"], f["y2"]),
        _side(f["x1"], f["y1"], f["x2"], f["y2"], e["x1"], e["y1"]),
        _side(f["x1"], f["y1"], f["x2"], f["y2"], e["x2"], e["y2"]),
    )


def _proper(e: Column, f: Column) -> Column:
    a, b, c, d = _sides(e, f)
    return (a * b < 0) & (c * d < 0)


def _touch(e: Column, f: Column) -> Column:
    """Whether two edges share a point, ends included."""
    a, b, c, d = _sides(e, f)
    overlap = (
        (F.least(e["x1"], e["x2"]) <= F.greatest(f["x1"], f["x2"]))
        & (F.least(f["x1"], f["x2"]) <= F.greatest(e["x1"], e["x2"]))
        & (F.least(e["y1"], e["y2"]) <= F.greatest(f["y1"], f["y2"]))
        & (F.least(f["y1"], f["y2"]) <= F.greatest(e["y1"], e["y2"]))
    )
    return overlap & (a * b <= 0) & (c * d <= 0)


def intersects(parts_a: Column, parts_b: Column) -> Column:
    """Whether two geometries share a point: their edges do, or a part of one lies inside the other."""
    edges_a, edges_b = edges(parts_a), edges(parts_b)

    def any_inside(parts: Column, others: Column) -> Column:
        def first(rings: Column) -> Column:
            return F.get(F.get(rings, F.lit(0)), F.lit(0))

        return F.exists(parts, lambda rings: in_polygon(others, first(rings)["x"], first(rings)["y"]))

    return F.coalesce(
        F.exists(edges_a, lambda e: F.exists(edges_b, lambda f: _touch(e, f))) | any_inside(parts_a, edges_b) | any_inside(parts_b, edges_a), F.lit(False)
    )
