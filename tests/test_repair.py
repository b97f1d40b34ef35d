"""Validity repair against an independent test of validity and a scan of the even-odd rule."""

import itertools
import math
import random
import time
from fractions import Fraction

import numpy as np
import pytest
from geots.functions import geometry, repair, wkb
from geots.operators import grid
from pyspark.sql import functions as F

SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
KIND = "array<array<array<struct<x: double, y: double>>>>"


def fixed(*polygons):
    """The repaired geometry as lists, and whether the repair ended."""
    found, valid = repair.repair_batch([[[np.array(r, float) for r in rings] for rings in polygons]])
    return [[[tuple(v) for v in r.tolist()] for r in rings] for rings in found[0]], bool(valid[0])


def ring_area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def area(polygons):
    return sum(abs(ring_area(rings[0])) - sum(abs(ring_area(r)) for r in rings[1:]) for rings in polygons)


def edges(polygons):
    return [e for rings in polygons for r in rings for e in zip(r, r[1:])]


def odd(polygons, x, y):
    hits = [a for a, b in edges(polygons) if (a[1] <= y) != (b[1] <= y) and a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) > x]
    return len(hits) % 2 == 1


def even_odd_area(polygons):
    """Exact area of what is inside by the even-odd rule: trapezoids between all heights of vertices and crossings."""
    es = [((Fraction(a[0]), Fraction(a[1])), (Fraction(b[0]), Fraction(b[1]))) for a, b in edges(polygons)]
    heights = {p[1] for e in es for p in e}
    for (a, b), (c, d) in itertools.combinations(es, 2):
        n = (b[0] - a[0]) * (d[1] - c[1]) - (b[1] - a[1]) * (d[0] - c[0])
        if n:
            t = ((c[0] - a[0]) * (d[1] - c[1]) - (c[1] - a[1]) * (d[0] - c[0])) / n
            s = ((c[0] - a[0]) * (b[1] - a[1]) - (c[1] - a[1]) * (b[0] - a[0])) / n
            if 0 <= t <= 1 and 0 <= s <= 1:
                heights.add(a[1] + t * (b[1] - a[1]))
    total, heights = Fraction(0), sorted(heights)
    for low, high in zip(heights, heights[1:]):
        y = (low + high) / 2
        xs = sorted(a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in es if (a[1] <= y) != (b[1] <= y))
        total += (high - low) * sum(q - p for p, q in zip(xs[::2], xs[1::2]))
    return float(total)


def check_valid(polygons):
    """No edges cross, no ring comes to a vertex twice, holes are in their own outer ring and no part in another."""
    for (a, b), (c, d) in itertools.combinations(edges(polygons), 2):
        def side(p, q, r):
            v = (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
            return 0 if abs(v) < 1e-9 * math.dist(p, q) * max(1, math.dist(p, r)) else v

        assert not (side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0), (a, b, c, d)
        assert {a, b} != {c, d}
    for rings in polygons:
        for r in rings:
            assert r[0] == r[-1] and len(set(r)) == len(r) - 1 >= 3
        for hole in rings[1:]:
            assert all(odd([[rings[0]]], *p) for p in middles(hole))
    for one, other in itertools.permutations(polygons, 2):
        assert not any(odd([other], *p) for p in middles(one[0]))


def middles(ring):
    """Middles of edges, moved a little inwards."""
    turn = 1 if ring_area(ring) > 0 else -1
    for a, b in zip(ring, ring[1:]):
        n = math.dist(a, b)
        if n > 1e-3:
            yield (a[0] + b[0]) / 2 - turn * (b[1] - a[1]) / n * 1e-6, (a[1] + b[1]) / 2 + turn * (b[0] - a[0]) / n * 1e-6


CASES = {
    "bow tie": ([[[(0, 0), (10, 10), (10, 0), (0, 10), (0, 0)]]], 2, 50),
    "overlapping parts": ([[SQUARE], [[(5, 5), (15, 5), (15, 15), (5, 15), (5, 5)]]], 2, 150),
    "touching hole": ([[SQUARE, [(0, 5), (5, 3), (5, 7), (0, 5)]]], 1, 90),
    "hole on the edge": ([[SQUARE, [(0, 2), (5, 2), (5, 8), (0, 8), (0, 2)]]], 1, 70),
    "hole across": ([[SQUARE, [(2, -1), (4, -1), (4, 11), (2, 11), (2, -1)]]], 4, 84),
    "spike": ([[[(0, 0), (10, 0), (10, 10), (15, 15), (10, 10), (0, 10), (0, 0)]]], 1, 100),
    "spike inwards": ([[[(0, 0), (5, 0), (5, 5), (5, 0), (10, 0), (10, 10), (0, 10), (0, 0)]]], 1, 100),
    "shared edge": ([[SQUARE], [[(10, 0), (20, 0), (20, 10), (10, 10), (10, 0)]]], 1, 200),
    "same twice": ([[SQUARE], [SQUARE]], 0, 0),
    "part in a part": ([[SQUARE], [[(2, 2), (4, 2), (4, 4), (2, 4), (2, 2)]]], 1, 96),
    "hole outside": ([[SQUARE, [(20, 0), (22, 0), (22, 2), (20, 2), (20, 0)]]], 2, 104),
    "figure eight at a vertex": ([[[(0, 0), (4, 0), (2, 2), (4, 4), (0, 4), (2, 2), (0, 0)]]], 2, 8),
    "two holes that share an edge": ([[SQUARE, [(2, 2), (4, 2), (4, 4), (2, 4), (2, 2)], [(4, 2), (6, 2), (6, 4), (4, 4), (4, 2)]]], 1, 92),
    "flat": ([[[(0, 0), (5, 5), (9, 9), (0, 0)]]], 0, 0),
    "open": ([[SQUARE[:-1]]], 1, 100),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    before, n, want = CASES[name]
    after, valid = fixed(*before)
    assert valid and len(after) == n and area(after) == pytest.approx(want)
    check_valid(after)


def test_valid_geometries_stay():
    island = [(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)]
    for polygons in ([[SQUARE]], [[SQUARE[::-1]]], [[SQUARE, [(2, 2), (2, 8), (8, 8), (8, 2), (2, 2)]], [island]], [[[(20, 0), (30, 0), (20, 5), (20, 0)]], [SQUARE]]):
        assert fixed(*polygons) == ([[[tuple(map(float, v)) for v in r] for r in rings] for rings in polygons], True)


@pytest.mark.parametrize("seed", range(60))
def test_random_rings_against_exact_area(seed):
    rng = random.Random(seed)
    whole = seed % 2  # on a small lattice vertices and edges meet often
    def ring(n):
        vs = [(float(rng.randint(0, 6)), float(rng.randint(0, 6))) if whole else (rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(n)]
        return [*vs, vs[0]]

    polygons = [[ring(rng.randint(3, 12)) for _ in range(rng.randint(1, 2))] for _ in range(rng.randint(1, 3))]
    kept = [[r for r in rings if len(set(r)) > 2] for rings in polygons]
    after, valid = fixed(*polygons)
    assert valid and area(after) == pytest.approx(even_odd_area([r for r in kept if r]), abs=1e-9)
    check_valid(after)
    again, _ = fixed(*after)
    assert area(again) == pytest.approx(area(after)) and len(again) == len(after)


def test_ten_thousand_edges():
    rng, n = np.random.default_rng(1), 10_000
    turn = np.linspace(0, 2 * np.pi, n, endpoint=False)
    r = 1000 * (1 + 0.3 * rng.random(n))
    star = np.stack((6e5 + r * np.cos(turn), 1.5e6 + r * np.sin(turn)), 1)
    crossed = star.copy()
    k = rng.integers(0, n - 1, 500)
    crossed[k], crossed[k + 1] = star[k + 1], star[k]
    steep = np.stack((np.where(np.arange(n) % 2, 1000.0, 0), np.arange(n) * 0.37 + np.where(np.arange(n) % 2, 500.0, 0)), 1)
    comb = np.vstack((steep, [[2000, 5000], [2000, -100]]))  # all edges long and nearly parallel
    for vertices, parts in ((star, 1), (comb, 1), (crossed, None)):
        began = time.process_time()
        found, valid = repair.repair_batch([[[vertices]]])
        assert time.process_time() - began < 6  # some 0.2, 0.2 and 0.8 seconds on a free core
        assert valid[0] and (len(found[0]) == 1 if parts else len(found[0]) > 1)


def test_columns(spark):
    rows = [(i, None if p is None else [[[(float(x), float(y)) for x, y in r] for r in rings] for rings in p]) for i, p in enumerate([None, [], [[]], [[[]]], *(c[0] for c in CASES.values()), [[[(0, 0), (float("nan"), 1), (2, 2), (0, 0)]]]])]
    df = spark.createDataFrame(rows, f"i int, parts {KIND}").repartition(3)
    got = {r["i"]: r for r in df.select("i", repair.made_valid("parts").alias("v"), geometry.area(F.col("v.parts")).alias("a")).collect()}
    assert got[0]["v"] is None and all(got[i]["v"]["parts"] == [] for i in (1, 2, 3, len(rows) - 1))
    for i, (_, n, want) in enumerate(CASES.values(), 4):
        assert (len(got[i]["v"]["parts"]), got[i]["v"]["valid"]) == (n, True) and got[i]["a"] == pytest.approx(want)
    missing = spark.sql(f"SELECT CAST(array(array(array(named_struct('x', 0D, 'y', 0D), NULL, named_struct('x', 1D, 'y', 1D)))) AS {KIND}) AS parts")
    assert missing.select(repair.made_valid("parts")["parts"].alias("p")).first()["p"] == []


def test_bytes_are_repaired_once(spark):
    rows = [(i, c[0]) for i, c in enumerate(CASES.values())]
    plots = spark.createDataFrame([(i, [[[(float(x), float(y)) for x, y in r] for r in rings] for rings in p]) for i, p in rows], f"plot_id int, parts {KIND}")
    found = grid.polygons(plots.select("plot_id", wkb.encoded("parts").alias("geometry")))
    assert found._jdf.queryExecution().executedPlan().toString().count("decoded_valid(") <= 2  # one evaluation, named in its output
    assert {r["plot_id"]: len(r["parts"]) for r in found.collect()} == {i: c[1] for i, c in enumerate(CASES.values()) if c[1]}


def test_polygons_of_one_file_are_repaired_by_several_tasks(spark):
    """One partition of a small table is dealt before the repair, which is what costs time."""
    box = [{"x": float(x), "y": float(y)} for x, y in ((0, 0), (4, 4), (4, 0), (0, 4), (0, 0))]
    one = spark.range(40).coalesce(1).select("id", F.lit(wkb.polygon_bytes([[box]])).alias("geometry"))
    tasks = grid.polygons(one).select("id", "valid", F.spark_partition_id().alias("task")).collect()
    assert sorted(r["id"] for r in tasks) == list(range(40)) and all(r["valid"] for r in tasks)
    assert len({r["task"] for r in tasks}) == 4


def test_point_on_surface(spark):
    rng = random.Random(5)
    shapes = [[[SQUARE, [(4, 0.5), (9, 0.5), (9, 9.5), (4, 9.5), (4, 0.5)]]], [[[(0, 0), (1, 0), (1, 1), (0, 0)]], [SQUARE]]]
    for _ in range(30):
        vs = [(rng.randint(0, 8), rng.randint(0, 8)) for _ in range(9)]
        shapes.append([[[*vs, vs[0]]]])
    rows = [(i, [[[(float(x), float(y)) for x, y in r] for r in rings] for rings in p]) for i, p in enumerate(shapes)]
    valid = spark.createDataFrame(rows, f"i int, parts {KIND}").select("i", repair.made_valid("parts")["parts"].alias("parts"))
    got = valid.select("i", "parts", geometry.representative_point(F.col("parts")).alias("p")).collect()
    for r in got:
        parts = [[[tuple(v) for v in ring] for ring in rings] for rings in r["parts"]]
        assert (r["p"] is None) == (not parts)
        if parts:
            assert odd(parts, *r["p"]) and not any(abs((b[0] - a[0]) * (r["p"][1] - a[1]) - (b[1] - a[1]) * (r["p"][0] - a[0])) < 1e-12 and min(a[1], b[1]) <= r["p"][1] <= max(a[1], b[1]) for a, b in edges(parts))
    places = {r["i"]: tuple(r["p"]) for r in got if r["p"]}
    assert places[0] == (2, 5) and places[1] == (5, 5.5)  # halfway between heights 1 and 10
