"""Validity repair: the rings of invalid geometries are cut where they meet and built anew.

What is inside follows the even-odd rule over all rings of a geometry, before and after. Edges of
a whole Arrow batch are looked through at once: they are dealt to halves of their geometry's
plane, and halves of these, until few share one, so that only those are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .wkb import PARTS, rings_of

Polygons = list[list[np.ndarray]]  # rings, the outer one first, as closed arrays of (x, y)
VALID = T.StructType([T.StructField("parts", PARTS), T.StructField("valid", T.BooleanType())])

LEAF = 24  # edges of a part of the plane that are compared with each other
PAIRS = 1 << 20  # pairs compared at a time
CLOSE = 2.0**-44  # of the largest coordinate: places closer than this are one
ROUNDS = 16  # of cutting: new vertices are rounded, and their edges may cross others anew


def _cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0]


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(1)


def _directions(a: np.ndarray, b: np.ndarray, cell: np.ndarray, n: int) -> list[np.ndarray]:
    """For each cell the directions it may be halved along: x, y, and across most of its edges."""
    d = b - a
    twice = 0.5 * np.arctan2(np.bincount(cell, 2 * d[:, 0] * d[:, 1], n), np.bincount(cell, d[:, 0] ** 2 - d[:, 1] ** 2, n))
    one, none = np.ones(n), np.zeros(n)
    return [np.stack((one, none), 1), np.stack((none, one), 1), np.stack((-np.sin(twice), np.cos(twice)), 1)]


def near_pairs(ends: np.ndarray, owner: np.ndarray, close: np.ndarray):
    """Arrays (i, j), i < j, of edges that share a cell of the plane: all pairs that meet are among them.

    ``ends`` are edges (n, 2, 2), ``owner`` their geometries, ``close`` the tolerance of each edge.
    """
    edge, cell = np.arange(len(ends)), np.unique(owner, return_inverse=True)[1]
    a, b = ends[:, 0], ends[:, 1]
    while len(edge):
        n = int(cell.max()) + 1
        size = np.bincount(cell, minlength=n)
        worst, sides = size.astype(float), [np.zeros(len(edge), bool)] * 2
        middle, along = np.zeros(n), np.zeros((n, 2))
        for u in _directions(a, b, cell, n):
            p, q, slack = _dot(a, u[cell]), _dot(b, u[cell]), close[edge]
            m = np.bincount(cell, (p + q) / 2, n) / np.maximum(size, 1)
            low, high = np.minimum(p, q) <= m[cell] + slack, np.maximum(p, q) >= m[cell] - slack
            most = np.maximum(np.bincount(cell, low, n), np.bincount(cell, high, n))
            better = most < worst
            worst, middle, along = np.where(better, most, worst), np.where(better, m, middle), np.where(better[:, None], u, along)
            sides = [np.where(better[cell], new, old) for new, old in zip((low, high), sides)]
        whole = (size <= LEAF) | (worst > 0.9 * size)
        yield from _all_pairs(edge[whole[cell]], cell[whole[cell]])
        halves = []
        for side, (own, sign) in enumerate(zip(sides, (1, -1))):
            k = np.flatnonzero(own & ~whole[cell])
            p, q, m = (sign * x for x in (_dot(a[k], along[cell[k]]), _dot(b[k], along[cell[k]]), middle[cell[k]]))
            with np.errstate(divide="ignore", invalid="ignore"):
                at = (a[k] + (b[k] - a[k]) * ((m - p) / (q - p))[:, None])
            halves.append((edge[k], 2 * cell[k] + side, np.where(((p > m) & (q < m))[:, None], at, a[k]), np.where(((q > m) & (p < m))[:, None], at, b[k])))
        edge, cell, a, b = (np.concatenate(x) for x in zip(*halves))
        cell = np.unique(cell, return_inverse=True)[1]


def _all_pairs(edge: np.ndarray, cell: np.ndarray):
    """The pairs of edges of the same cell, a bounded number at a time."""
    order = np.argsort(cell, kind="stable")
    edge, cell = edge[order], cell[order]
    last = np.searchsorted(cell, cell, "right")
    later = last - np.arange(len(edge)) - 1
    upto = np.concatenate(([0], np.cumsum(later)))
    at = 0
    while at < len(edge):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS, "right")) - 1)
        first = np.repeat(np.arange(at, to), later[at:to])
        second = first + 1 + np.arange(len(first)) - np.repeat(upto[at:to] - upto[at], later[at:to])
        i, j = edge[first], edge[second]
        yield np.minimum(i, j), np.maximum(i, j)
        at = to


def cuts(ends: np.ndarray, owner: np.ndarray, close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edge, place): where edges of one geometry meet inside an edge, be it at a crossing or at an end."""
    edges, places = [np.zeros(0, int)], [np.zeros((0, 2))]
    low, high = ends.min(1) - close[:, None], ends.max(1) + close[:, None]
    for i, j in near_pairs(ends, owner, close):
        meet = ((low[i] <= high[j]) & (low[j] <= high[i])).all(1)
        i, j = i[meet], j[meet]
        touched = np.zeros(len(i), bool)
        for e, f in ((i, j), (j, i)):  # an end of f lies on e
            d, slack = ends[e, 1] - ends[e, 0], close[e]
            length = np.sqrt(_dot(d, d))
            for end in (0, 1):
                p = ends[f, end] - ends[e, 0]
                along = _dot(p, d) / length
                on = (np.abs(_cross(d, p)) <= slack * length) & (along >= -slack) & (along <= length + slack)
                inner = on & (along > slack) & (along < length - slack)
                edges.append(e[inner])
                places.append(ends[f, end][inner])
                touched |= on
        d, g, between = ends[i, 1] - ends[i, 0], ends[j, 1] - ends[j, 0], ends[i, 0] - ends[j, 0]
        s, t = _cross(d, -between), _cross(d, ends[j, 1] - ends[i, 0])
        u, v = _cross(g, between), _cross(g, ends[i, 1] - ends[j, 0])
        proper = ~touched & (np.sign(s) * np.sign(t) < 0) & (np.sign(u) * np.sign(v) < 0)
        place = ends[i[proper], 0] + (u[proper] / (u[proper] - v[proper]))[:, None] * d[proper]
        edges += [i[proper], j[proper]]
        places += [place, place]
    return np.concatenate(edges), np.concatenate(places)


def _merged(points: np.ndarray, close: float) -> np.ndarray:
    """The points, those of a run of close ones all as its first; the first of equal x and y stays."""
    out = points.copy()
    order = np.lexsort((out[:, 1], out[:, 0]))
    near = np.flatnonzero(np.diff(out[order, 0]) <= close)
    if len(near):
        group = np.concatenate(([0], np.cumsum(np.diff(out[order, 0]) > close)))
        order = order[np.lexsort((out[order, 1], group))]
        group = np.sort(group)
        apart = np.concatenate(([True], (np.diff(group) > 0) | (np.diff(out[order, 1]) > close)))
        first = order[apart][np.cumsum(apart) - 1]
        out[order] = points[first]
    return out


def _odd(ends: np.ndarray, close: float) -> np.ndarray:
    """Edges that occur an odd number of times in either direction; those without length go."""
    flat = _merged(ends.reshape(-1, 2), close)
    points, number = np.unique(flat, axis=0, return_inverse=True)
    pairs, times = np.unique(np.sort(number.reshape(-1, 2), 1), axis=0, return_counts=True)
    return points[pairs[(times % 2 == 1) & (pairs[:, 0] != pairs[:, 1])]]


def _split(ends: np.ndarray, close: float) -> tuple[np.ndarray, bool]:
    """The edges, cut until they meet at their ends alone, and whether they do; those that lie twice on each other go."""
    ends = _odd(ends, close)
    for _ in range(ROUNDS):
        edge, place = cuts(ends, np.zeros(len(ends), int), np.full(len(ends), close))
        if not len(edge):
            return ends, True
        d = ends[edge, 1] - ends[edge, 0]
        along = _dot(place - ends[edge, 0], d) / _dot(d, d)
        own = np.arange(len(ends))
        every = np.concatenate((own, edge, own))
        rank = np.concatenate((np.full(len(own), -np.inf), along, np.full(len(own), np.inf)))
        points = np.concatenate((ends[:, 0], place, ends[:, 1]))
        order = np.lexsort((rank, every))
        every, points = every[order], points[order]
        same = every[1:] == every[:-1]
        ends = _odd(np.stack((points[:-1][same], points[1:][same]), 1), close)
    return ends, False


def _loops(walk: list[int]) -> list[list[int]]:
    """A closed walk over vertices, cut into loops that come to no vertex twice."""
    loops, path, seen = [], [], {}
    for v in walk:
        if v in seen:
            at = seen[v]
            loops.append(path[at:])
            for w in path[at:]:
                del seen[w]
            del path[at:]
        seen[v] = len(path)
        path.append(v)
    return [*loops, path]


def _area(ring: np.ndarray) -> float:
    x, y = (ring - ring[0]).T
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)


def enclosed(ends: np.ndarray) -> Polygons:
    """What edges that meet at their ends alone enclose by the even-odd rule; outer rings go anticlockwise."""
    if not len(ends):
        return []
    points, number = np.unique(ends.reshape(-1, 2), axis=0, return_inverse=True)
    origin = number.reshape(-1)  # directed edge h leaves origin[h], and h ^ 1 is the same one backwards
    h = np.arange(len(origin))
    d = points[origin[h ^ 1]] - points[origin]
    around = np.lexsort((np.arctan2(d[:, 1], d[:, 0]), origin))
    starts = np.searchsorted(origin[around], np.arange(len(points) + 1))
    position = np.empty_like(h)
    position[around] = h
    first = starts[origin]
    before = around[np.where(position == first, starts[origin + 1], position) - 1]  # clockwise, at the origin
    follows = before[h ^ 1].tolist()

    face, walks = [-1] * len(h), []  # the face on the left of a directed edge, and a walk along it
    for start in range(len(h)):
        if face[start] < 0:
            walk, at = [], start
            while face[at] < 0:
                face[at] = len(walks)
                walk.append(at)
                at = follows[at]
            walks.append(walk)
    leader = np.arange(len(walks))

    def root(f: int) -> int:
        while leader[f] != f:
            leader[f] = leader[leader[f]]
            f = leader[f]
        return int(f)

    for k in range(0, len(h), 2):
        leader[root(face[k])] = root(face[k + 1])
    piece = np.array([root(f) for f in face])  # connected edges

    inside: dict[int, bool] = {}
    around_of: dict[int, int | None] = {}  # a piece's outer face: the face of another piece that it is part of
    down = h[points[origin, 1] > points[origin[h ^ 1], 1]]
    ranked = np.lexsort((points[origin, 1], points[origin, 0]))
    for at in ranked[np.sort(np.unique(piece[ranked], return_index=True)[1])].tolist():
        v, own = origin[at], around[starts[origin[at]] : starts[origin[at] + 1]]
        outer, p = face[int(own[-1])], points[v]
        top, low = points[origin[down]], points[origin[down ^ 1]]
        met = (piece[down] != piece[at]) & (low[:, 1] <= p[1]) & (top[:, 1] > p[1])
        slope = (top[met, 0] - low[met, 0]) / (top[met, 1] - low[met, 1])
        x = low[met, 0] + (p[1] - low[met, 1]) * slope
        left = np.flatnonzero(x < p[0])
        container = None
        if len(left):
            container = face[int(down[met][left[np.lexsort((slope[left], x[left]))[-1]]])]
            container = around_of.get(container, container)
        around_of[outer] = container
        inside[outer] = container is not None and inside[container]
        todo = [outer]
        while todo:
            f = todo.pop()
            for edge in walks[f]:
                g = face[edge ^ 1]
                if g not in inside:
                    inside[g] = not inside[f]
                    todo.append(g)

    polygons: dict[int, list[np.ndarray]] = {}
    holes: list[tuple[int | None, np.ndarray]] = []
    for f, walk in enumerate(walks):
        if inside[f]:
            for loop in _loops([int(origin[e]) for e in walk]):
                ring = points[loop]
                if f not in around_of and _area(ring) > 0:
                    polygons[f] = [np.vstack((ring, ring[:1]))]
                elif _area(ring) < 0:
                    holes.append((around_of.get(f, f), np.vstack((ring, ring[:1]))))
    for f, ring in holes:
        if f in polygons:
            polygons[f].append(ring)
    return sorted(polygons.values(), key=lambda rings: tuple(rings[0].min(0)))


def _ring_sets(polygons: Polygons) -> list:
    return sorted((sorted(map(tuple, rings[0][1:].tolist())), sorted(sorted(map(tuple, r[1:].tolist())) for r in rings[1:])) for rings in polygons)


def _cleaned(vertices: np.ndarray) -> np.ndarray | None:
    """A ring, closed, without vertices that repeat the one before; None if it has no extent or one is not finite."""
    if not len(vertices) or not np.isfinite(vertices).all():
        return None
    ring = np.vstack((vertices, vertices[:1]))
    ring = ring[np.concatenate(([True], (ring[1:] != ring[:-1]).any(1)))]
    return ring if len(ring) > 3 else None


def _levels(parts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Starts of each level's lists in the next one, and the vertices."""
    starts = []
    for _ in range(3):
        sizes = pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False)
        starts.append(np.concatenate(([0], np.cumsum(sizes))).astype(int))
        parts = parts.flatten()
    return starts, np.stack([np.asarray(parts.field(k).to_numpy(zero_copy_only=False), float) for k in (0, 1)], 1)


def _read(parts: pa.Array) -> list[Polygons | None]:
    (of_polygons, of_rings, of_vertices), vertices = _levels(parts)
    return [
        None
        if null
        else [[vertices[of_vertices[r] : of_vertices[r + 1]] for r in range(of_rings[p], of_rings[p + 1])] for p in range(of_polygons[g], of_polygons[g + 1])]
        for g, null in enumerate(parts.is_null().to_pylist())
    ]


def repair_batch(geometries: list[Polygons | None]) -> tuple[list[Polygons | None], np.ndarray]:
    """The geometries made valid, and for each whether that has come to an end; None stays None."""
    found: list = []
    for polygons in geometries:
        kept = [[r for r in map(_cleaned, rings) if r is not None] for rings in polygons or []]
        found.append(None if polygons is None else [rings for rings in kept if rings])
    valid = np.ones(len(found), bool)
    rings = [(g, r) for g, polygons in enumerate(found) for one in polygons or [] for r in one]
    if not rings:
        return found, valid
    owner = np.repeat([g for g, _ in rings], [len(r) - 1 for _, r in rings])
    ends = np.concatenate([np.stack((r[:-1], r[1:]), 1) for _, r in rings])
    scale = np.zeros(len(found))
    np.maximum.at(scale, owner, np.abs(ends).max((1, 2)))
    close = scale * CLOSE
    doubtful = np.bincount([g for g, _ in rings], minlength=len(found)) > 1
    doubtful[owner[cuts(ends, owner, close[owner])[0]]] = True
    corners = np.column_stack((owner, ends[:, 0]))
    corners = corners[np.lexsort(corners.T[::-1])]
    doubtful[corners[1:][(corners[1:] == corners[:-1]).all(1), 0].astype(int)] = True
    for g in np.flatnonzero(doubtful).tolist():
        own, valid[g] = _split(ends[owner == g], close[g])
        new = enclosed(own)
        if _ring_sets(new) != _ring_sets(found[g]):
            found[g] = new
    return found, valid


def _arrow(found: list) -> pa.Array:
    polygons = [p for one in found for p in one or []]
    rings = [r for p in polygons for r in p]
    flat = np.concatenate([*rings, np.zeros((0, 2))])

    def listed(sizes: list[int], values: pa.Array, null: list[bool] | None = None) -> pa.Array:
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), values, mask=None if null is None else pa.array(null))

    values = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["x", "y"])
    inner = listed([len(p) for p in polygons], listed([len(r) for r in rings], values))
    return listed([len(one or []) for one in found], inner, [one is None for one in found])


def _repaired(geometries: list[Polygons | None]) -> pa.Array:
    found, valid = repair_batch(geometries)
    null = pa.array([one is None for one in found])
    return pa.StructArray.from_arrays([_arrow(found), pa.array(valid)], ["parts", "valid"], mask=null)


@F.arrow_udf(VALID)
def made_valid(parts: pa.Array) -> pa.Array:
    """(parts, valid): ``parts`` as a valid geometry that encloses the same by the even-odd rule.

    A geometry that is valid already keeps its rings and their order; only rings left open are
    closed and repeated vertices dropped. In others rings are cut where they cross or touch; what lies
    twice in the same place goes, so spikes vanish, polygons that share an edge become one, and
    where two overlap is outside. Rings with a coordinate that is missing or not finite go; a geometry
    without area has no parts; null stays null. ``valid`` is false where crossings were left after
    ROUNDS rounds of cutting.
    """
    return _repaired(_read(parts))


@F.arrow_udf(VALID)
def decoded_valid(wkb: pa.Array) -> pa.Array:
    """(parts, valid) of a geometry column's bytes: ``wkb.decoded`` and ``made_valid`` in one step."""
    return _repaired([rings_of(b) for b in wkb.to_pylist()])
