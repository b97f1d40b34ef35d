"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles. Equal sets are one item at once. Items enter
independent trees: a tree's root level deals them by one minwise token. Members of a node that
holds many items are first linked with a sample of its members, in a few trees ahead. A node that
this makes one component is done; a node of items little alike is dealt again by further minwise
tokens, chosen by the node itself, along two paths at every level; large nodes of items much alike
meet a sample of their members too, and those outside a node's largest component are compared with
all others, block by block. Nodes small enough and blocks
are compared exhaustively on sketches of the minwise tokens; pairs that may reach the threshold
are candidates. Of a node's candidates between components only a
spanning forest is confirmed first, on the full sets; where a confirmation fails, the full sets of
the members that still have a candidate in another component come to the node, and it compares
those exactly. So a large group of copies costs rows in proportion to its size, and no link
between different components is left out.

Components come from alternating large-star and small-star steps on the confirmed links.
Whatever a later step reads is a table in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_batches

WORDS = 5  # of a shingle
TREES = 12
SKETCH = 256  # minwise tokens of an item, one byte each
LEAF = 2048  # items of a node that is compared exhaustively
DEPTH = 8  # split levels, two paths at each; larger nodes below are compared block by block
MARKS = 8  # minwise tokens that tell how much alike the members of a large node are
PIVOTS = 32  # members of a large node, on average, that all its members are compared with
ALIKE = 0.5  # mean similarity from which dealing a node again costs more than its blocks
MOSTLY = 0.5  # share of a node's members in one component from which only the others are looked at
AHEAD = 3  # trees whose large nodes meet pivots before all trees are dealt
SIGMAS = 3.6  # how far below the threshold a sketch may fall by chance
WORD_BYTES = 16 << 20  # of remembered words, with what each takes beside its letters
HEAVY = 4_000_000  # shingles of a node's members beyond which its candidates are confirmed pair by pair

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


#: Odd factors, one for each order of the items.
_ODD = _mix(_mix(np.arange(1, SKETCH + 1, dtype=np.uint64) * _STEP)) | np.uint64(1)


class _Words(dict):
    """64-bit hashes of words met in this task, of bounded number and length."""

    room = WORD_BYTES

    def __missing__(self, word: bytes) -> int:
        self.room -= len(word) + 100
        if self.room < 0:
            self.clear()
            self.room = WORD_BYTES
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def _forgetting(run):
    """``run`` for a task; what it has remembered and freed is given back, as other stages' tasks need it too."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _words.clear()
            _words.room = WORD_BYTES
            pa.default_memory_pool().release_unused()

    return task


def shingles(text: str) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text, A-Z lower-cased; empty without words.

    Words are separated by blanks and the ASCII controls from tab to carriage return; a text of
    fewer words than a shingle has is one shingle.
    """
    found = text.encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_words.__getitem__, found), np.uint64, len(found))
    size = min(WORDS, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        h = h * _STEP + w[k : k + len(h)]
    return np.unique(_mix(h))


def minwise(items: np.ndarray) -> np.ndarray:
    """The item that comes first in each of SKETCH orders (multiplied hashes)."""
    best = np.full(SKETCH, np.iinfo(np.uint64).max)
    for at in range(0, len(items), 2048):
        best = np.minimum(best, (items[at : at + 2048, None] * _ODD).min(0))
    return best


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            found = shingles(text)
            if len(found):
                best = minwise(found)
                rows.append((len(found), xxhash.xxh3_128_digest(found.tobytes()), (_mix(best) >> np.uint64(56)).astype(np.uint8).tobytes(), best[:TREES].view(np.int64)))
            else:
                rows.append((0, None, None, None))
        sizes, ids, sketches, roots = zip(*rows) if rows else ((), (), (), ())
        arrays = [batch.column("doc_id"), batch.column("h"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(sketches, pa.binary()), pa.array(roots, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "h", "n_shingles", "set_id", "sketch", "roots"])


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that come sorted by ``column``."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        last = table.column(column)[-1].as_py()
        keys = table.column(column).to_numpy()
        cut = int(np.searchsorted(keys, last))
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint8).reshape(-1, SKETCH)


def _pairs(sketch: np.ndarray, sizes: np.ndarray, labels: np.ndarray, least: float, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs i < j of rows of different labels that agree in at least ``least`` places, and in how many.

    Sets whose sizes alone rule the threshold out are no pair.
    """
    ii, jj, nn = [], [], []
    for i in range(len(sketch) - 1):
        fits = (100 * sizes[i + 1 :] >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes[i + 1 :])
        near = np.flatnonzero(fits & (labels[i + 1 :] != labels[i])) + i + 1
        same = np.count_nonzero(sketch[near] == sketch[i], axis=1)
        at = np.flatnonzero(same >= least)
        ii.append(np.full(len(at), i))
        jj.append(near[at])
        nn.append(same[at])
    return tuple(map(np.concatenate, (ii, jj, nn))) if ii else (np.empty(0, int),) * 3


def _find(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _in_order(i: np.ndarray, j: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int]]:
    """The pairs, those that agree in most places first."""
    order = np.argsort(-n, kind="stable")
    for at in range(0, len(order), 4096):
        part = order[at : at + 4096]
        yield from zip(i[part].tolist(), j[part].tolist())


def _by_label(labels: list[int]) -> list[int]:
    """Parents for ``_find``: members of one label hang on the first of them."""
    first: dict[int, int] = {}
    return [first.setdefault(x, k) for k, x in enumerate(labels)]


def _pivot_edges(least: float, percent: int):
    """For each part of a large node: a spanning forest over candidates of a member and a pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "part"):
            keys = table.column("part").to_numpy()
            out = []
            for rows in np.split(np.arange(len(keys)), np.flatnonzero(keys[1:] != keys[:-1]) + 1):
                own = table.slice(int(rows[0]), len(rows))
                ids, sizes, sketch = own.column("rep").to_numpy(), own.column("n").to_numpy(), _matrix(own.column("sketch"))
                pivot = own.column("pivot").to_numpy()
                members, pivots = np.flatnonzero(pivot == 0), np.flatnonzero(pivot == 1)
                ii, jj, nn = [], [], []
                for p in pivots.tolist():
                    others = members[ids[members] != ids[p]]
                    same = np.count_nonzero(sketch[others] == sketch[p], axis=1)
                    at = (same >= least) & (100 * sizes[others] >= percent * sizes[p]) & (100 * sizes[p] >= percent * sizes[others])
                    ii.append(np.full(int(at.sum()), p)), jj.append(others[at]), nn.append(same[at])
                parent, left, right = _by_label(ids.tolist()), [], []
                if ii:
                    for x, y in _in_order(*map(np.concatenate, (ii, jj, nn))):
                        a, b = _find(parent, x), _find(parent, y)
                        if a != b:
                            parent[max(a, b)] = min(a, b)
                            left.append(int(ids[x])), right.append(int(ids[y]))
                out.append((left, right))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int64())) for c in columns], names=["left", "right"])

    return run


def _leaf_edges(least: float, percent: int):
    """For each node: a spanning forest over the candidates between components, the likeliest first.

    A node whose candidates are more than that forest comes with its members, sizes and sketches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "node"):
            keys = table.column("node").to_numpy()
            ids = table.column("rep").to_numpy()
            sizes = table.column("n").to_numpy()
            sketch, known = _matrix(table.column("sketch")), table.column("label").to_numpy()
            begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            size = np.diff(np.append(begin, len(keys)))
            out: list[tuple] = []
            for b, m in zip(begin[size > 1].tolist(), size[size > 1].tolist()):
                own = slice(b, b + m)
                i, j, n = _pairs(sketch[own], sizes[own], known[own], least, percent)
                if not len(i):
                    continue
                parent, left, right = _by_label(known[own].tolist()), [], []
                for x, y in _in_order(i, j, n):
                    p, q = _find(parent, x), _find(parent, y)
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        left.append(int(ids[b + x])), right.append(int(ids[b + y]))
                        if len(left) == m - 1:
                            break
                more = (ids[own], sizes[own], sketch[own].tobytes()) if len(i) > len(left) else (None, None, None)
                out.append((int(keys[b]), left, right, *more))
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64(), *(pa.list_(pa.int64()) for _ in range(4)), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["node", "left", "right", "members", "sizes", "sketches"])

    return run


def _open_pairs(batch: pa.RecordBatch, least: float, percent: int) -> Iterator[tuple]:
    """Of each node: its key, members, sizes, sketches, labels, and the candidates between labels."""
    for node, members, sizes, data, known in zip(*(batch.column(c).to_pylist() for c in ("node", "members", "sizes", "sketches", "labels"))):
        own = dict(known or ())
        ids, sketch = np.array(members), np.frombuffer(data, np.uint8).reshape(-1, SKETCH)
        labels = np.array([own.get(x, x) for x in members])
        i, j, _ = _pairs(sketch, np.array(sizes), labels, least, percent)
        yield node, ids, sizes, sketch, labels, i, j


def _open_members(least: float, percent: int):
    """(node, rep, n, sketch, label): members with a candidate in another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for node, ids, sizes, sketch, labels, i, j in _open_pairs(batch, least, percent):
                out += [(node, int(ids[k]), sizes[k], sketch[k].tobytes(), int(labels[k])) for k in np.union1d(i, j).tolist()]
            columns = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["node", "rep", "n", "sketch", "label"])

    return run


def _rest_edges(least: float, percent: int):
    """Candidates of nodes between members of different components, as pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ids, _, _, _, i, j in _open_pairs(batch, least, percent):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))], names=["a", "b"])

    return run


def _exact_links(least: float, percent: int):
    """Links between components inside nodes that hold their members' full sets; a forest of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "node"):
            keys = table.column("node").to_numpy()
            a, b = [], []
            for rows in np.split(np.arange(len(keys)), np.flatnonzero(keys[1:] != keys[:-1]) + 1):
                part = table.slice(int(rows[0]), len(rows))
                ids, labels = part.column("rep").to_numpy(), part.column("label").to_numpy()
                own = [np.frombuffer(x, np.uint64) for x in part.column("shingles").to_pylist()]
                i, j, n = _pairs(_matrix(part.column("sketch")), part.column("n").to_numpy(), labels, least, percent)
                parent = _by_label(labels.tolist())
                for x, y in _in_order(i, j, n):
                    p, q = _find(parent, x), _find(parent, y)
                    if p != q and _linked(own[x], own[y], percent):
                        parent[max(p, q)] = min(p, q)
                        a.append(int(min(ids[x], ids[y]))), b.append(int(max(ids[x], ids[y])))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _confirm(percent: int):
    """Keeps pairs of texts whose full shingle sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in batches:
            keep = []
            for a, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "text_a", "text_b"))):
                if a != last:
                    last, known = a, shingles(x)
                keep.append(_linked(known, shingles(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _labelled(items: DataFrame, found: DataFrame) -> DataFrame:
    """``items`` with ``label``: the component that each belongs to so far, or the item itself."""
    return items.drop("label").join(found.select(F.col("id").alias("rep"), "root"), "rep", "left").withColumn("label", F.coalesce("root", "rep")).drop("root")


def _held(scratch: Scratch, level: DataFrame) -> DataFrame:
    """``level`` (node, rep, label) with each node's number of members ``n`` and one of them.

    Nodes that are one component already hold nothing to find and are left out. The nodes are a
    table, so that the planner sends it to the members where it is small.
    """
    counts = level.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("pivot"), F.min("label").alias("low"), F.max("label").alias("high"))
    nodes = scratch.table(counts.filter("n > 1 and low < high").select("node", "n", "pivot"))
    return scratch.table(level.join(nodes, "node"))


def _main(big: DataFrame) -> DataFrame:
    """(node, main, m, mostly): each node's largest component, its members, and whether they are most of the node."""
    sizes = big.groupBy("node", "label").agg(F.count(F.lit(1)).alias("m"))
    of_node = sizes.groupBy("node").agg(F.max(F.struct("m", "label")).alias("most"), F.sum("m").alias("all"))
    open_nodes = of_node.filter("most.m < all")
    return open_nodes.select("node", F.col("most.label").alias("main"), F.col("most.m").alias("m"), (F.col("most.m") >= MOSTLY * F.col("all")).alias("mostly"))


def _alike(marked: DataFrame) -> DataFrame:
    """(node, alike): the share of a node's pairs that agree in a place of ``marks``, over all its members."""
    each = marked.select("node", "marks", F.explode(F.sequence(F.lit(1), F.lit(MARKS))).alias("k"))
    counts = each.groupBy("node", "k", F.expr("substring(marks, k, 1)").alias("byte")).agg(F.count(F.lit(1)).cast("double").alias("c"))
    return counts.groupBy("node").agg((MARKS * F.sum(F.col("c") * F.col("c")) / (F.sum("c") * F.sum("c"))).alias("alike"))


def _leaves(scratch: Scratch, texts: DataFrame, items: DataFrame, least: float, percent: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(node, rep): members of all nodes and blocks that are compared exhaustively, over all trees.

    With them come the items with their labels, and (id, root), the components behind these that
    the pivots of large nodes have found.
    """

    def dealt(now: DataFrame, trees: int) -> DataFrame:
        rows = now.select("rep", "label", F.posexplode(F.slice("roots", 1, trees)).alias("tree", "token"))
        # Counted and then joined: written, so that items are dealt once.
        return scratch.table(rows.select(F.xxhash64("tree", "token").alias("node"), "rep", "label"))

    def joined(one: DataFrame | None, other: DataFrame) -> DataFrame:
        return other if one is None else one.unionByName(other)

    found, now = None, items
    # The large nodes of some trees go ahead: of a group that they make one component, the other
    # trees' nodes then hold little else to look at.
    ahead = dealt(now, AHEAD)
    big = _held(scratch, ahead).filter(F.col("n") > LEAF)
    scratch.drop(ahead)
    if not big.isEmpty():
        found = _contracted(scratch, texts, items, big, found, least, percent)
        now = scratch.table(_labelled(items, found))
    leaves, pool, level = None, None, dealt(now, TREES)
    for depth in range(DEPTH + 1):
        held = _held(scratch, level)
        scratch.drop(level)
        leaves = joined(leaves, held.filter(F.col("n") <= LEAF).select("node", "rep"))
        big = held.filter(F.col("n") > LEAF)
        if big.isEmpty():
            break
        places = [F.pmod(F.xxhash64("node", F.lit(k), F.lit("place")), F.lit(SKETCH)).cast("int") + 1 for k in range(MARKS)]
        marks = F.concat(*(F.substring("sketch", place, F.lit(1)) for place in places))
        main = scratch.table(_main(big))
        marked = scratch.table(
            big.join(main.select("node", "mostly"), "node").join(items.select("rep", "sketch"), "rep").select("node", "rep", "label", "n", "pivot", "mostly", marks.alias("marks"))
        )
        # A node that is mostly one component, or of items much alike, waits for the blocks.
        alike = scratch.table(_alike(marked))
        known = marked.join(alike, "node")
        stays = F.lit(True) if depth == DEPTH else F.col("mostly") | (F.col("alike") >= ALIKE)
        pool = joined(pool, known.filter(stays).select("node", "rep", "n", "pivot", "mostly"))
        loose = known.filter(~stays)
        if loose.isEmpty():
            break
        forks = loose.select("node", "rep", "label", "marks", F.explode(F.array(F.lit(1), F.lit(2))).alias("fork"))
        level = scratch.table(forks.select(F.xxhash64("node", "fork", F.expr("substring(marks, fork, 1)")).alias("node"), "rep", "label"))
    if pool is not None:
        pool = scratch.table(pool)
        mixed = pool.filter("not mostly")
        if not mixed.isEmpty():
            found = _contracted(scratch, texts, items, mixed, found, least, percent)
            now = scratch.table(_labelled(items, found))
        labelled = scratch.table(pool.select("node", "rep").join(now.select("rep", "label"), "rep"))
        leaves = joined(leaves, _blocks(labelled.join(scratch.table(_main(labelled)), "node")))
    return leaves, now, found


def _contracted(scratch: Scratch, texts: DataFrame, items: DataFrame, big: DataFrame, found: DataFrame | None, least: float, percent: int) -> DataFrame:
    """``found`` with the confirmed links of large nodes' members and pivots."""
    parts = F.ceil(F.col("n") / (LEAF // 2))
    pivots = big.filter((F.pmod(F.xxhash64("rep", "node"), F.ceil(F.col("n") / PIVOTS)) == 0) | (F.col("rep") == F.col("pivot")))
    spread = pivots.select("node", "rep", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("p"), F.lit(1).alias("pivot"))
    own = big.select("node", "rep", F.pmod(F.xxhash64("rep", F.lit("part")), parts).alias("p"), F.lit(0).alias("pivot"))
    dealt = own.unionByName(spread).join(items.select("rep", "n", "sketch"), "rep")
    dealt = dealt.select(F.xxhash64("node", "p").alias("part"), "node", "rep", "n", "sketch", "pivot")
    compared = map_batches(
        dealt.repartition("part").sortWithinPartitions("part", "rep"), _pivot_edges(least, percent), "left array<long>, right array<long>"
    )
    edges = compared.select(F.explode(F.arrays_zip("left", "right")).alias("e")).select(
        F.least("e.left", "e.right").alias("a"), F.greatest("e.left", "e.right").alias("b")
    )
    links = _confirmed(scratch, texts, items, scratch.table(edges.distinct()), percent)
    if found is None:
        return scratch.table(components(scratch, links))
    return found if links.isEmpty() else _merged(scratch, found, links)


def _blocks(rest: DataFrame) -> DataFrame:
    """(node, rep): members outside their node's largest component with all members, as blocks.

    Nodes with one largest component are one node here, whose members come once: trees find a
    group again and again, and what is outside it in any of them is compared with it once. Both
    kinds of members are dealt into chunks, those outside first; a block is two chunks, one of
    them outside at least.
    """
    half = max(1, LEAF // 2)
    outside = F.col("label") != F.col("main")
    members = rest.groupBy("main", "rep").agg(F.max(outside).alias("outside"))
    sizes = members.groupBy("main").agg(F.count(F.lit(1)).alias("n"), F.count_if("outside").alias("out"))
    outer = F.ceil(F.col("out") / half)
    inner = F.ceil((F.col("n") - F.col("out")) / half)
    hashed = F.xxhash64("rep", F.lit("chunk"))
    placed = members.join(sizes, "main").select(
        F.xxhash64("main", F.lit("blocks")).alias("node"), "rep", "outside", outer.alias("outer"), (outer + inner).alias("all"),
        F.when(F.col("outside"), F.pmod(hashed, outer)).otherwise(outer + F.pmod(hashed, inner)).alias("c"),
    )
    partners = F.sequence(F.lit(0).cast("long"), F.when(F.col("outside"), F.col("all")).otherwise(F.col("outer")) - 1)
    paired = placed.select("node", "rep", "c", F.explode(partners).alias("other")).filter("c <> other")
    return paired.select(F.xxhash64("node", F.least("c", "other"), F.greatest("c", "other")).alias("node"), "rep")


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(id, root) for every id of ``links`` (a, b): the smallest id that it reaches."""
    edges = scratch.table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    while True:
        # Done when all edges form stars: no id has two roots, and no root has one.
        ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("own"), F.lit(0).alias("root")).unionByName(
            edges.select(F.col("v").alias("id"), F.lit(0).alias("own"), F.lit(1).alias("root"))
        )
        if ends.groupBy("id").agg(F.sum("own").alias("own"), F.max("root").alias("root")).filter("own + root > 1 and own > 0").isEmpty():
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
            )
        # Large star: larger neighbours move to the smallest neighbour.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least2 = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least2, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        small = scratch.table(moved.select("e.u", "e.v").filter("u <> v").distinct())
        scratch.drop(edges)
        edges = small


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash) for every row of ``docs``.

    Two documents are linked if the Jaccard similarity of their shingle sets is at least
    ``percent``/100; ``component_id`` is the smallest id that links reach, and the document of
    that id is ``kept``. ``text_hash`` (xxhash64 of the text, of the empty one for null) tells rows
    of one key apart.

    Edge cases: null and empty texts, and texts without words, have no shingles and stand alone;
    a row with a null key stands alone with a null component and is kept; rows that repeat a key
    are each placed by their own text (a key's texts count as one document where they stand for
    their sets); an empty table gives an empty one. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "near")
    least = SKETCH * (percent / 100 - SIGMAS * (percent / 100 * (1 - percent / 100) / SKETCH) ** 0.5)
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    described = scratch.table(
        map_batches(texts, _forgetting(_describe), "doc_id long, h long, n_shingles long, set_id binary, sketch binary, roots array<long>")
    )
    sets = described.filter("set_id is not null and doc_id is not null")
    items = scratch.table(
        sets.groupBy("set_id")
        .agg(F.min(F.struct("doc_id", "h")).alias("first"), F.min("n_shingles").alias("n"), F.min("sketch").alias("sketch"), F.min("roots").alias("roots"))
        .select("set_id", F.col("first.doc_id").alias("rep"), F.col("first.doc_id").alias("label"), F.col("first.h").alias("h"), "n", "sketch", "roots")
    )
    leaves, now, known = _leaves(scratch, texts, items, least, percent)
    dealt = leaves.join(now.select("rep", "n", "sketch", "label"), "rep").select("node", "rep", "n", "sketch", "label")
    sorted_nodes = dealt.repartition("node").sortWithinPartitions("node", "rep")
    compared = scratch.table(
        map_batches(sorted_nodes, _forgetting(_leaf_edges(least, percent)), "node long, left array<long>, right array<long>, members array<long>, sizes array<long>, sketches binary")
    )
    edges = compared.select(F.explode(F.arrays_zip("left", "right")).alias("e")).select(
        F.least("e.left", "e.right").alias("a"), F.greatest("e.left", "e.right").alias("b")
    )
    edges = edges.filter("a < b")
    tested = scratch.table(edges.distinct())
    links = _confirmed(scratch, texts, items, tested, percent)
    failed = tested.join(links, ["a", "b"], "left_anti")
    found = scratch.table(components(scratch, links)) if known is None else _merged(scratch, known, links)
    if not failed.isEmpty():
        more = _second_look(scratch, texts, items, compared, failed, found, least, percent)
        if not more.isEmpty():
            found = _merged(scratch, found, more)
    roots = found.select(F.col("id").alias("rep"), "root")
    of_set = scratch.table(items.select("set_id", "rep").join(roots, "rep", "left").select("set_id", F.coalesce("root", "rep").alias("component_id")))
    own = ["doc_id", "n_shingles", "set_id", "h"]
    # Documents without words stand alone: they need no join, in which they would all meet at null.
    worded = described.filter("set_id is not null").select(own).join(of_set, "set_id", "left")
    joined = worded.unionByName(described.filter("set_id is null").select(*own, F.lit(None).cast("long").alias("component_id")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), F.col("h").alias("text_hash"))


def _merged(scratch: Scratch, found: DataFrame, more: DataFrame) -> DataFrame:
    """``found`` (id, root) after further links: components of the roots that these connect."""

    def rooted(df: DataFrame, side: str) -> DataFrame:
        own = found.select(F.col("id").alias(side), F.col("root").alias(f"root_{side}"))
        return df.join(own, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))

    links = scratch.table(rooted(rooted(more, "a"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    joined = components(scratch, links).select(F.col("id").alias("root"), F.col("root").alias("new"))
    # Ids that had no link before are roots of their own.
    every = found.unionByName(links.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("root")))
    return scratch.table(every.join(joined, "root", "left").groupBy("id").agg(F.min(F.coalesce("new", "root")).alias("root")))


def _texts_of(scratch: Scratch, texts: DataFrame, items: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, text) of the items ``reps`` (rep, distinct), a written table whose size the planner knows.

    Below its bound for broadcasts no text moves to be found; beyond it, texts meet the items by a shuffle.
    """
    wanted = scratch.table(reps.join(items.select("rep", "h"), "rep"))
    return (
        texts.join(wanted.withColumnRenamed("rep", "doc_id"), ["doc_id", "h"])
        .dropDuplicates(["doc_id", "h"])
        .select(F.col("doc_id").alias("rep"), "text")
    )


def _confirmed(scratch: Scratch, texts: DataFrame, items: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of items whose full sets reach the threshold; texts move only for these."""
    own = scratch.table(_texts_of(scratch, texts, items, pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()))
    sided = pairs.join(own.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a").join(
        own.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b"
    )
    out = scratch.table(map_batches(sided.select("a", "b", "text_a", "text_b"), _forgetting(_confirm(percent)), "a long, b long").distinct())
    scratch.drop(own)
    return out


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array((shingles(t).tobytes() for t in batch.column("text").to_pylist()), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("rep"), found], names=["rep", "shingles"])


def _second_look(
    scratch: Scratch, texts: DataFrame, items: DataFrame, compared: DataFrame, failed: DataFrame, found: DataFrame, least: float, percent: int
) -> DataFrame:
    """Confirmed links between different components in nodes whose forest lost an edge."""
    nodes = compared.filter("members is not null")
    lost = (
        nodes.select("node", F.explode(F.arrays_zip("left", "right")).alias("e"))
        .select("node", F.least("e.left", "e.right").alias("a"), F.greatest("e.left", "e.right").alias("b"))
        .join(failed, ["a", "b"], "left_semi")
        .select("node")
        .distinct()
    )
    open_nodes = nodes.join(lost, "node", "left_semi").select("node", "members", "sizes", "sketches").dropDuplicates(["node"])
    labels = (
        open_nodes.select("node", F.explode("members").alias("id"))
        .join(found, "id")
        .groupBy("node")
        .agg(F.map_from_entries(F.collect_set(F.struct("id", "root"))).alias("labels"))
    )
    labelled = scratch.table(open_nodes.join(labels, "node", "left"))
    shingles_held = F.aggregate("sizes", F.lit(0).cast("long"), lambda s, n: s + n)
    members = scratch.table(
        map_batches(labelled.filter(shingles_held <= HEAVY), _open_members(least, percent), "node long, rep long, n long, sketch binary, label long")
    )
    own = map_batches(_texts_of(scratch, texts, items, members.select("rep").distinct()), _forgetting(_sets), "rep long, shingles binary")
    dealt = members.join(own, "rep").repartition("node").sortWithinPartitions("node", "rep")
    links = scratch.table(map_batches(dealt, _forgetting(_exact_links(least, percent)), "a long, b long").distinct())
    heavy = labelled.filter(shingles_held > HEAVY)
    if heavy.isEmpty():
        return links
    pairs = scratch.table(map_batches(heavy, _rest_edges(least, percent), "a long, b long").distinct())
    return links.unionByName(_confirmed(scratch, texts, items, pairs, percent))
