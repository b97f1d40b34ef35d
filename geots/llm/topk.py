"""Exact top-k inner-product search by norm order and rotated partial sums.

The vectors are rotated by the singular vectors of the whole collection, which moves most of
each length into the first components. Candidates are cut into stripes by descending length and
written once. The first stripe, the longest vectors, is searched for all queries; the k-th score
found there is a query's floor. By Cauchy-Schwarz a query then needs the stripes alone whose
longest vector can lift its product of lengths to the floor: the first so many, its reach. Queries
are put into blocks by reach, and a stripe meets the blocks that reach it; no other rows are
shuffled. A task holds one stripe and one block and goes through its candidates by descending
length, by the same bound; partial sums over the first rotated components, plus the product of the
residual lengths as their bound, rule out candidates, and what is left is scored exactly on the
unrotated integers. A last step merges the stripes' results, k rows a stripe and query at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.order import numbered
from .common import Scratch, map_batches

STRIPE = 4096  # candidates of a task
BLOCK = 4096  # queries of a task
STEP = 256  # candidates between two looks at the bounds
ROTATED = 1024  # vectors with more components are searched unrotated: the matrix has the square of that
KINDS = 8  # so many vector lengths, the commonest, get a rotation


def quantised(vector: Column, scale: int = 256) -> Column:
    """Whole numbers floor(scale * x), x as double; null where a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For the commonest vector lengths, the right singular vectors of all vectors of that length.

    Each partition sums outer products; what reaches the driver is one matrix a length, in Arrow columns.
    """
    sizes = vectors.groupBy("dim").count().filter(f"dim between 2 and {ROTATED}").orderBy(F.desc("count"), "dim").limit(KINDS)
    kept = sorted(r["dim"] for r in sizes.collect())

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, rows in _matrices(batch):
                if dim in kept:
                    sums[dim] = sums.get(dim, 0) + rows.T @ rows
        for dim, m in sums.items():
            at = np.indices(m.shape).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, dim, np.int32)), *(pa.array(x.astype(np.int32)) for x in at), pa.array(m.ravel())], names=["dim", "i", "j", "s"])

    parts = map_batches(vectors.select("dim", "v"), partial, "dim int, i int, j int, s double")
    out = {dim: np.zeros((dim, dim)) for dim in kept}
    sums = parts.groupBy("dim", "i", "j").agg(F.sum("s").alias("s")).toArrow() if kept else pa.table({c: [] for c in ("dim", "i", "j", "s")})
    of_dim, i, j, s = (sums.column(c).to_numpy() for c in ("dim", "i", "j", "s"))
    for dim in kept:
        own = of_dim == dim
        out[dim][i[own], j[own]] = s[own]
    return {dim: np.linalg.eigh(m)[1][:, ::-1] for dim, m in out.items()}


def _matrices(batch: pa.RecordBatch):
    """(dim, float64 matrix) of a batch's vectors."""
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    for dim in np.unique(dims).tolist():
        own = batch.filter(pa.array(dims == dim))
        yield dim, own.column("v").flatten().to_numpy(zero_copy_only=False).reshape(own.num_rows, dim).astype(np.float64)


def search(q_ids, q, c_ids, c, basis, k: int, floor=None):
    """Exact best k of the candidates ``c`` for each query: rows (query, candidate, score).

    Scores below a query's ``floor`` may be left out.
    """
    exact = np.float64 if np.abs(q).max(initial=0).astype(float) * np.abs(c).max(initial=0).astype(float) * q.shape[1] < 2**53 else object
    lengths = np.sqrt(np.square(c.astype(np.float64)).sum(1))
    order = np.lexsort((c_ids, -lengths))
    c, c_ids, lengths = c[order], c_ids[order], lengths[order]
    rq, rc = q.astype(np.float64), c.astype(np.float64)
    if basis is not None:
        rq, rc = rq @ basis, rc @ basis
    head = max(1, q.shape[1] // 4)
    q_len = np.sqrt(np.square(rq).sum(1))
    q_rest, c_rest = (np.sqrt(np.square(x[:, head:]).sum(1)) for x in (rq, rc))
    slack = 1e-9 * (q_len * lengths.max(initial=0) + 1)  # more than rounding can take from a bound
    best: list[list[tuple]] = [[] for _ in q_ids]
    floor = np.full(len(q_ids), -np.inf) if floor is None else floor.astype(float)
    exact_q, exact_c = (q.astype(exact), c.astype(exact))
    for at in range(0, len(c), STEP):
        active = np.flatnonzero(q_len * lengths[at] + slack >= floor)
        if not len(active):
            break
        part = slice(at, at + STEP)
        bound = rq[active, :head] @ rc[part, :head].T + np.outer(q_rest[active], c_rest[part]) + slack[active, None]
        rows, cols = np.nonzero(bound >= floor[active, None])
        if not len(rows):
            continue
        if len(rows) > len(active) * len(c[part]) // 4:
            scores = (exact_q[active] @ exact_c[part].T)[rows, cols]
        else:
            scores = (exact_q[active[rows]] * exact_c[part][cols]).sum(1)
        hit = np.array([s >= f for s, f in zip(scores, floor[active[rows]])]) if exact is object else scores >= floor[active[rows]]
        who, cols, scores = active[rows[hit]], cols[hit], scores[hit]
        if exact is not object and len(who):  # a block's best k of each query are enough
            near = np.lexsort((c_ids[part][cols], -scores, who))
            who, cols, scores = who[near], cols[near], scores[near]
            first = np.concatenate(([True], who[1:] != who[:-1]))
            nth = np.arange(len(who)) - np.maximum.accumulate(np.where(first, np.arange(len(who)), 0))
            own = c_ids[part][cols] == q_ids[who]
            keep = nth < k + 1 + np.bincount(who, own, len(q_ids))[who]
            who, cols, scores = who[keep], cols[keep], scores[keep]
        for i, j, s in zip(who.tolist(), cols.tolist(), scores.tolist()):
            if c_ids[at + j] != q_ids[i]:
                best[i].append((-int(s), int(c_ids[at + j])))
        for i in np.unique(who).tolist():
            best[i] = sorted(best[i])[:k]
            if len(best[i]) == k:
                floor[i] = -best[i][-1][0]
    return [(int(q_ids[i]), j, -s) for i, found in enumerate(best) for s, j in found]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "vector") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products over ``vectors``.

    Both frames hold ``key`` (long) and ``vector`` (array of long). Ties go to the smaller id, a
    query never finds its own id, and only vectors of a query's own length are its candidates;
    with fewer than k of them the query gets all.

    Edge cases: rows with a null key, a null vector or a null component take no part; an empty
    vector scores 0 against empty vectors; repeated queries count once (one of them, if their
    vectors differ); repeated candidates count each; empty tables give no rows. Scores are exact
    whole numbers; they must fit 64 bits.
    """

    def clean(df: DataFrame) -> DataFrame:
        own = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<bigint>").alias("v"))
        return own.filter("id is not null and v is not null and not exists(v, x -> x is null)").withColumn("dim", F.size("v"))

    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "topk")
    candidates, asked = clean(vectors), scratch.table(clean(queries).dropDuplicates(["id"]))
    # Repeated rows of one vector have a number of their own, so that they too are cut into stripes.
    longest = ["dim", F.desc("norm"), "id", F.monotonically_increasing_id()]
    cut = candidates.withColumn("norm", _norm()).repartitionByRange(max(1, -(-vectors.count() // STRIPE)), *longest)
    striped = scratch.table(cut.withColumn("stripe", F.spark_partition_id()))
    basis = spark.sparkContext.broadcast(rotations(striped))
    # One row a stripe; by length their longest vectors' norms in falling order, and their numbers.
    tops = striped.groupBy("dim", "stripe").agg(F.max("norm").alias("norm")).orderBy("dim", "stripe").toArrow()
    of_dim, number, norm = (tops.column(c).to_numpy() for c in ("dim", "stripe", "norm"))
    order = {int(d): (number[of_dim == d], norm[of_dim == d]) for d in np.unique(of_dim)}

    blocks = max(1, -(-asked.count() // BLOCK))
    dealt = asked.withColumn("floor", F.lit(float("-inf"))).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    heads = spark.createDataFrame([(d, int(numbers[0])) for d, (numbers, _) in order.items()], "dim int, stripe int")  # one row a length
    to_head = dealt.join(heads, "dim")
    head = scratch.table(_searched(striped, to_head, to_head.select("dim", "block", "stripe").distinct(), basis, k))

    floors = head.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("low")).filter(F.col("n") >= k)
    known = asked.join(floors, asked["id"] == floors["query_id"], "left").select("id", "v", "dim", F.coalesce("low", F.lit(float("-inf"))).alias("floor"))
    reaching = _by_reach(known, {d: norms for d, (_, norms) in order.items()}).withColumn("near", -F.col("reach"))
    # By rank and not by partition, so that there are as many blocks as queries ask for, however Spark deals them.
    ranked = numbered(reaching, ["dim", "near", "id"], "nth")
    reached = scratch.table(ranked.withColumn("block", F.floor(F.col("nth") / BLOCK).cast("int")).drop("near", "nth"))
    later = spark.sparkContext.broadcast({d: numbers for d, (numbers, _) in order.items()})

    def stripes_of(batches):
        for batch in batches:
            rows = batch.to_pydict()
            for d, block, reach in zip(rows["dim"], rows["block"], rows["reach"]):
                numbers = later.value[d][1:reach]
                for at in range(0, len(numbers), STRIPE):
                    part = numbers[at : at + STRIPE]
                    yield pa.RecordBatch.from_pydict({"dim": pa.array([d] * len(part), pa.int32()), "block": pa.array([block] * len(part), pa.int32()), "stripe": pa.array(part, pa.int32())})

    # A block meets the stripes that any of its queries reaches: a row a pair of block and stripe.
    pairs = reached.groupBy("dim", "block").agg(F.max("reach").alias("reach")).mapInArrow(stripes_of, "dim int, block int, stripe int")
    each = reached.filter("reach > 1").mapInArrow(_expanded(later), "id long, v array<bigint>, dim int, floor double, block int, stripe int")
    found = head.unionByName(_searched(striped, each, pairs, basis, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _norm() -> Column:
    return F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _by_reach(queries: DataFrame, norms: dict[int, np.ndarray]) -> DataFrame:
    """``queries`` with ``reach``: how many stripes of their length, the longest first, may hold a score of their floor."""
    shared = queries.sparkSession.sparkContext.broadcast(norms)

    def run(batches):
        for batch in batches:
            dims, length, floor = (batch.column(c).to_numpy() for c in ("dim", "norm", "floor"))
            reach = np.zeros(len(dims), np.int32)
            for d in np.unique(dims).tolist():
                if d in shared.value:
                    own = np.flatnonzero(dims == d)
                    # more than rounding can take from the product of lengths
                    least = (floor[own] - 1) / np.maximum(length[own] * (1 + 1e-9), 1e-300)
                    reach[own] = np.searchsorted(-shared.value[d], -least, "right")
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "v", "dim", "floor")), pa.array(reach)], names=["id", "v", "dim", "floor", "reach"])

    return map_batches(queries.withColumn("norm", _norm()), run, "id long, v array<bigint>, dim int, floor double, reach int")


def _expanded(numbers):
    """A function of batches: each query once for each later stripe that it reaches."""

    def run(batches):
        for batch in batches:
            dims, reach = (batch.column(c).to_numpy() for c in ("dim", "reach"))
            for row in range(batch.num_rows):
                stripes = numbers.value[int(dims[row])][1 : reach[row]]
                for at in range(0, len(stripes), 256):
                    part = stripes[at : at + 256]
                    own = batch.take(pa.array(np.full(len(part), row)))
                    yield pa.RecordBatch.from_arrays([*(own.column(c) for c in ("id", "v", "dim", "floor", "block")), pa.array(part, pa.int32())], names=["id", "v", "dim", "floor", "block", "stripe"])

    return run


def _searched(striped: DataFrame, queries: DataFrame, pairs: DataFrame, basis, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best k of each stripe for the queries that are dealt to it, a task a stripe and block."""
    keys = ("dim", "stripe", "block")

    def run(c: pa.Table, q: pa.Table) -> pa.Table:
        rows = []
        if c.num_rows and q.num_rows:
            dim = c.column("dim")[0].as_py()

            def whole(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
                flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
                return t.column("id").to_numpy(), flat.reshape(t.num_rows, dim)

            q_ids, q_rows = whole(q)
            c_ids, c_rows = whole(c)
            rows = search(q_ids, q_rows, c_ids, c_rows, basis.value.get(dim), k, q.column("floor").to_numpy())
        columns = list(zip(*rows)) if rows else ((), (), ())
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("query_id", "vec_id", "score"), columns)})

    left = striped.join(pairs, ["dim", "stripe"]).select(*(F.col(c).alias(c) for c in (*keys, "id", "v")))  # names apart from those on the right
    right = queries.select(*keys, "id", "v", "floor")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score long")
