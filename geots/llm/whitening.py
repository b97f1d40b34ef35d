"""Whitening of integer vectors from an exact scatter matrix.

Each distinct vector is fitted once. Tasks subtract a shift from their vectors and add up sums and
cross-products in whole numbers of any size: vectors are split into limbs of so few bits that a
product of matrices of limbs is exact in floating point, and the limbs' products are put together
as Python integers. From all n vectors' sums S and cross-products C the driver forms n*C - S*S',
which no shift changes, and only then divides (by n squared), so that no digit is lost before the
eigenvectors are taken. What reaches the driver has the square of a vector's length, whatever n is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_batches

COMPONENTS = 4
LIMB = 20  # bits
ROWS = 1 << (53 - 2 * LIMB)  # of a product of limbs: its sums stay below 2**53 and are exact
WHITENED = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double"


@dataclass(frozen=True)
class Whitening:
    """Number of fitted vectors, their sums, and the leading components with their variances."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray  # one column a component
    variances: np.ndarray
    explained: np.ndarray


def shifted(x: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """``x - shift``, in Python integers where 64 bits may not hold it."""
    top = max((abs(int(v)) for m in (x, shift) for v in (m.min(initial=0), m.max(initial=0))), default=0)
    return x - shift if top < 1 << 62 else x.astype(object) - shift.astype(object)


def scatter(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products of the rows of an integer matrix, as Python integers."""
    sums, cross = np.zeros(y.shape[1], object), np.zeros((y.shape[1],) * 2, object)
    for at in range(0, len(y), ROWS):
        part = y[at : at + ROWS]
        sign, size = np.where(part < 0, -1, 1), abs(part)
        limbs = []
        for k in range(0, max(1, int(size.max(initial=0)).bit_length()), LIMB):
            limbs.append((sign * ((size >> k) & ((1 << LIMB) - 1))).astype(np.float64))
        for i, a in enumerate(limbs):
            sums += a.sum(0).astype(np.int64).astype(object) << (LIMB * i)
            for j, b in enumerate(limbs):
                cross += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return sums, cross


def _packed(values: list[int]) -> tuple[int, bytes]:
    """Integers in as many bytes each as the largest needs."""
    width = max(v.bit_length() for v in values) // 8 + 1
    return width, b"".join(v.to_bytes(width, "little", signed=True) for v in values)


def _unpacked(width: int, data: bytes) -> np.ndarray:
    return np.array([int.from_bytes(data[i : i + width], "little", signed=True) for i in range(0, len(data), width)], object)


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, dim)


_SCATTER = ["i", "n", "width", "data"]


def _partial(shift: np.ndarray):
    """A task's number of vectors with, for each component i, its sum and its row of cross-products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, np.zeros(len(shift), object), np.zeros((len(shift),) * 2, object)
        for batch in batches:
            if batch.num_rows:
                more = scatter(shifted(_matrix(batch, len(shift)), shift))
                n, sums, cross = n + batch.num_rows, sums + more[0], cross + more[1]
        if n:
            rows = [(i, n, *_packed([sums[i], *cross[i]])) for i in range(len(shift))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=_SCATTER)

    return run


def _added(part: pa.Table) -> pa.Table:
    """One component's row over all tasks."""
    whole = sum(_unpacked(w.as_py(), d.as_py()) for w, d in zip(part.column("width"), part.column("data")))
    width, data = _packed(list(whole))
    return pa.table({"i": [part.column("i")[0].as_py()], "n": [sum(part.column("n").to_pylist())], "width": [width], "data": [data]})


def covariance(n: int, sums: np.ndarray, cross: np.ndarray) -> np.ndarray:
    """(n*cross - sums*sums') / n**2, each entry rounded once."""
    exact = n * cross - np.outer(sums, sums)
    return np.array([[v / (n * n) for v in row] for row in exact.tolist()], float).reshape(exact.shape)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct ``vectors`` (v, arrays of long of one length, none null); None without any."""
    first = vectors.select("v").first()
    if first is None:
        return None
    shift = np.array(first["v"], np.int64)
    parts = map_batches(vectors.select("v"), _partial(shift), "i long, n long, width long, data binary")
    # A row a component, each as long as a vector.
    rows = sorted(parts.groupBy("i").applyInArrow(_added, "i long, n long, width long, data binary").collect(), key=lambda r: r["i"])
    if not rows:  # vectors without components
        return Whitening(0, (), np.empty((0, 0)), np.empty(0), np.empty(0))
    n, table = rows[0]["n"], np.array([_unpacked(r["width"], bytes(r["data"])) for r in rows], object)
    sums, cross = table[:, 0], table[:, 1:]
    found = covariance(n, sums, cross)
    variances, axes = np.linalg.eigh(found)
    order = np.argsort(-variances, kind="stable")[:components]
    axes = axes[:, order]
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(len(order))] < 0, -1.0, 1.0)
    trace = float(np.trace(found))
    # What is no larger than the rounding of the largest variance is no direction of the data.
    noise = len(found) * np.finfo(float).eps * max(variances.max(), 0.0)
    variances = np.where(variances[order] > noise, variances[order], 0.0)
    explained = variances / trace if trace > 0 else np.zeros(len(order))
    return Whitening(n, tuple(int(s) + n * int(c) for s, c in zip(sums, shift)), axes, variances, explained)


def centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n*x - S, exact."""
    top = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) * model.n + max(map(abs, model.sums), default=0)
    kind = np.int64 if top < 1 << 62 else object
    return model.n * x.astype(kind) - np.array(model.sums, kind)


def _whitened(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` on the components, and their exact squared deviations; NaN on a component without variance."""
    y = centred(x, model)
    bound = max(abs(int(y.min(initial=0))), abs(int(y.max(initial=0)))) ** 2 * x.shape[1]
    deviation = np.square(y if bound < 1 << 63 else y.astype(object)).sum(1)
    scale = np.sqrt(np.where(model.variances > 0, model.variances, np.nan))
    return (y.astype(np.float64) / model.n) @ model.axes / scale, deviation


def _moments(model: Whitening, dim: int):
    """A task's sums of products of whitened columns i and j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(model.variances),) * 2)
        for batch in batches:
            if batch.num_rows:
                w = _whitened(_matrix(batch, dim), model)[0]
                total = total + w.T @ w
        at = np.indices(total.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(total.ravel())], names=["i", "j", "s"])

    return run


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the fitted vectors' whitened covariance minus the identity."""
    kept = model.variances > 0
    if not kept.any():
        return 0.0
    parts = map_batches(vectors.select("v"), _moments(model, len(model.sums)), "i int, j int, s double")
    entries = parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()  # one row a pair of components
    return max(abs(r["s"] / model.n - (r["i"] == r["j"])) for r in entries if kept[r["i"]] and kept[r["j"]])


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "vector", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every row and leading component.

    ``vector`` is an array of long. Components are numbered from 1 by falling variance of the
    distinct vectors; a vector's length gives at most as many. ``deviation`` is the exact sum of
    squares of n*x - S, ``explained`` a component's share of the total variance and
    ``identity_error`` one value for all rows, over the components that have variance.

    Edge cases: rows with a null vector or a null entry take no part; the vectors' length is the
    one that most distinct vectors have (of equals the largest), and rows of other lengths take no
    part; repeated rows each come out, their vector is fitted once; a null key stays null; on a
    component without variance (one distinct vector, fewer directions than components)
    ``whitened`` is null and ``explained`` 0; a deviation of more than 38 digits is null; an empty
    table, and vectors without entries, give no rows. Other columns are not read.
    """
    scratch = Scratch(rows.sparkSession, "whiten")
    own = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<bigint>").alias("v"))
    own = own.filter("v is not null and not exists(v, x -> x is null)")
    distinct = scratch.table(own.select("v").distinct())
    commonest = distinct.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = commonest["dim"] if commonest else 0
    fitted = distinct.filter(F.size("v") == dim)
    model = fit(fitted, components) if dim else None
    error = identity_error(fitted, model) if model else 0.0
    scratch.drop(distinct)
    if model is None:
        return rows.sparkSession.createDataFrame([], WHITENED + ", identity_error double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.variances)
        for batch in batches:
            w, deviation = _whitened(_matrix(batch, dim), model)
            if deviation.dtype == object:
                exact = pa.array([Decimal(int(d)) if d < 10**38 else None for d in deviation for _ in range(k)], pa.decimal128(38, 0))
            else:
                exact = pa.array(np.repeat(deviation, k), pa.int64()).cast(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(batch.num_rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(k * batch.num_rows, model.n)),
                    exact,
                    pa.array(w.ravel(), from_pandas=True),
                    pa.array(np.tile(model.explained, batch.num_rows)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained"],
            )

    out = map_batches(own.filter(F.size("v") == dim), run, WHITENED)
    return out.withColumn("identity_error", F.lit(error))
