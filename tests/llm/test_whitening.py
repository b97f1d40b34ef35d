"""op12 against exact fractions."""

from fractions import Fraction

import numpy as np
import pytest
from geots.llm import queries, whitening

SF = "/root/testdata/sf0.01"


def brute(rows: list[tuple], components: int = 4) -> tuple[dict, np.ndarray, int]:
    """{(row, component): (deviation, |whitened|, explained)}, with the covariance from fractions."""
    fitted = sorted({tuple(v) for _, v in rows})
    n, d = len(fitted), len(fitted[0])
    sums = [sum(v[i] for v in fitted) for i in range(d)]
    mean = [Fraction(s, n) for s in sums]
    cov = np.array([[float(sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in fitted) / n) for j in range(d)] for i in range(d)])
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    out = {}
    for at, (_, v) in enumerate(rows):
        deviation = sum((n * x - s) ** 2 for x, s in zip(v, sums))
        centred = np.array([float(x - m) for x, m in zip(v, mean)])
        for c in range(min(components, d)):
            out[at, c + 1] = (deviation, abs(float(centred @ q[:, c]) / e[c] ** 0.5) if e[c] > 0 else None, e[c] / np.trace(cov))
    return out, cov, n


def quantised(v) -> list | None:
    if v is None or any(x is None or not np.isfinite(x) for x in v):
        return None
    return [int(np.floor(256 * float(x))) for x in v]


def check(got: list, rows: list[tuple], rtol: float = 1e-9) -> None:
    want, _, n = brute(rows)
    place = {i: at for at, (i, _) in enumerate(rows)}
    assert len(got) == len(want)
    for r in got:
        deviation, whitened, explained = want[place[r["vec_id"]], r["component"]]
        assert r["deviation"] == (deviation if deviation < 10**38 else None) and r["n"] == n
        assert abs(r["whitened"]) == pytest.approx(whitened, rel=rtol, abs=1e-7)
        assert r["explained"] == pytest.approx(explained, rel=1e-7)
        assert r["identity_error"] <= 1e-4
    assert len({r["identity_error"] for r in got}) == 1


def test_query_is_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [(r[0], q) for r in table if (q := quantised(r[1])) is not None]
    got = queries.op12_whitening(spark, SF).collect()
    fitted = np.array(sorted({tuple(v) for _, v in rows}), float)
    cov = np.cov(fitted.T, bias=True)
    e = np.linalg.eigvalsh(cov)[::-1]
    n, sums = len(fitted), [int(s) for s in fitted.sum(0)]
    vector = dict(rows)
    assert len(got) == 4 * len(rows)
    by_component: dict = {}
    for r in got:
        assert r["n"] == n and r["deviation"] == sum((n * x - s) ** 2 for x, s in zip(vector[r["vec_id"]], sums))
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / np.trace(cov), rel=1e-9) and r["identity_error"] < 1e-9
        by_component.setdefault(r["component"], {})[r["vec_id"]] = r["whitened"]
    ids = [i for i, _ in rows]
    white = np.array([[by_component[c][i] for c in (1, 2, 3, 4)] for i in ids])
    axes = np.linalg.lstsq(np.array([vector[i] for i in ids], float) - fitted.mean(0), white * np.sqrt(e[:4]), rcond=None)[0]
    assert np.allclose(axes.T @ axes, np.eye(4), atol=1e-8) and np.allclose(cov @ axes, axes * e[:4], atol=1e-6 * e[0])


@pytest.mark.parametrize("scale", [1, 1 << 19, 1 << 21, 1 << 40, 1 << 61])
def test_any_size_of_number(spark, scale):
    """Far from the origin and of many limbs: sums of squares beyond 64 bits, differences beyond them too."""
    rng = np.random.default_rng(scale % 97)
    base = [int(x) for x in rng.integers(-scale, scale, 5)]
    rows = [(i, [b + int(x) * max(1, scale // 64) for b, x in zip(base, rng.integers(-64, 64, 5))]) for i in range(60)]
    rows += [(100 + i, v) for i, (_, v) in enumerate(rows[:20])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(3)
    check(whitening.whiten(df).collect(), rows)


def test_a_large_mean_takes_no_digit(spark):
    """Variances of one step at a distance of 2**52, where doubles would lose them."""
    rng = np.random.default_rng(0)
    rows = [(i, [(1 << 52) + int(x) for x in rng.integers(0, 3, 3)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    check(whitening.whiten(df).collect(), rows)


def test_scatter_is_exact_over_blocks(monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 7)
    rng = np.random.default_rng(5)
    y = rng.integers(-(1 << 45), 1 << 45, (50, 4))
    sums, cross = whitening.scatter(y)
    exact = y.astype(object)
    assert (sums == exact.sum(0)).all() and (cross == exact.T @ exact).all()


def test_no_shift_changes_the_covariance():
    rng = np.random.default_rng(6)
    x = rng.integers(-500, 500, (30, 3))
    found = [whitening.covariance(30, *whitening.scatter(whitening.shifted(x, np.array(s)))) for s in ([0, 0, 0], [7, -9, 10**12])]
    assert (found[0] == found[1]).all()


def test_edge_cases(spark):
    one = spark.createDataFrame([(1, [3, 4]), (2, [3, 4]), (3, None), (4, [1, None]), (5, [9]), (None, [3, 4])], "vec_id long, vector array<long>")
    got = whitening.whiten(one).collect()  # lengths 2 and 1 have a distinct vector each: the longer is taken
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1), (2, 2)]
    assert all(r["whitened"] is None and r["explained"] == 0 and int(r["deviation"]) == 0 and r["n"] == 1 and r["identity_error"] == 0 for r in got)
    line = spark.createDataFrame([(i, [i, 2 * i, 0]) for i in range(5)], "vec_id long, vector array<long>").withColumn("n", whitening.F.lit("x")).withColumn("component", whitening.F.lit("y"))
    got = whitening.whiten(line).collect()
    assert {r["component"] for r in got if r["whitened"] is not None} == {1} and len(got) == 15
    huge = spark.createDataFrame([(1, [1 << 62]), (2, [-(1 << 62)]), (3, [5])], "vec_id long, vector array<long>")
    assert len(whitening.whiten(huge).filter("deviation is not null").collect()) == 1 and whitening.whiten(huge).count() == 3


def test_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        df = whitening.whiten(spark.createDataFrame(rows, "vec_id long, vector array<long>"))
        assert df.count() == 0 and df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
