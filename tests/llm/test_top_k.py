"""op1 against brute force."""

import math

import numpy as np
import pytest
from geots.llm import topk
from pyspark.sql import functions as F


def brute(vectors: list[tuple], queries: list[tuple], k: int) -> set[tuple]:
    out = set()
    for q, v in dict((i, v) for i, v in queries if i is not None and v is not None and None not in v).items():
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i is not None and w is not None and None not in w and len(w) == len(v) and i != q)
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(found[:k], 1)}
    return out


def rows(df) -> set[tuple]:
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("seed,dim,spread", [(1, 8, 300), (2, 33, 5), (3, 2, 2)])
def test_all_scores_and_ties(spark, seed, dim, spread):
    rng = np.random.default_rng(seed)
    scale = rng.lognormal(0, 1, 700)[:, None]
    table = [(i, [int(x) for x in v]) for i, v in enumerate((rng.normal(0, spread, (700, dim)) * scale).round())]
    df = spark.createDataFrame(table, "vec_id long, vector array<long>").repartition(3)
    asked = [t for t in table if t[0] % 7 == 0]
    got = rows(topk.top_k(df, df.filter("vec_id % 7 = 0"), k=5))
    assert got == brute(table, asked, 5)


def test_several_stripes_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "STRIPE", 50)
    monkeypatch.setattr(topk, "BLOCK", 20)
    rng = np.random.default_rng(4)
    table = [(i, [int(x) for x in v]) for i, v in enumerate(rng.integers(-50, 50, (300, 12)))]
    df = spark.createDataFrame(table, "vec_id long, vector array<long>")
    assert rows(topk.top_k(df, df.filter("vec_id % 3 = 0"), k=4)) == brute(table, [t for t in table if t[0] % 3 == 0], 4)


def test_nulls_other_lengths_repeats_and_extra_columns(spark):
    table = [(1, [1, 2]), (1, [1, 2]), (2, [3, 4]), (3, [1, 1, 1]), (4, None), (5, [1, None]), (None, [1, 1]), (6, []), (7, [0, 0]), (8, [])]
    df = spark.createDataFrame([(*t, 0.5, "q") for t in table], "vec_id long, vector array<long>, score double, query_id string")
    got = sorted(tuple(r) for r in topk.top_k(df, df, k=3).collect())
    assert [g[:4] for g in got if g[0] == 2] == [(2, 1, 1, 11), (2, 2, 1, 11), (2, 3, 7, 0)]
    assert [g[:4] for g in got if g[0] == 6] == [(6, 1, 8, 0)]
    assert not [g for g in got if g[0] in (3, 4, 5, None)]


def test_large_numbers_stay_exact(spark):
    big = 2**30
    table = [(0, [big, 1]), (1, [big, 1]), (2, [big, 2]), (3, [big - 1, 0])]
    df = spark.createDataFrame(table, "vec_id long, vector array<long>")
    assert rows(topk.top_k(df, df.filter("vec_id = 0"), k=3)) == brute(table, table[:1], 3)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, vector array<long>")
    one = spark.createDataFrame([(1, [1])], "vec_id long, vector array<long>")
    assert topk.top_k(none, none).count() == topk.top_k(one, none).count() == topk.top_k(none, one).count() == 0


def test_quantised(spark):
    vectors = [[0.5, -0.001], [1.0, None], [float("nan")], [math.inf, 0.0], None, []]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "i int, v array<float>")
    got = {r["i"]: r["q"] for r in df.select("i", topk.quantised(F.col("v")).alias("q")).collect()}
    assert got == {0: [128, -1], 1: None, 2: None, 3: None, 4: None, 5: []}


def test_stripes_out_of_reach_are_not_searched(spark):
    norms = {2: np.array([100.0, 50.0, 10.0, 1.0]), 3: np.array([7.0])}
    asked = [(1, [3, 4], 2, 600.0), (2, [3, 4], 2, 250.0), (3, [3, 4], 2, 5.0), (4, [3, 4], 2, -math.inf), (5, [0, 0], 2, 0.0), (6, [0, 0, 1], 3, 7.0), (7, [1], 1, -math.inf)]
    df = spark.createDataFrame(asked, "id long, v array<long>, dim int, floor double")
    got = {r["id"]: r["reach"] for r in topk._by_reach(df, norms).collect()}
    assert got == {1: 0, 2: 2, 3: 4, 4: 4, 5: 4, 6: 1, 7: 0}


@pytest.mark.parametrize("spread", [0.0, 2.5])
def test_many_stripes_with_and_without_pruning(spark, monkeypatch, spread):
    """A third of all rows repeat one vector; lengths are alike, or differ so much that few stripes are reached."""
    monkeypatch.setattr(topk, "STRIPE", 40)
    monkeypatch.setattr(topk, "BLOCK", 30)
    rng = np.random.default_rng(9)
    vectors = rng.normal(0, 20, (400, 9)) * np.sort(rng.lognormal(0, spread, 400))[:, None]
    table = [(i, [int(x) for x in v]) for i, v in enumerate(vectors.round())]
    table += [(7, table[7][1])] * 200
    df = spark.createDataFrame(table, "vec_id long, vector array<long>").repartition(5)
    got = rows(topk.top_k(df, df.filter("vec_id % 4 = 3"), k=5))
    assert got == brute(table, [t for t in table if t[0] % 4 == 3], 5)
