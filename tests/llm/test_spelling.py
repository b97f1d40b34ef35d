"""op11 against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from geots.llm import queries, spelling
from hypothesis import given, settings
from hypothesis import strategies as st

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(docs: list[tuple], noise: int = 97) -> dict:
    n: Counter = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 3}


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(n: dict) -> set:
    """Words that share what is left of them without one code point are compared."""
    holders: dict = {}
    for w in n:
        for x in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            holders.setdefault(x, []).append(w)
    around: dict = {w: set() for w in n}
    for group in holders.values():
        for a in group:
            around[a].update(b for b in group if b not in around[a] and near(a, b))
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(around[w]), n[form[w]] if form[w] else None))
    return out


def rows(df) -> set:
    found = [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]
    assert len(set(found)) == len(found)
    return set(found)


def test_query_is_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(queries.op11_spelling_variants(spark, SF))
    assert got == brute(counted(docs)) and any(r[1] for r in got)


@pytest.mark.parametrize("bucket,chunk", [(4096, 1 << 20), (3, 40), (1, 1)])
def test_crowded_words(spark, monkeypatch, bucket, chunk):
    """Words over three letters: all buckets are too large, down to single positions; long runs of one letter."""
    monkeypatch.setattr(spelling, "BUCKET", bucket)
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    rng = random.Random(3)
    n = {"".join(rng.choice("abé") for _ in range(rng.randrange(5, 9))): rng.randrange(3, 60) for _ in range(900)}
    n |= {"a" * k: 10 * k for k in range(5, 12)}
    assert rows(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"))) == brute(n)


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abÿ", min_size=5, max_size=6), min_size=1, max_size=40))
def test_pairs_once(words):
    """Every near pair in one position of the whole range, in both directions for words of equal length."""
    for m in (5, 6):
        own = sorted(w for w in words if len(w) in (m, m + 1))
        if own:
            got = [(own[a], own[b]) for i, j in spelling.near_pairs(own, [0] * len(own), m, 0, m + 1) for a, b in zip(i.tolist(), j.tolist())]
            want = {(a, b) for a in own for b in own if len(a) == m and near(a, b)}
            assert len(got) == len(set(got)) and set(got) == want


def test_wavelet_reports_what_stands_in_the_rectangle():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 64, 100):
        values = rng.permutation(size)
        tree = spelling.Wavelet(values)
        box = np.sort(rng.integers(0, size + 1, (50, 2, 2)), 2)
        i, v = tree.report(box[:, 0, 0], box[:, 0, 1], box[:, 1, 0], box[:, 1, 1])
        want = {(q, int(x)) for q, ((a, b), (c, d)) in enumerate(box.tolist()) for x in values[a:b] if c <= x < d}
        assert len(i) == len(want) and set(zip(i.tolist(), v.tolist())) == want


def test_chain_of_forms_and_ties(spark):
    n = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "ccccc": 5, "ccccd": 10, "cccce": 10, "ddddd": 7, "dddde": 13}
    got = {r[0]: r for r in rows(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")))}
    assert got["aaaaa"][1:3] == ("aaaab", "abbbb") and got["ccccc"][1] == "ccccd" and got["ddddd"][1] is None and got["ddddd"][4] == 1
    assert set(got.values()) == brute(n)


def test_texts_long_null_and_cut_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 5)
    rng = random.Random(2)
    words = ["Größe", "GRÖßE", "größer", "grösse", "x" * 20_000, "x" * 19_999, "naïve", "naive", "short", "four"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(300))) for i in range(20)] + [(50, None), (51, ""), (None, "Größe größe naive naive"), (52, "1, 2; --"), (52, "naive")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n int").repartition(3)
    assert rows(spelling.spelling_variants(df)) == brute(counted(docs))
    for stretch in (1, 7, 64):
        monkeypatch.setattr(spelling, "STRETCH", stretch)
        assert spelling.runs("abc défg-ABC " * 20 + "tail") == Counter({"abc": 40, "défg": 20, "tail": 1})


def test_odd_rows_of_words(spark):
    df = spark.createDataFrame([(None, 5), ("abcde", None), ("abcde", 2), ("abcde", 3), ("abcdf", 50), ("abcd", 9), ("", 4)], "word string, n long")
    got = {r[0]: r[1:] for r in rows(spelling.variants(df))}
    assert got == {"abcde": ("abcdf", "abcdf", 5, 1, 50), "abcdf": (None, "abcdf", 50, 1, None), "abcd": (None, "abcd", 9, 0, None), "": (None, "", 4, 0, None)}


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
