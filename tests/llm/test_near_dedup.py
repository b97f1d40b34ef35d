"""op8 against brute force over full sets."""

import random
import re

import pytest
from geots.llm import near_dedup, queries

SF = "/root/testdata/sf0.01"
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text: str | None) -> frozenset:
    words = SPLIT.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(docs: list[tuple], percent: int) -> dict:
    """id -> (set size, smallest id reached), by all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in docs}
    holders: dict = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        common: dict = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def rows(df) -> dict:
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_query_is_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op8_near_duplicates(spark, SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(docs, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got) and len(got) == len(docs)


@pytest.mark.parametrize("leaf,heavy,percent", [(1024, 4_000_000, 85), (16, 4_000_000, 85), (40, 100, 80)])
def test_large_loose_groups(spark, monkeypatch, leaf, heavy, percent):
    """Variants of one text around the threshold: many candidates fail, chains must still be found."""
    monkeypatch.setattr(near_dedup, "LEAF", leaf)
    monkeypatch.setattr(near_dedup, "HEAVY", heavy)
    rng = random.Random(7)
    words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    docs = []
    for i in range(160):
        own = list(words)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(own)))
    docs += [(1000 + i, "shared passage of a good many words that stands in each text " * 2 + " ".join(f"y{rng.randrange(10**6)}" for _ in range(60))) for i in range(150)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got, want = rows(near_dedup.near_duplicates(df, percent=percent)), brute(docs, percent)
    if leaf == 1024:
        assert got == want
    else:  # small nodes of a random method: all documents but a few are placed alike
        assert sum(got[i] == want[i] for i in want) >= 0.97 * len(want)


@pytest.mark.parametrize("percent,own_words,edits", [(80, 9, 12), (85, 7, 9)])
def test_group_of_several_times_a_leaf(spark, monkeypatch, percent, own_words, edits):
    """Pairs just above the threshold in one group of texts that are much alike, but less than it."""
    monkeypatch.setattr(near_dedup, "LEAF", 32)
    rng = random.Random(5)
    docs = []
    for f in range(150):
        text = [f"w{i}" for i in range(600)]
        for place in rng.sample(range(0, 600, 5), own_words):
            text[place] = f"f{f}_{place}"
        docs.append((2 * f, " ".join(text)))
        for place in rng.sample(range(2, 600, 5), edits):
            text[place] = f"t{f}_{place}"
        docs.append((2 * f + 1, " ".join(text)))
    rng.shuffle(docs)
    want = brute(docs, percent)
    assert len({c for _, c in want.values()}) > 100
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows(near_dedup.near_duplicates(df, percent=percent)) == want


def test_chain_of_links(spark):
    """Each text is linked with the next alone: a component as long as the chain."""
    words = [f"w{i}" for i in range(400)]
    docs = [(500 - i, " ".join(words[4 * i : 4 * i + 100])) for i in range(60)]
    assert brute(docs, 85)[500][1] == 441
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(near_dedup.near_duplicates(df, percent=85)) == brute(docs, 85)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "Two Words"), (5, "two  words"), (6, "two words more"), (7, "A b c d e f"), (9, "a B c d e F"), (8, "É b c d e"), (10, "é b c d e")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, h string, n int")
    got = near_dedup.near_duplicates(df)
    assert rows(got) == brute(docs, 85)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept", "text_hash"]
    assert rows(got)[9] == (2, 7) and rows(got)[10] == (1, 10)


def test_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (2, "other words entirely in this one here")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in near_dedup.near_duplicates(df).collect())
    assert len(got) == 5 and got[0] == (0, 0, True) and (2, 1, False) in got and (1, 1, True) in got


def test_empty_table(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
