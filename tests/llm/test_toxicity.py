"""op2: segments against brute force, accuracy on held-out rows, edge cases."""

import random

from geots.llm import queries, toxicity
from geots.llm.common import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def brute_segments(values: list[float], drift: float) -> list[tuple[int, int, float]]:
    """The definition: the best segment (shortest of equals), then those left and right of it."""
    v = [x if x else -drift for x in values]

    def inside(a: int, b: int) -> list[tuple]:
        best = None
        for i in range(a, b):
            s = 0.0
            for j in range(i, b):
                s += v[j]
                if s > 1e-12 and (best is None or s > best[2] + 1e-9 or abs(s - best[2]) <= 1e-9 and j + 1 - i < best[1] - best[0]):
                    best = (i, j + 1, s)
        return [] if best is None else [*inside(a, best[0]), best, *inside(best[1], b)]

    return inside(0, len(v))


def test_segments_are_all_maximal_ones():
    rng = random.Random(3)
    for _ in range(400):
        values = [rng.choice([0, 0, 0, 1.3, 0.7, 2.9]) for _ in range(rng.randrange(25))]
        got = toxicity.segments(values, 0.611)
        want = brute_segments(values, 0.611)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert all(abs(g[2] - w[2]) < 1e-9 for g, w in zip(got, want))


def test_held_out_documents(spark):
    scored = queries.op2_toxicity(spark, SF)
    assert scored.count() == table(spark, SF, "documents").count()
    rows = scored.join(table(spark, SF, "labels").filter("toxic is not null"), "doc_id").filter("held_out").select("score", "predicted", "toxic").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert right / len(rows) >= 0.95
    bad, good = ([r["score"] for r in rows if r["toxic"] == y] for y in (1, 0))
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert auc >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_passages_are_places_in_the_text(spark):
    rng = random.Random(8)
    words = [f"{a}{b}{c}" for a in "bdkmt" for b in "aeiou" for c in "lnrs"]

    def prose() -> str:
        return " ".join(rng.choices(words, k=30))

    clean = [(i, prose()) for i in range(150)]
    toxic = [(1000 + i, f"{prose()} rotten filthy scoundrel {prose()}") for i in range(150)]
    docs = spark.createDataFrame(clean + toxic + [(9990, None), (9980, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _ in clean + toxic], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score(docs.withColumn("score", F.lit("old")), model).collect()}
    text = dict(toxic)
    for i in text:
        assert got[i]["predicted"] == 1
        assert [text[i][p["start"] : p["end"]] for p in got[i]["passages"]] == ["rotten filthy scoundrel"]
    assert all(got[i]["predicted"] == 0 and not got[i]["passages"] for i, _ in clean)
    assert got[9990]["score"] == got[9980]["score"] < 0.5 and got[9990]["passages"] == []


def test_no_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, "c"), (1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, none)
    assert model.lexicon == {}
    assert len({r["score"] for r in toxicity.score(docs, model).collect()}) == 1
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, toxic int")
    assert toxicity.fit(docs, odd).lexicon == {}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_unlike_texts_that_share_extreme_hashes_are_all_learnt(spark):
    """Texts with one smallest and one largest word hash in common are no copies."""
    import xxhash

    pool = sorted((f"w{i}" for i in range(3000)), key=lambda w: xxhash.xxh3_64_intdigest(w) >> 1)
    low, high, middle = pool[0], pool[-1], pool[1:-1]
    rng = random.Random(4)
    clean = [(i, " ".join([low, *rng.sample(middle, 20), high])) for i in range(100)]
    toxic = [(1000 + i, " ".join([low, *rng.sample(middle, 20), "scoundrel", high])) for i in range(100)]
    docs = spark.createDataFrame(clean + toxic, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _ in clean + toxic], "doc_id long, toxic int")
    assert "=scoundrel" in toxicity.fit(docs, labels).lexicon
