"""op13: held-out accuracy, and the bundles against a plain version."""

import zlib

import numpy as np
import pytest
from geots.llm import language, queries

SF = "/root/testdata/sf0.01"


def plain(text: str) -> np.ndarray:
    """The bundle of a text, n-gram by n-gram."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    letters = [0, *(x for w in words for x in (*map(ord, w), 0))]
    total = np.zeros(language.DIM)
    for k in range(len(letters) - 2):
        bound = np.ones(language.DIM)
        for place, code in enumerate(letters[k : k + 3]):
            bound = bound * np.roll(language.letter_vector(code), 2 - place)
        total += bound
    return total / np.linalg.norm(total)


@pytest.mark.parametrize("text", ["a", "One two, one TWO!", "Übung macht den Meister. " * 40, "x1y2z3", "日本語 text"])
def test_bundle_is_the_sum_of_bound_letters(monkeypatch, text):
    want = plain(text)
    for stretch, grams in ((1 << 20, 8192), (1 << 20, 4)):
        monkeypatch.setattr(language, "STRETCH", stretch)
        monkeypatch.setattr(language, "GRAMS", grams)
        got = list(language.Encoder().bundles([text, None, text]))
        assert got[1] is None and np.allclose(got[0], want, atol=1e-5) and np.allclose(got[2], want, atol=1e-5)


def test_letters_are_random_and_permutation_tells_order():
    a, b = language.letter_vector(97), language.letter_vector(98)
    assert set(np.unique(a)) == {-1, 1} and abs(int(a.astype(int) @ b)) < 5 * language.DIM**0.5
    ab, ba = (next(language.Encoder().bundles([t])) for t in ("abab", "baba"))
    assert not np.allclose(ab, ba)


def test_query(spark):
    rows = {r["doc_id"]: r for r in queries.op13_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    assert set(rows) == {r["doc_id"] for r in docs}
    assert all(rows[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in docs)
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    held = [r for r in docs if rows[r["doc_id"]]["held_out"] and r["lang"] is not None]
    assert len(held) > 150 and sum(rows[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)


def test_query_against_a_plain_version(spark, tmp_path):
    """Fit and cosine once more in plain NumPy, on a table with rows of every kind."""
    en, de = "the cat sat on the mat and looked at {}", "der Hund und die Katze schlafen auf {}"
    rows = [(i, (en if i % 3 else de).format("abcdefgh"[i % 8] * 5 + f" {i}"), "en" if i % 3 else "de") for i in range(120)]
    rows += [(900, None, "en"), (901, "", "en"), (902, "12 34 !", "fr"), (903, "the mat", None), (None, "die Katze", "de"), (7, rows[7][1], "en"), (904, "z" * 3_000_000, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((str(r["doc_id"]), r["held_out"], r["lang_pred"], r["score"]) for r in queries.op13_language_id(spark, str(tmp_path)).collect())
    learnt = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2 and r[1] and r[2] and any(c.isalpha() for c in r[1])]
    names = sorted({r[2] for r in learnt})
    assert names == ["de", "en"]
    prototypes = language._unit(np.array([sum(plain(t) for _, t, l in learnt if l == x) for x in names]))
    mean = prototypes.mean(0)
    prototypes = language._unit(prototypes - mean)
    want = []
    for i, t, _ in rows:
        held = i is not None and zlib.crc32(str(i).encode()) % 4 == 2
        if not t or not any(c.isalpha() for c in t):
            want.append((str(i), held, "und", 0.0))
            continue
        own = plain(t if len(t) < 10**6 else "z" * 1000)
        cosines = prototypes @ language._unit(own - mean)
        want.append((str(i), held, names[int(cosines.argmax())], max(0.0, cosines.max())))
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want)):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-2 if a[0] == "904" else 1e-4)


def test_sample_and_languages_are_bounded(spark):
    rows = [(i, f"word{'abcdefghij'[i % 10]} text", "a" if i < 400 else "b" if i < 450 else "c") for i in range(460)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.fit(df, sample=50, languages=2).languages == ("a", "b")


def test_nothing_learnt_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "some text", None, 5, "x")], "doc_id long, text string, lang string, score int, lang_pred string")
    profiles = language.fit(df)
    assert profiles.languages == ()
    got = language.predict(df, profiles)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"] and tuple(got.first())[3:] == ("und", 0.0)
    one = spark.createDataFrame([(1, "some text", "en")], "doc_id long, text string, lang string")
    assert language.predict(one, language.fit(one)).first()["lang_pred"] == "en"


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.predict(df, language.fit(df)).count() == 0
