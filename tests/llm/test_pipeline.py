"""The pipeline: each stage on its own input, against brute force."""

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from geots.llm.common import table

from test_lines import brute as cut_lines
from test_near_dedup import brute as groups
from test_secrets import brute as secrets

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What went into each stage and what came out, as lists of rows."""
    root = tmp_path_factory.mktemp("stages")
    docs, out = table(spark, SF, "documents"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, SF)
        result.write.parquet(f"{root}/{k}")
        after = spark.read.parquet(f"{root}/{k}")
        out.append((name, docs.collect(), after.collect(), result.columns))
        docs = after
    return out


def test_order_and_columns(stages):
    assert [s[0] for s in stages] == ["toxicity", "line_dedup", "near_dedup", "secrets", "packing"]
    assert all(s[3] == COLUMNS for s in stages[:-1])
    assert all(r["n_chars"] == len(r["text"]) for s in stages[1:-1] for r in s[2] if r["text"] is not None)


def test_toxic_documents_go_and_clean_ones_stay(spark):
    folder = SF
    label = {r["doc_id"]: r["toxic"] for r in table(spark, folder, "labels").collect()}
    docs = table(spark, folder, "documents")
    before = {r["doc_id"] for r in docs.select("doc_id").collect()}
    after = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, folder).select("doc_id").collect()}
    gone = before - after
    assert after <= before and gone
    assert sum(label.get(i) == 0 for i in gone) <= 0.02 * sum(v == 0 for v in label.values())
    assert sum(label.get(i) == 1 for i in after) <= 0.1 * sum(v == 1 for v in label.values())


def test_lines(stages):
    _, before, after, _ = stages[1]
    want = {i: t for i, (t, n) in cut_lines([(r["doc_id"], r["text"]) for r in before]).items() if not n or t.strip()}
    assert {r["doc_id"]: r["text"] for r in after} == want


def test_one_document_of_each_group(stages):
    _, before, after, _ = stages[2]
    placed = groups([(r["doc_id"], r["text"]) for r in before], 80)
    assert {r["doc_id"] for r in after} == {i for i, (_, root) in placed.items() if i == root}


def test_secrets_are_marked(stages):
    _, before, after, _ = stages[3]
    text = {r["doc_id"]: r["text"] for r in before}
    for r in after:
        out, at = [], 0
        for a, _, b, _ in secrets(text[r["doc_id"]]):
            if a >= at:
                out += [text[r["doc_id"]][at:a], "[secret]"]
            at = max(at, b)
        assert r["text"] == ("".join(out) + text[r["doc_id"]][at:] if text[r["doc_id"]] is not None else None)
    assert len(after) == len(before)


def test_every_document_is_packed(stages):
    _, before, after, _ = stages[4]
    tokens: dict = {}
    for r in after:
        tokens.setdefault(r["doc_id"], []).append(r)
    assert set(tokens) == {r["doc_id"] for r in before}
    assert all(sum(p["length"] for p in ps) == ps[0]["doc_tokens"] for ps in tokens.values())


def test_end_to_end_against_brute_force(spark, stages):
    """From what toxicity kept to the last piece, with plain Python and the tokenizers library."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    _, before, after, _ = stages[0]
    assert len(after) < len(before)
    texts = {i: t for i, (t, n) in cut_lines([(r["doc_id"], r["text"]) for r in after]).items() if not n or t.strip()}
    placed = groups(list(texts.items()), 80)
    want = {}
    for i in (i for i, (_, root) in placed.items() if i == root):
        text, out, at = texts[i] or "", [], 0
        for a, _, b, _ in secrets(text):
            if a >= at:
                out += [text[at:a], "[secret]"]
            at = max(at, b)
        want[i] = [*library.encode("".join(out) + text[at:], add_special_tokens=False).ids, 1]
    pieces: dict = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(want)
    for i, ids in want.items():
        at = 0
        for p in sorted(pieces[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[p["start"] : at], "<u4").tobytes())
        assert at == len(ids)


def test_a_repeated_key_loses_only_the_text_that_is_a_copy(spark):
    a, b = "one text of seven words for this", "another text that nothing else is like here"
    docs = spark.createDataFrame([(1, a), (2, a), (2, b)], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) AS long) AS n_chars")
    assert {(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()} == {(1, a), (2, b)}


def test_empty_table_passes_all_stages(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_odd_documents_pass_all_stages(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "a", 0), (None, "some text", "en", "a", 9), (3, "some text", "en", "a", 9), (3, "some text", "en", "a", 9), (4, "long " * 50_000, "en", "a", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert {r["doc_id"] for r in docs.collect()} >= {1, 2, None, 3, 4}
