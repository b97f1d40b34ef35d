"""op4, op5 and op6 against the tokenizers library."""

import hashlib
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from geots.llm import bpe, packing, queries, token_counts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None,
    "",
    " ",
    "\n",
    "a",
    "don't we'll I'M it's '' 's",
    "  two  spaces \t tabs\r\n\r\n  end  ",
    "<|endoftext|>x<|endoftext|> <|endoftext|>",
    "é é ñ ﬁ Ⅷ ² ٣ 漢字かな 한글 🙂👩‍👩‍👧 ‍﻿\x00\x1c\x85 ",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "x" * 30_000,
    "ab " * 20_000,
    "1234567890 3.14159 1,000,000",
    "a <|startoftext|> B</w> <|endoftext|>",
]


def fuzz(n: int) -> list[str]:
    rng = random.Random(5)
    letters = list("abcthe '’\n\t.,<|>0123ÉéßİıΣς漢🙂  ") + ["'s", "'ll", "<|endoftext|>", " the", "ing"]
    return ["".join(rng.choices(letters, k=rng.randrange(1, 60))) for _ in range(n)]


def library(path: str) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def texts(spark):
    own = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    return own + ODD + fuzz(300)


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string").repartition(3)


def test_byte_ids_and_decoding_are_the_librarys(spark, docs, texts):
    lib = library(BYTE)
    ids = [e.ids for e in lib.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = {r["doc_id"]: r for r in bpe.digests(docs, BYTE).collect()}
    assert len(got) == len(texts)
    for i, own in enumerate(ids):
        assert got[i]["n_tokens"] == len(own), texts[i]
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(lib.decode(own, skip_special_tokens=False).encode()).hexdigest()


def test_decoding_ids_that_are_no_utf8(spark):
    lib = library(BYTE)
    rng = random.Random(1)
    rows = [(i, [rng.randrange(50257) for _ in range(rng.randrange(20))]) for i in range(200)]
    ids = spark.createDataFrame([(i, bytearray(np.array(v, "<u4").tobytes())) for i, v in rows], "i int, ids binary")
    got = {r["i"]: r["decoded"] for r in bpe.decode(ids, BYTE).collect()}
    assert got == {i: lib.decode(v, skip_special_tokens=False) for i, v in rows}


def test_counts_are_the_librarys(spark, docs, texts):
    lib = library(BYTE)
    got = {r["doc_id"]: r for r in token_counts.count_tokens(docs, BYTE).collect()}
    for i, t in enumerate(texts):
        assert (got[i]["n_tokens"], got[i]["n_bytes"]) == (len(lib.encode(t or "", add_special_tokens=False).ids), len((t or "").encode())), t
        assert got[i]["over_limit"] == (got[i]["n_tokens"] > 1024)


def test_packed_pieces_are_the_librarys_ids_once_each(spark, docs, texts):
    lib = library(WORD)
    pieces = packing.pack(docs, WORD).collect()
    own: dict = {}
    sequences: dict = {}
    for p in pieces:
        own.setdefault(p["doc_id"], []).append(p)
        sequences.setdefault(p["sequence_id"], []).append(p)
    assert set(own) == set(range(len(texts)))
    for i, t in enumerate(texts):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        at, data = 0, b""
        for p in sorted(own[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            at += p["length"]
            data += bytes(p["ids"])
        assert data == np.array(ids, "<u4").tobytes(), t
    padding = 0
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= packing.WINDOW
        padding += 0 if at & (at - 1) == 0 else packing.WINDOW - at
    assert padding == 0


def test_query_of_pieces_has_checksums(spark):
    rows = queries.op5_packing(spark, SF).collect()
    lib = library(WORD)
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in rows:
        ids = [*lib.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids, 1][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("run", [lambda d: bpe.digests(d, BYTE), lambda d: token_counts.count_tokens(d, BYTE), lambda d: packing.pack(d, WORD)])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_rows_and_null_keys(spark):
    d = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "three"), (None, None)], "doc_id long, text string")
    assert bpe.digests(d, BYTE).count() == token_counts.count_tokens(d, BYTE).count() == 4
    lengths = packing.pack(d, WORD).groupBy("doc_id").sum("length").collect()
    assert {tuple(r) for r in lengths} == {(1, 6), (None, 3)}
    assert len({(r["n_tokens"], r["ids_sha256"]) for r in bpe.digests(d, BYTE).collect()}) == 3


def test_sum_of_squares_rule():
    packer = packing.Packer(10)
    assert packer.place(("a", 0, 6, b"", 6)) is None and packer.levels[6] == 1
    packer.place(("b", 0, 6, b"", 6))
    # A piece of 4 fills one of the two windows at 6: the squares sum to 1.
    assert packer.level_for(4) == 6 and packer.place(("c", 0, 4, b"", 4))
    for size in (3, 5, 2, 7, 1):
        before = packer.levels.copy()
        sums = {}
        for level in [0, *np.flatnonzero(before[: 11 - size])]:
            after = before.copy()
            after[level] -= level > 0
            after[level + size] += level + size < 10
            sums[int(level)] = int((after[1:10] ** 2).sum())
        assert sums[packer.level_for(size)] == min(sums.values())
        packer.place(("x", 0, size, b"", size))


def resident_mb(code: str) -> float:
    """What a fresh worker's resident memory grows by while ``code`` runs on 250,000 distinct words."""
    script = f"""
import resource, sys
sys.path.insert(0, {ROOT!r})
from geots.llm import bpe, packing
words = [f"w{{i * 7919 % 1000003}}" for i in range(250_000)]
texts = [" ".join(words[i : i + 5000]) for i in range(0, len(words), 5000)]
{code}
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True).stdout
    return float(out.split()[-1])


PEAK = "resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024"


def test_memory_of_a_worker_is_bounded_over_a_batch_of_distinct_words():
    packed = f"e = packing.encoder({WORD!r}); b = {PEAK}\nfor t in texts: e.encode(t)\nprint({PEAK} - b)"
    coded = f"e = bpe.vocabulary({BYTE!r}); b = {PEAK}\nfor _ in e.encode_batch(texts): pass\nprint({PEAK} - b)"
    assert resident_mb(packed) < 120
    assert resident_mb(coded) < 160


def test_long_unseen_words_make_no_states_and_count_as_the_librarys():
    rng, byte, counts = random.Random(6), library(BYTE), token_counts.Counter(BYTE)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "abCD", "=-_/<>#*", "\u0430\u0431\u0432\u0433"):
        for n in (token_counts.LONG - 1, token_counts.LONG, token_counts.LONG + 1, 50_000):
            word = "".join(rng.choices(letters, k=n))
            before = len(counts.emits)
            assert counts.count_batch([word]) == [len(byte.encode(word, add_special_tokens=False).ids)]
            assert len(counts.emits) - before <= token_counts.LONG and len(counts.stands) <= token_counts.STANDS


def test_long_texts_and_clashing_columns(spark):
    """Texts longer than a stretch, with and without blanks, and columns named like the operators' own."""
    texts = [f"word{i % 977} é,{i} " * 40_000 for i in range(2)] + ["x" * 300_000 + " y", "a\nb" * 100_000]
    rows = [(i, t, "k", 1, "t") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int, k string").withColumn("t", F.lit("old"))
    word, byte = library(WORD), library(BYTE)
    whole: dict = {}
    for p in packing.pack(df, WORD).orderBy("start").collect():
        whole[p["doc_id"]] = whole.get(p["doc_id"], b"") + bytes(p["ids"])
    assert whole == {i: np.array([*word.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for i, t in enumerate(texts)}
    both = {r["doc_id"]: r for r in bpe.round_trip(df, BYTE).collect()}
    counted = {r["doc_id"]: r for r in token_counts.count_tokens(df, BYTE).collect()}
    for i, t in enumerate(texts):
        ids = byte.encode(t, add_special_tokens=False).ids
        assert bytes(both[i]["ids"]) == np.array(ids, "<u4").tobytes() and both[i]["decoded"] == t
        assert counted[i]["n_tokens"] == len(ids) and counted[i]["ids"] == "k"
    assert {r["ids"] == "k" for r in bpe.encode(df, BYTE).collect()} == {False}
