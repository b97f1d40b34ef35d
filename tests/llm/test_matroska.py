"""op7: exact round trips, lacing, unknown sizes, broken files."""

import hashlib
import random
import zlib

import pytest
from geots.llm import matroska as m
from geots.llm import queries

SF = "/root/testdata/sf0.001"


def payload_of(data: bytes) -> bytes:
    return b"".join(data[p[2] : p[2] + p[3]] for p in m.Reader(data).read().packets)


@pytest.mark.parametrize("size", [0, 1, 191, 192, 193, 192 * 8, 192 * 8 * 40, 192 * 8 * 40 + 1, 400_000])
def test_round_trip(size):
    rng = random.Random(size)
    padded = m.pad(rng.randbytes(size))
    assert len(padded) % 192 == 0 and len(padded) > 0
    media = m.Reader(m.write(padded)).read()
    assert payload_of(m.write(padded)) == padded
    assert [p[1] for p in media.packets] == [24_000_000 * k for k in range(len(padded) // 192)]
    assert [c[2] for c in media.cues] == media.clusters


def block(kind: int, packets: list[bytes]) -> bytes:
    head = b"\x81\x00\x05" + bytes([0x80 | kind << 1])
    if not kind:
        return head + packets[0]
    head += bytes([len(packets) - 1])
    sizes = [len(p) for p in packets[:-1]]
    if kind == 1:
        head += b"".join(b"\xff" * (s // 255) + bytes([s % 255]) for s in sizes)
    elif kind == 3:
        head += m.length_of(sizes[0])
        for a, b in zip(sizes, sizes[1:]):
            raw = b - a + (1 << 13) - 1  # two bytes
            head += (raw | 1 << 14).to_bytes(2, "big")
    return head + b"".join(packets)


@pytest.mark.parametrize("kind,lengths", [(0, [700]), (1, [300, 255, 0, 12]), (2, [50, 50, 50]), (3, [800, 500, 1040, 7])])
def test_lacing(kind, lengths):
    rng = random.Random(kind)
    packets = [rng.randbytes(n) for n in lengths]
    cluster = m.element(m.CLUSTER_TIME, b"\x0a") + m.element(m.BLOCK_GROUP, m.element(m.BLOCK, block(kind, packets)) + m.element(m.REFERENCE, b"\x01"))
    head = m.element(m.EBML, m.element(m.DOC_TYPE, b"matroska"))
    # Segment and cluster of unknown size, as live streams have them.
    data = head + m.number(m.SEGMENT) + b"\x01" + b"\xff" * 7 + m.number(m.CLUSTER) + b"\xff" + cluster + m.element(m.CUES, b"")
    media = m.Reader(data).read()
    assert [data[p[2] : p[2] + p[3]] for p in media.packets] == packets
    assert {(p[0], p[1], p[4]) for p in media.packets} == {(1, 15_000_000, False)}


def test_broken_files(spark):
    whole = m.write(m.pad(b"text"))
    rows = [(0, None), (1, b""), (2, b"RIFFxxxx"), (3, whole[:100]), (4, whole)]
    df = spark.createDataFrame(rows, "i int, media binary")
    got = {r["i"]: r for r in m.read(df).collect()}
    assert got[0]["payload"] is None and got[0]["problem"] is None
    assert all(got[i]["payload"] is None and got[i]["problem"] for i in (1, 2, 3))
    assert bytes(got[4]["payload"]) == m.pad(b"text") and got[4]["problem"] is None
    assert [tuple(r)[:6] for r in m.packet_table(df, "i").collect()] == [(4, 0, 1, 0, whole.index(b"text"), 192)]


def test_query(spark):
    text = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op7_matroska(spark, SF).collect()
    assert len(rows) == len(text)
    for r in rows:
        padded = m.pad(text[r["doc_id"]])
        media = m.write(padded)
        assert (r["n_bytes"], r["payload_bytes"], r["media_bytes"]) == (len(text[r["doc_id"]]), len(padded), len(media))
        assert r["payload_sha256"] == hashlib.sha256(padded).hexdigest() and r["media_sha256"] == hashlib.sha256(media).hexdigest()
        assert r["tail_crc32"] == zlib.crc32(padded[-16:])
        assert r["feature"]


def test_store_edge_cases(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "x", 0), (3, "x", 0)], "doc_id long, text string, media int")
    files = {(r["doc_id"], bytes(r["media"])) for r in m.store(df).collect()}
    assert len(files) == 3 and len({f for _, f in files}) == 2
    assert m.read(m.store(df.limit(0))).count() == 0
