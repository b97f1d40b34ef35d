"""Media columns: Matroska files in binary columns, written and parsed.

A file is a tree of EBML elements, each an id and a length of variable size. The reader walks
the tree to clusters and blocks, undoes lacing (none, Xiph, fixed-size, EBML) and gives one row
a packet: track, timestamp, byte range in the file. The writer stores bytes as an uncompressed
8-bit audio track: packets of 192 samples, fixed-size lacing, clusters, and a cue a cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, with_columns

# Element ids of the Matroska specification.
EBML, EBML_VERSION, EBML_READ_VERSION, MAX_ID, MAX_SIZE = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3
DOC_TYPE, DOC_VERSION, DOC_READ_VERSION = 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, DURATION, MUXER, WRITER = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC, LACING = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0x9C
DEFAULT_DURATION, AUDIO, RATE, CHANNELS, DEPTH = 0x23E383, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, CLUSTER_TIME, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0xFB
CUES, CUE, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
SEEK_HEAD, CHAPTERS, TAGS, ATTACHMENTS = 0x114D9B74, 0x1043A770, 0x1254C367, 0x1941A469
TOP_LEVEL = {SEGMENT, INFO, TRACKS, CLUSTER, CUES, SEEK_HEAD, CHAPTERS, TAGS, ATTACHMENTS, EBML}

FRAME = 192  # samples of a packet
LACED = 8  # packets of a block
BLOCKS = 40  # blocks of a cluster
SAMPLES = 8000  # a second: a packet lasts 24 ms


def number(value: int) -> bytes:
    return value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big")


def length_of(size: int) -> bytes:
    """A variable-length integer; the all-ones value of each width is kept for unknown sizes."""
    width = 1
    while size >= (1 << (7 * width)) - 1:
        width += 1
    return (size | 1 << (7 * width)).to_bytes(width, "big")


def element(tag: int, body: bytes) -> bytes:
    return number(tag) + length_of(len(body)) + body


def write(payload: bytes) -> bytes:
    """A Matroska file with the payload, a multiple of FRAME bytes, as one 8-bit audio track."""
    import struct

    step = FRAME * 1000 // SAMPLES
    head = element(
        EBML,
        element(EBML_VERSION, number(1)) + element(EBML_READ_VERSION, number(1)) + element(MAX_ID, number(4)) + element(MAX_SIZE, number(8))
        + element(DOC_TYPE, b"matroska") + element(DOC_VERSION, number(4)) + element(DOC_READ_VERSION, number(2)),
    )
    packets = len(payload) // FRAME
    info = element(
        INFO,
        element(TIMESTAMP_SCALE, number(1_000_000)) + element(DURATION, struct.pack(">d", packets * step))
        + element(MUXER, b"geots") + element(WRITER, b"geots"),
    )
    audio = element(AUDIO, element(RATE, struct.pack(">d", SAMPLES)) + element(CHANNELS, number(1)) + element(DEPTH, number(8)))
    tracks = element(
        TRACKS,
        element(
            TRACK,
            element(TRACK_NUMBER, number(1)) + element(TRACK_UID, number(1)) + element(TRACK_TYPE, number(2)) + element(LACING, number(1))
            + element(CODEC, b"A_PCM/INT/LIT") + element(DEFAULT_DURATION, number(step * 1_000_000)) + audio,
        ),
    )
    parts, cues, at = [info, tracks], [], len(info) + len(tracks)
    for first in range(0, packets, LACED * BLOCKS):
        began, body = first * step, [element(CLUSTER_TIME, number(first * step))]
        last = min(first + LACED * BLOCKS, packets)
        for block in range(first, last, LACED):
            count = min(LACED, last - block)
            lace = b"\x84" + bytes([count - 1]) if count > 1 else b"\x80"  # key frame; fixed-size lacing
            data = payload[block * FRAME : (block + count) * FRAME]
            body.append(element(SIMPLE_BLOCK, b"\x81" + (block * step - began).to_bytes(2, "big", signed=True) + lace + data))
        cluster = element(CLUSTER, b"".join(body))
        cues.append(element(CUE, element(CUE_TIME, number(began)) + element(CUE_POSITIONS, element(CUE_TRACK, number(1)) + element(CUE_CLUSTER, number(at)))))
        parts.append(cluster)
        at += len(cluster)
    parts.append(element(CUES, b"".join(cues)))
    return head + element(SEGMENT, b"".join(parts))


@dataclass
class Media:
    """What a file holds; packets are (track, timestamp in ns, start, length, key frame, cluster)."""

    doc_type: str = ""
    scale: int = 1_000_000
    tracks: dict[int, dict] = field(default_factory=dict)
    packets: list[tuple] = field(default_factory=list)
    clusters: list[int] = field(default_factory=list)  # positions in the segment
    cues: list[tuple[int, int, int]] = field(default_factory=list)  # time, track, cluster position


class Reader:
    """Walks the elements of one file. Raises ValueError where the file breaks off or is no EBML."""

    def __init__(self, data: bytes):
        self.data = data
        self.media = Media()

    def vint(self, at: int, marked: bool = False) -> tuple[int, int, bool]:
        """Value (with its length marker if ``marked``), next position, whether all bits are ones."""
        if at >= len(self.data) or not self.data[at]:
            raise ValueError(f"no variable-length integer at {at}")
        width = 9 - self.data[at].bit_length()
        raw = self.data[at : at + width]
        if len(raw) < width:
            raise ValueError(f"the file ends in an integer at {at}")
        value = int.from_bytes(raw, "big")
        bare = value ^ 1 << (7 * width)
        return value if marked else bare, at + width, bare == (1 << (7 * width)) - 1

    def children(self, at: int, end: int, own: int = 0) -> Iterator[tuple[int, int, int]]:
        """(id, start, end) of the elements in a range; one of unknown size ends its siblings' walk."""
        while at < end:
            tag, start, _ = self.vint(at, True)
            size, start, unknown = self.vint(start)
            if unknown:
                stop = self.unknown_end(tag, start, end)
            elif start + size > end:
                raise ValueError(f"element {tag:x} at {at} goes beyond its parent")
            else:
                stop = start + size
            yield tag, start, stop
            at = stop

    def unknown_end(self, tag: int, at: int, end: int) -> int:
        """An element of unknown size ends where one begins that cannot be its child."""
        if tag == SEGMENT:
            return end
        while at < end:
            child, start, _ = self.vint(at, True)
            if child in TOP_LEVEL:
                return at
            size, start, _ = self.vint(start)
            at = start + size
        return end

    def integer(self, start: int, end: int) -> int:
        return int.from_bytes(self.data[start:end], "big")

    def real(self, start: int, end: int) -> float:
        import struct

        return struct.unpack(">d" if end - start == 8 else ">f", self.data[start:end])[0] if end > start else 0.0

    def read(self) -> Media:
        for tag, start, end in self.children(0, len(self.data)):
            if tag == EBML:
                for sub, a, b in self.children(start, end):
                    if sub == DOC_TYPE:
                        self.media.doc_type = self.data[a:b].decode("ascii", "replace")
            elif tag == SEGMENT:
                self.segment(start, end)
        if not self.media.doc_type:
            raise ValueError("no EBML header")
        return self.media

    def segment(self, start: int, end: int) -> None:
        at = start
        for tag, a, b in self.children(start, end):
            if tag == INFO:
                for sub, c, d in self.children(a, b):
                    if sub == TIMESTAMP_SCALE:
                        self.media.scale = self.integer(c, d)
            elif tag == TRACKS:
                for _, c, d in self.children(a, b):
                    self.track(c, d)
            elif tag == CLUSTER:
                self.media.clusters.append(at - start)
                self.cluster(a, b)
            elif tag == CUES:
                for _, c, d in self.children(a, b):
                    self.cue(c, d)
            at = b

    def track(self, start: int, end: int) -> None:
        found = {"number": 0, "type": 0, "codec": "", "rate": 8000.0, "channels": 1, "depth": 0, "duration": 0}
        whole = {TRACK_NUMBER: "number", TRACK_TYPE: "type", DEFAULT_DURATION: "duration"}
        for tag, a, b in self.children(start, end):
            if tag in whole:
                found[whole[tag]] = self.integer(a, b)
            elif tag == CODEC:
                found["codec"] = self.data[a:b].decode("ascii", "replace")
            elif tag == AUDIO:
                for sub, c, d in self.children(a, b):
                    if sub == RATE:
                        found["rate"] = self.real(c, d)
                    elif sub in (CHANNELS, DEPTH):
                        found["channels" if sub == CHANNELS else "depth"] = self.integer(c, d)
        self.media.tracks[found["number"]] = found

    def cue(self, start: int, end: int) -> None:
        time = 0
        for tag, a, b in self.children(start, end):
            if tag == CUE_TIME:
                time = self.integer(a, b)
            elif tag == CUE_POSITIONS:
                at = {sub: self.integer(c, d) for sub, c, d in self.children(a, b)}
                self.media.cues.append((time * self.media.scale, at.get(CUE_TRACK, 0), at.get(CUE_CLUSTER, 0)))

    def cluster(self, start: int, end: int) -> None:
        time = 0
        for tag, a, b in self.children(start, end):
            if tag == CLUSTER_TIME:
                time = self.integer(a, b)
            elif tag == SIMPLE_BLOCK:
                self.block(a, b, time, None)
            elif tag == BLOCK_GROUP:
                parts = list(self.children(a, b))
                for sub, c, d in parts:
                    if sub == BLOCK:
                        self.block(c, d, time, all(x[0] != REFERENCE for x in parts))

    def block(self, start: int, end: int, time: int, key: bool | None) -> None:
        track, at, _ = self.vint(start)
        if at + 3 > end:
            raise ValueError(f"the block at {start} has no header")
        time += int.from_bytes(self.data[at : at + 2], "big", signed=True)
        flags = self.data[at + 2]
        at += 3
        sizes, at = self.laces(flags >> 1 & 3, at, end)
        step = self.media.tracks.get(track, {}).get("duration", 0)
        stamp, cluster = time * self.media.scale, len(self.media.clusters) - 1
        for k, size in enumerate(sizes):
            self.media.packets.append((track, stamp + k * step, at, size, bool(flags & 0x80) if key is None else key, cluster))
            at += size

    def laces(self, kind: int, at: int, end: int) -> tuple[list[int], int]:
        """Packet sizes of a block, and where its first packet begins."""
        if not kind:
            return [end - at], at
        count = self.data[at] + 1
        at += 1
        if kind == 2:
            if (end - at) % count:
                raise ValueError(f"fixed-size lacing at {at} does not divide its block")
            return [(end - at) // count] * count, at
        sizes: list[int] = []
        for k in range(count - 1):
            if kind == 1:  # Xiph: bytes of 255 and one below
                size = 0
                while self.data[at] == 255:
                    size, at = size + 255, at + 1
                sizes.append(size + self.data[at])
                at += 1
            else:  # EBML: the first size, then signed differences
                begun = at
                value, at, _ = self.vint(at)
                sizes.append(value if not k else sizes[-1] + value - ((1 << (7 * (at - begun) - 1)) - 1))
        rest = end - at - sum(sizes)
        if rest < 0 or min(sizes, default=0) < 0:
            raise ValueError(f"lacing at {at} goes beyond its block")
        return [*sizes, rest], at


def pad(data: bytes) -> bytes:
    """Blanks up to a positive multiple of FRAME bytes."""
    return data.ljust(max(1, -(-len(data) // FRAME)) * FRAME, b" ")


def store(docs: DataFrame, text: str = "text", into: str = "media") -> DataFrame:
    """``docs`` with ``into``: its whole text in UTF-8, padded, as a Matroska file (binary).

    A null text is stored as the empty one (one packet of blanks); equal texts give equal files;
    an existing column ``into`` is replaced; an empty table gives an empty one.
    """
    docs = docs.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = pa.array((write(pad((t or "").encode())) for t in batch.column(text).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, files], names=[*batch.schema.names, into])

    return map_batches(docs, run, with_columns(docs, (into, T.BinaryType())))


def read(files: DataFrame, media: str = "media") -> DataFrame:
    """``files`` with ``payload`` (binary), ``feature`` (string) and ``problem`` (string).

    ``payload`` joins the packets' bytes in the order of the file. ``feature`` tells codec, rate,
    tracks, clusters, packets, clusters that cues lead to, the duration, and the samples' mean
    and root mean square. A null file gives nulls; a broken one gives nulls and its ``problem``.
    Existing columns of these names are replaced.
    """
    files = files.drop("payload", "feature", "problem")
    schema = with_columns(files, ("payload", T.BinaryType()), ("feature", T.StringType()), ("problem", T.StringType()))

    def one(data: bytes | None) -> tuple[bytes | None, str | None, str | None]:
        if data is None:
            return None, None, None
        try:
            media = Reader(data).read()
        except (ValueError, IndexError) as e:
            return None, None, str(e)
        payload = b"".join(data[p[2] : p[2] + p[3]] for p in media.packets)
        wave = np.frombuffer(payload, np.uint8).astype(np.float64)
        track = next(iter(media.tracks.values()), {"codec": "", "rate": 0.0, "duration": 0})
        ends = max((p[1] + track["duration"] for p in media.packets), default=0)
        told = {
            "codec": track["codec"],
            "rate": round(track["rate"]),
            "tracks": len(media.tracks),
            "clusters": len(media.clusters),
            "packets": len(media.packets),
            "cues": len({c[2] for c in media.cues} & set(media.clusters)),
            "ms": ends // 1_000_000,
            "mean": f"{wave.mean():.3f}" if len(wave) else "",
            "rms": f"{np.sqrt(np.square(wave).mean()):.3f}" if len(wave) else "",
        }
        return payload, ";".join(f"{k}={v}" for k, v in told.items()), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [one(d) for d in batch.column(media).to_pylist()]
            arrays = [pa.array((g[k] for g in got), kind) for k, kind in enumerate((pa.binary(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, "payload", "feature", "problem"])

    return map_batches(files, run, schema)


def packet_table(files: DataFrame, key: str, media: str = "media") -> DataFrame:
    """One row a packet: ``key``, packet number, track, timestamp, byte range, key frame, cluster.

    Null and broken files give no packet (``read`` tells the problem).
    """
    fields = "packet long, track int, timestamp_ns long, start long, length long, key_frame boolean, cluster int"
    files = files.select(F.col(key), F.col(media))
    schema = T.StructType([files.schema[key], *T._parse_datatype_string(fields).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, data in enumerate(batch.column(media).to_pylist()):
                try:
                    packets = Reader(data).read().packets if data is not None else []
                except (ValueError, IndexError):
                    continue
                if packets:
                    track, stamp, start, length, keyed, cluster = zip(*packets)
                    columns = [pa.array(range(len(packets)), pa.int64()), pa.array(track, pa.int32()), pa.array(stamp, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(keyed, pa.bool_()), pa.array(cluster, pa.int32())]
                    own = pa.repeat(batch.column(key)[k], len(packets))
                    yield pa.RecordBatch.from_arrays([own, *columns], names=schema.names)

    return map_batches(files, run, schema)
