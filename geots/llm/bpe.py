"""Byte-level BPE encoding with a pair occurrence index, and decoding.

A batch's distinct pre-tokens stand side by side in one symbol array. The index maps each pair
that has a rank to all positions where it stands. The lowest active rank is taken from a heap,
merged at all its positions at once, and only the neighbours of merged positions enter the
index again, under the ranks of their new pairs. What a pre-token became is remembered in the
worker, within a bound, so that frequent ones are encoded once.

The vocabulary file's path is a parameter; it is read by each worker and never copied.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, with_columns

GROUP_CHARS = 1 << 20  # characters of texts whose pre-tokens stand in one symbol array
OUT_BYTES = 2 << 20  # of ids and texts in a batch on its way out

#: Pre-tokens that one worker remembers, and their characters; beyond either it starts afresh.
REMEMBERED, REMEMBERED_CHARS = 400_000, 16_000_000

# The pre-token pattern of byte-level vocabularies, with Unicode's white space spelled out.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRETOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Interner(dict):
    """Numbers strings as they come; ``fresh`` holds those that have no entry in the table yet."""

    def __init__(self, words: int = REMEMBERED, chars: int = REMEMBERED_CHARS):
        super().__init__()
        self.fresh: list[str] = []
        self.chars = 0
        self.bounds = words, chars

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        self.chars += len(word)
        return n

    def full(self) -> bool:
        return len(self) > self.bounds[0] or self.chars > self.bounds[1]


class ByteBpe:
    """A byte-level BPE vocabulary: ranked merges, added tokens and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        symbols = byte_symbols()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.id_bytes = token_bytes(path)
        self.size = len(self.id_bytes)
        self.byte_ids = np.array([vocab[c] for c in symbols], np.int64)
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = self.left * self.size + self.right
        self._by_key = np.argsort(keys, kind="stable")
        self._keys = keys[self._by_key]
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.index, self.table = Interner(), []

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols, -1 where there is no merge."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._by_key[at], -1)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        if not words:
            return []
        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(size)
        sym = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)].astype(np.int32)
        n = len(sym)
        nxt, prv = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        nxt[ends - 1] = -1
        prv[ends - size] = -1

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Put the pairs that begin at these positions into the index."""
            rank = self.ranks(sym[at], sym[nxt[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, group in zip(rank[np.concatenate(([0], cuts))].tolist() if len(rank) else (), np.split(at, cuts)):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(group)

        enter(np.flatnonzero(nxt >= 0).astype(np.int32))
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            a, b = self.left[r], self.right[r]
            to = nxt[at]
            live = (sym[at] == a) & (to >= 0) & (sym[to] == b)
            at, to = at[live], to[live]
            if not len(at):
                continue
            if a == b:  # in a run of one symbol every second pair merges, from the left
                order = np.arange(len(at))
                chained = np.concatenate(([False], to[:-1] == at[1:]))
                begun = np.maximum.accumulate(np.where(chained, 0, order))
                at, to = at[(order - begun) % 2 == 0], to[(order - begun) % 2 == 0]
            after = nxt[to]
            sym[at], sym[to], nxt[at] = self.merged[r], -1, after
            has = after >= 0
            prv[after[has]] = at[has]
            before = prv[at]
            enter(np.unique(np.concatenate((at[has], before[before >= 0]))))
        live = sym >= 0
        data = sym[live].astype("<u4").tobytes()
        stops = (np.cumsum(live)[ends - 1] * 4).tolist()
        return [data[i:j] for i, j in zip([0, *stops], stops)]

    def encode_batch(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers; some texts are held at a time."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP_CHARS:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        index, table = self.index, self.table
        coded: list = []
        for text in texts:
            parts = self.splitter.split(text) if self.splitter and any(t in text for t in self.added) else (text,)
            coded.append([
                self.added[p] if k % 2 else np.fromiter(map(index.__getitem__, PRETOKEN.findall(p)), np.uint32)
                for k, p in enumerate(parts)
            ])
        table += self.encode_words([w.encode() for w in index.fresh])
        index.fresh.clear()
        for parts in coded:
            yield b"".join(
                p.to_bytes(4, "little") if isinstance(p, int) else b"".join(map(table.__getitem__, p.tolist())) for p in parts
            )
        if index.full():
            self.index, self.table = Interner(), []


def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id; an added token has its string's."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    back = {c: b for b, c in enumerate(byte_symbols())}
    found = {i: bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t, i in spec["model"]["vocab"].items()}
    found |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return [found.get(i, b"") for i in range(max(found) + 1)]


def decoded(ids: bytes, tokens: list[bytes]) -> str:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_loaded: dict[str, ByteBpe] = {}


def vocabulary(path: str) -> ByteBpe:
    """The vocabulary of this worker process."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with ``into``: the token ids of the whole text, binary, little-endian unsigned 32-bit.

    Strings of added tokens inside a text become those tokens, as in the library's default.
    Edge cases: a null or empty text has no ids (empty binary); repeated rows are encoded alike;
    an existing column ``into`` is replaced; an empty table gives an empty one.
    """
    docs = docs.drop(into)
    schema = with_columns(docs, (into, T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(text))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bpe.encode_batch(texts), pa.binary())], names=[*batch.schema.names, into])

    return map_batches(docs, run, schema)


def decode(docs: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with ``into``: the text of the ids in column ``ids``, special tokens included.

    Bytes that are not UTF-8 become U+FFFD. Null ids give an empty text; an existing column
    ``into`` is replaced.
    """
    docs = docs.drop(into)
    schema = with_columns(docs, (into, T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(path)
        for batch in batches:
            texts = pa.array((decoded(i or b"", tokens) for i in batch.column(ids).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, into])

    return map_batches(docs, run, schema)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded): the token ids of each whole text and the text that they decode to.

    ``encode`` and ``decode`` in one pass over a text. Edge cases are theirs; only the two columns
    are read, so others may have any name.
    """
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    schema = T.StructType([T.StructField("k", rows.schema["k"].dataType), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            texts = batch.column("t")
            ids, told, size, first = [], [], 0, 0
            for found in bpe.encode_batch(texts[n].as_py() or "" for n in range(batch.num_rows)):
                ids.append(found)
                told.append(decoded(found, bpe.id_bytes))
                size += len(found) + len(told[-1])
                if size >= OUT_BYTES:
                    yield part(batch, first, ids, told)
                    ids, told, size, first = [], [], 0, first + len(ids)
            yield part(batch, first, ids, told)

    def part(batch: pa.RecordBatch, first: int, ids: list[bytes], told: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("k").slice(first, len(ids)), pa.array(ids, pa.binary()), pa.array(told, pa.string())], names=["k", "ids", "decoded"])

    return map_batches(rows, run, schema).withColumnRenamed("k", key)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token count and the digests of a document's ids and of its decoded text."""
    both = round_trip(docs, path, key, text)
    return both.select(
        F.col(key).alias(key),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
