"""Packing documents into token windows with the sum-of-squares rule.

Each document gives its whole windows at once; what is left of it, shorter than a window, goes
to the fill level for which the sum over levels of the squared number of partly filled windows
at that level becomes least (or to a new window, if that does). The counts are kept in a level
array. Windows that fill up leave at once. When a partition ends, the emptiest open windows are
cut up to fill the fullest, and the last one is cut at powers of two, which need no padding.

Each partition packs on its own, so there is no shuffle; what a task holds is its open windows.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import Interner
from .common import map_batches

WINDOW = 2048
END = 1
REMEMBERED, REMEMBERED_CHARS = 1_000_000, 40_000_000  # words of a worker, some 130 MB, and their characters
SLICE = 2000  # unseen words that go through the library at once
STRETCH = 1 << 18  # characters whose words are looked up at once
OUT_BYTES = 1 << 20  # of ids in a batch of pieces

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


class WordEncoder:
    """Token ids of texts, word by word through the tokenizers library.

    The vocabulary drops white space and never merges across it, so a text's ids are those of
    its words, one after the other. The ids of words met before stand one after the other in one
    array; with their words they are forgotten together beyond a bound. Unseen words go through
    the library some at a time, and texts some characters at a time, so that what is held does
    not depend on a batch.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._afresh()

    def _afresh(self) -> None:
        self.index = Interner(REMEMBERED, REMEMBERED_CHARS)
        self.ids = np.empty(1 << 16, np.uint32)  # of all known words
        self.ends = np.zeros(1 << 14, np.int64)  # where in them word k's begin, and word k - 1's end
        self.known = 0

    def _learn(self) -> None:
        """Encode the words that have no ids yet."""
        fresh = self.index.fresh
        for at in range(0, len(fresh), SLICE):
            words = fresh[at : at + SLICE]
            found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
            # A token belongs to the last word that does not begin after it.
            owner = np.searchsorted(np.cumsum(sizes) - sizes, [a for a, _ in found.offsets], "right") - 1
            begin, n = int(self.ends[self.known]), self.known + len(words)
            stops = begin + np.cumsum(np.bincount(owner, minlength=len(words)))
            self.ids, self.ends = _roomy(self.ids, int(stops[-1])), _roomy(self.ends, n + 1)
            self.ids[begin : stops[-1]] = found.ids
            self.ends[self.known + 1 : n + 1] = stops
            self.known = n
        fresh.clear()

    def encode(self, text: str) -> np.ndarray:
        """The ids of one text."""
        out = []
        # Cut at these two only: any other white space inside a word is the tokenizer's to drop.
        for part in _stretches(text.replace("\n", " ")):
            words = np.fromiter(map(self.index.__getitem__, part.split(" ")), np.int64)
            self._learn()
            begin = self.ends[words]
            size = self.ends[words + 1] - begin
            before = np.cumsum(size) - size
            out.append(self.ids[np.repeat(begin - before, size) + np.arange(int(size.sum()))])
            if self.index.full():
                self._afresh()
        return out[0] if len(out) == 1 else np.concatenate(out)


def _roomy(array: np.ndarray, size: int) -> np.ndarray:
    """``array`` with room for ``size`` items; it doubles when it grows."""
    if size <= len(array):
        return array
    grown = np.empty(max(size, 2 * len(array)), array.dtype)
    grown[: len(array)] = array
    return grown


def _stretches(text: str) -> Iterator[str]:
    """The text in stretches of whole words, STRETCH characters long as far as blanks allow."""
    at = 0
    while len(text) - at > STRETCH:
        cut = text.rfind(" ", at, at + STRETCH)
        if cut <= at:
            cut = text.find(" ", at + STRETCH)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class Packer:
    """Sum-of-squares packing of pieces (doc, start, length, ids, doc_tokens) into windows."""

    def __init__(self, window: int):
        self.window = window
        self.levels = np.zeros(window + 1, np.int64)
        self.open: dict[int, deque[list]] = {}

    def level_for(self, size: int) -> int:
        """The level (0: a new window) that makes the sum of squares least; the fuller of equals."""
        n, top = self.levels, self.window - size
        gain = 2 * n[size : size + top + 1] + 1  # a window more at level + size ...
        gain[top] = 0  # ... unless it is then full and counts no longer
        gain[1:] -= 2 * n[1 : top + 1] - 1  # and one less at the level
        gain[1:][n[1 : top + 1] == 0] = np.iinfo(np.int64).max
        return top - int(np.argmin(gain[::-1]))

    def place(self, piece: tuple) -> list | None:
        """Put a piece shorter than the window somewhere; the window, if that fills it."""
        size = piece[2]
        level = self.level_for(size)
        window = [piece]
        if level:
            held = self.open[level]
            window = held.popleft()
            if not held:
                del self.open[level]
            window.append(piece)
            self.levels[level] -= 1
        if level + size == self.window:
            return window
        self.levels[level + size] += 1
        self.open.setdefault(level + size, deque()).append(window)
        return None

    def finish(self) -> Iterator[list]:
        """Close the open windows: cut the emptiest to fill the fullest, then cut at powers of two."""
        rest = deque(w for level in sorted(self.open, reverse=True) for w in self.open[level])
        self.open = {}
        while rest:
            window = rest.popleft()
            free = self.window - sum(p[2] for p in window)
            while free and rest:
                doc, start, length, ids, total = rest[-1].pop()
                take = min(free, length)
                window.append((doc, start, take, ids[:take], total))
                if take < length:
                    rest[-1].append((doc, start + take, length - take, ids[take:], total))
                if not rest[-1]:
                    rest.pop()
                free -= take
            if not free:
                yield window
                continue
            left = self.window - free
            while window:
                part, room = [], 1 << (left.bit_length() - 1)
                left -= room
                while room:
                    doc, start, length, ids, total = window.pop(0)
                    take = min(room, length)
                    part.append((doc, start, take, ids[:take], total))
                    if take < length:
                        window.insert(0, (doc, start + take, length - take, ids[take:], total))
                    room -= take
                yield part


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END, remember: bool = True) -> DataFrame:
    """The pieces of all documents of ``docs`` with their places in sequences of ``window`` tokens.

    A document's ids are those of its whole text and then ``end``. One row a piece: its document,
    where in the document's ids it starts, its length, the document's number of ids, its sequence,
    its offset there, and its ids (little-endian unsigned 32-bit). Offsets in a sequence have no
    gap. A sequence is full or as long as a power of two. Sequence ids are unique, not gapless.
    Unless ``remember``, a worker forgets vocabulary and words at a task's end, and other stages
    of a job have that memory.

    Edge cases: a null or empty text is the id ``end`` alone; rows that repeat a key are packed
    each for itself under that key; a null key stays null; an empty table gives no piece; other
    columns are not read. What a task holds: one text and its ids, the remembered words, 1 MB of
    pieces on their way out, and its open windows, of which the rule keeps few.
    """
    docs = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = encoder(path), Packer(window)
        sequence = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        held = 0

        def close(pieces: list) -> None:
            nonlocal sequence, held
            at = 0
            for doc, start, length, ids, total in pieces:
                rows.append((doc, start, length, total, sequence, at, ids.tobytes()))
                at += length
            held += 4 * at
            sequence += 1

        def out() -> pa.RecordBatch:
            nonlocal held
            columns = list(zip(*rows)) if rows else [()] * len(PIECES)
            kinds = [*(pa.int64() for _ in range(6)), pa.binary()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=PIECES.names)
            rows.clear()
            held = 0
            return batch

        for batch in batches:
            keys, texts = batch.column("doc_id"), batch.column("text")
            for k in range(batch.num_rows):
                doc, ids = keys[k].as_py(), np.append(words.encode(texts[k].as_py() or ""), np.uint32(end)).astype("<u4", copy=False)
                total = len(ids)
                whole = total - total % window
                for start in range(0, whole, window):
                    close([(doc, start, window, ids[start : start + window], total)])
                    if held > OUT_BYTES:
                        yield out()
                # A copy: an open window keeps its own ids alive, not the whole document's.
                if whole < total and (full := packer.place((doc, whole, total - whole, ids[whole:].copy(), total))):
                    close(full)
                if held > OUT_BYTES:
                    yield out()
        for pieces in packer.finish():
            close(pieces)
            if held > OUT_BYTES:
                yield out()
        yield out()
        if not remember:
            _encoders.clear()

    return map_batches(docs, run, PIECES)
