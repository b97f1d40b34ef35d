"""Token counts from finite-state transducers.

Two deterministic transducers in cascade count the tokens of a byte-level BPE vocabulary:

1. The pre-tokenizer reads classes of characters (with one or two characters of look-ahead
   folded into the class) and emits a mark where a pre-token begins. A batch of texts is cut
   into chunks of equal length that step side by side. Each chunk first yields its state map
   (the state after it, for each state before it); the maps compose through a parallel prefix
   scan, which gives each chunk's first state; a second pass emits the marks.
2. The word transducer reads the bytes of one pre-token. Its states are the prefixes met so
   far, and each transition is annotated with the tokens it emits: how many more tokens the
   longer prefix has (possibly none, or fewer, when the byte completes a larger token).
   It is compiled as new prefixes come: the last token of a prefix is the one token that ends
   there and stands, under the merge ranks, after the last token of what comes before it. The
   tokens that end at a byte come from an automaton of the vocabulary read backwards. A prefix
   longer than ``LONG`` makes no state of its own: its transitions are computed as the word is
   read, from the positions that the longest token reaches back to, and are not kept.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import SPACE, ByteBpe, Interner
from .common import map_batches, with_columns

CHUNK = 512  # characters a chunk steps through
SLICE = 2_000_000  # characters that step at once
NODES = 1_000_000  # states of the word transducer, beyond which it is compiled afresh
LONG = 256  # bytes of a word whose prefixes become states
STANDS = 500_000  # pairs of tokens of which it is remembered whether they stand

# Classes of characters, after look-ahead, and states of the pre-tokenizer.
LETTER, NUMBER, OTHER, JOIN, LAST, MID, QUOTE1, QUOTE2 = range(8)
START, IN_LETTERS, IN_NUMBERS, IN_OTHER, JOINING, AFTER_SPACE, IN_SPACE, ONE_MORE, TWO_MORE, DONE = range(10)
CLASSES, STATES = 8, 10


def pretokenizer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and mark, by class * STATES + state; a class + CLASSES reads as at a text's start."""
    step = np.zeros((2 * CLASSES, STATES), np.uint8)
    mark = np.ones((2 * CLASSES, STATES), bool)
    for state in range(STATES):
        run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER, JOIN: JOINING, LAST: AFTER_SPACE, MID: IN_SPACE, QUOTE1: ONE_MORE, QUOTE2: TWO_MORE}
        for kind, to in run.items():
            step[kind, state] = to
        for kind in (LETTER, NUMBER, OTHER):  # a run goes on, or takes the space before it
            mark[kind, state] = state not in (run[kind], JOINING)
        mark[MID, state] = state != IN_SPACE
        if state in (IN_OTHER, JOINING):  # an apostrophe inside a run of others abbreviates nothing
            for kind in (QUOTE1, QUOTE2):
                step[kind, state], mark[kind, state] = IN_OTHER, False
        if state in (ONE_MORE, TWO_MORE):
            step[LETTER, state], mark[LETTER, state] = (DONE if state == ONE_MORE else ONE_MORE), False
    step[CLASSES:], mark[CLASSES:] = step[:CLASSES, :1], True
    return step.ravel(), mark.ravel()


def _character_kinds() -> np.ndarray:
    kinds = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (MID, f"[{SPACE}]")):
        found = "".join(regex.findall(pattern, every))
        kinds[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return kinds


class Counter:
    """Both transducers for one vocabulary file."""

    def __init__(self, path: str):
        self.bpe = ByteBpe(path)
        self.step, self.mark = pretokenizer()
        self.kinds = _character_kinds()
        self.token_of = {b: i for i, b in enumerate(self.bpe.id_bytes) if i not in self.bpe.added.values()}
        self.longest = max(map(len, self.token_of))
        self.merges = {(int(a), int(b)): (r, int(m)) for r, (a, b, m) in enumerate(zip(self.bpe.left, self.bpe.right, self.bpe.merged))}
        self.stands: dict[int, bool] = {}
        self.back: dict[int, int] = {}  # state << 8 | byte -> state, over the tokens' bytes from the last to the first
        self.ending: list[int] = [-1]  # the token that a state has read, if any
        for token, i in self.token_of.items():
            state = 0
            for byte in reversed(token):
                state = self.back.setdefault(state << 8 | byte, len(self.ending))
                if state == len(self.ending):
                    self.ending.append(-1)
            self.ending[state] = i
        self._fresh_start()

    def _fresh_start(self) -> None:
        self.child: dict[int, int] = {}  # state << 8 | byte -> state
        self.emits: list[int] = [0]  # tokens that the transition into a state emits
        self.last: list[int] = [-1]  # last token of the prefix
        self.index, self.counts = Interner(), []

    def _tokens(self, data: bytes) -> list[int]:
        ids = [int(self.bpe.byte_ids[b]) for b in data]
        while len(ids) > 1:
            best = min(((self.merges[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merges), default=None)
            if best is None:
                break
            k = best[1]
            ids[k : k + 2] = [self.merges[ids[k], ids[k + 1]][1]]
        return ids

    def _stand(self, before: int, token: int) -> bool:
        """Whether the merge ranks leave these two tokens side by side (or the one alone)."""
        key = (before + 1) * self.bpe.size + token
        known = self.stands.get(key)
        if known is None:
            if len(self.stands) >= STANDS:
                self.stands.clear()
            pair = [token] if before < 0 else [before, token]
            known = self.stands[key] = self._tokens(b"".join(map(self.bpe.id_bytes.__getitem__, pair))) == pair
        return known

    def _last_token(self, word: bytes, n: int, lasts: list[int]) -> tuple[int, int]:
        """Length and id of the last token of ``word[:n]``; ``lasts`` holds those of shorter prefixes, by length, in a ring."""
        back, ending, ring = self.back, self.ending, len(lasts)
        found, state, at = [], 0, n
        while at:
            at -= 1
            state = back.get(state << 8 | word[at])
            if state is None:
                break
            if ending[state] >= 0:
                found.append((n - at, ending[state]))
        for k, token in reversed(found):
            if self._stand(lasts[(n - k) % ring], token):
                return k, token
        raise ValueError(f"no token ends at byte {n}")

    def compile(self, word: bytes) -> int:
        """Tokens that the word transducer emits for a pre-token; states it lacks are added."""
        child, emits, last = self.child, self.emits, self.last
        ring = self.longest + 1
        lasts, sums = [-1] * ring, [0] * ring
        state = total = 0
        for n, byte in enumerate(word[:LONG], 1):
            key = state << 8 | byte
            to = child.get(key)
            if to is None:
                k, token = self._last_token(word, n, lasts)
                to = child[key] = len(emits)
                emits.append(sums[(n - k) % ring] + 1 - total)
                last.append(token)
            state = to
            total += emits[state]
            lasts[n % ring], sums[n % ring] = last[state], total
        for n in range(LONG + 1, len(word) + 1):
            k, lasts[n % ring] = self._last_token(word, n, lasts)
            total = sums[n % ring] = sums[(n - k) % ring] + 1
        return total

    def marks(self, joined: str, first: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin in ``joined``, whose texts begin at the positions ``first``."""
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        n = len(code)
        kind = self.kinds[code]
        begins = np.zeros(n + 2, bool)
        begins[first] = True
        begins[n:] = True
        after = np.concatenate((kind[1:], np.full(1, MID, np.uint8)))
        last = (kind == MID) & (after != MID) & ~begins[1 : n + 1]
        kind = np.where(last, np.where(code == 32, JOIN, LAST), kind).astype(np.uint8)
        quote = np.flatnonzero((code == 39) & ~begins[1 : n + 1])
        one, two = code[quote + 1], code[np.minimum(quote + 2, n - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b)) & ~begins[np.minimum(quote + 2, n)]
        kind[quote[short]] = QUOTE1
        kind[quote[long & ~short]] = QUOTE2
        kind[begins[:n]] += CLASSES

        lanes = -(-n // CHUNK)
        padded = np.full(lanes * CHUNK, OTHER, np.uint8)
        padded[:n] = kind
        columns = np.ascontiguousarray(padded.reshape(lanes, CHUNK).T) * STATES  # at most 159
        maps = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], lanes, 1)
        for column in columns:
            maps = self.step[column + maps]
        reach = 1
        while reach < lanes:  # parallel prefix scan: maps of ever longer stretches
            maps[:, reach:] = np.take_along_axis(maps[:, reach:], maps[:, :-reach].astype(np.intp), 0)
            reach *= 2
        state = np.concatenate((np.zeros(1, np.uint8), maps[START, :-1]))
        marks = np.empty((CHUNK, lanes), bool)
        for row, column in zip(marks, columns):
            at = column + state
            row[:] = self.mark[at]
            state = self.step[at]
        return np.flatnonzero(marks.T.ravel()[:n])

    def count_batch(self, texts: list[str]) -> list[int]:
        """Tokens of each text; strings of added tokens count as those tokens."""
        totals, group, owners, size = [0] * len(texts), [], [], 0
        splitter = self.bpe.splitter
        for k, text in enumerate(texts):
            parts = [text]
            if splitter and any(t in text for t in self.bpe.added):
                parts = splitter.split(text)
                totals[k] += len(parts) // 2
                parts = parts[::2]
            for part in filter(None, parts):
                group.append(part)
                owners.append(k)
                size += len(part)
                if size >= SLICE:
                    self._count(group, owners, totals)
                    group, owners, size = [], [], 0
        if group:
            self._count(group, owners, totals)
        return totals

    def _count(self, parts: list[str], owners: list[int], totals: list[int]) -> None:
        joined = "".join(parts)
        first = np.concatenate(([0], np.cumsum([len(p) for p in parts])[:-1]))
        marks = self.marks(joined, first)
        cuts = marks.tolist()
        words = np.fromiter(map(self.index.__getitem__, map(joined.__getitem__, map(slice, cuts, [*cuts[1:], len(joined)]))), np.int64, len(cuts))
        self.counts += [self.compile(w.encode()) for w in self.index.fresh]
        self.index.fresh.clear()
        sums = np.add.reduceat(np.array(self.counts, np.int64)[words], np.searchsorted(marks, first))
        for k, n in zip(owners, sums.tolist()):
            totals[k] += n
        if self.index.full() or len(self.emits) > NODES:
            self._fresh_start()


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The transducers of this worker process."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (n_tokens > limit) of the whole text.

    Edge cases: a null or empty text has 0 bytes and 0 tokens; repeated rows count alike; existing
    columns of these names are replaced; an empty table gives an empty one.
    """
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    schema = with_columns(docs, ("n_tokens", T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path)
        for batch in batches:
            totals = counts.count_batch([t or "" for t in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(totals, pa.int64())], names=[*batch.schema.names, "n_tokens"])

    return map_batches(docs, run, schema).withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
            "over_limit": F.col("n_tokens") > limit,
        }
    )
