"""Spelling variants: words that differ by one letter, found by two-dimensional range reporting.

Words that differ at position p agree on the p letters before it and on all letters behind it. So
words are put in order twice, forward and read backwards; a word is a point (forward rank, backward
rank), and the words that fit another one at p are the points of a rectangle: the interval of its
prefix times the interval of its suffix. A wavelet tree over the points reports them.

Spark deals the words so that one task holds only words that can meet. A word of m letters and one
of m or m + 1 that are near differ inside one half of the m positions and agree on the other, which
is the bucket's key. A bucket of too many words is dealt again by the halves of its range of
positions, down to a single position, where what is left differs in one letter: at most twice the
alphabet. Every near pair has one position (of an inserted letter in a run of equals the last), so
it is found in one bucket, once, and a task sums up its words' near words instead of sending pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_batches

LETTERS = r"[A-Za-zÀ-ÿ]+"
LEAST_LETTERS, LEAST_COUNT = 5, 3
RATIO = 2  # how many times as frequent as a word its form is at least
BUCKET = 4096  # words of a bucket
CHUNK = 1 << 20  # letters that are put in order together
HELD = 200_000  # words that a counting task holds, and eight times as many letters
STRETCH = 1 << 20  # characters of a text whose runs are taken at once

_RUN = re.compile(LETTERS)
_LOWER = {c: c + 32 for c in range(65, 91)}


def lowered(word: str) -> str:
    return word.lower() if word.isascii() else word.translate(_LOWER)


def runs(text: str) -> Counter:
    """The maximal runs of letters in a text, lower-cased, and how often each occurs."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        end = min(len(text), at + STRETCH)
        # A stretch ends behind the run that it would cut.
        if end < len(text) and (cut := _RUN.match(text, end)):
            end = cut.end()
        found.update(_RUN.findall(text, at, end))
        at = end
    out: Counter = Counter()
    for word, n in found.items():
        out[lowered(word)] += n
    return out


def noised(key: str, word: str, every: int) -> str:
    """``word`` less one letter where the checksum of ``key:word`` is a multiple of ``every``."""
    h = zlib.crc32(f"{key}:{word}".encode())
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", noise: int | None = 97) -> DataFrame:
    """(word, n): words of at least LEAST_LETTERS letters that occur LEAST_COUNT times or more.

    A null key counts as the empty text in the checksum; null texts have no words. ``noise`` None
    takes the words as they stand.
    """
    own = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text")).filter("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        letters = 0

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                for word, n in runs(t).items():
                    if noise:
                        word = noised(k, word, noise)
                    if len(word) >= LEAST_LETTERS:
                        letters += len(word) if word not in counts else 0
                        counts[word] += n
                if len(counts) > HELD or letters > 8 * HELD:
                    yield out()
                    letters = 0
        yield out()

    return map_batches(own, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


class Wavelet:
    """A wavelet tree, level by level, over a permutation: which values of a range stand in an interval."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        self.bits = max(1, int(self.size - 1).bit_length())
        self.zeros = []  # for each level, how many of the first i values have bit 0 there
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1
            self.zeros.append(np.concatenate(([0], np.cumsum(1 - one))))
            values = np.concatenate((values[one == 0], values[one == 1]))

    def report(self, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, value): the values in [low, high) at places in [left, right), all queries at once."""
        asked = np.flatnonzero((left < right) & (low < high))
        left, right, low, high = left[asked], right[asked], low[asked], high[asked]
        value = np.zeros(len(asked), np.int64)
        for level, zeros in enumerate(self.zeros):
            step = 1 << (self.bits - 1 - level)
            l0, r0 = zeros[left], zeros[right]
            l1, r1 = zeros[-1] + left - l0, zeros[-1] + right - r0
            zero = np.flatnonzero((l0 < r0) & (value + step > low) & (value < high))
            one = np.flatnonzero((l1 < r1) & (value + 2 * step > low) & (value + step < high))
            asked, low, high = (np.concatenate((x[zero], x[one])) for x in (asked, low, high))
            left, right = np.concatenate((l0[zero], l1[one])), np.concatenate((r0[zero], r1[one]))
            value = np.concatenate((value[zero], value[one] + step))
        return asked, value


class Order:
    """Words of some buckets in order of their letters; words of another bucket share no prefix."""

    def __init__(self, words: list[str], bucket: list[int], length: int):
        keys = list(zip(bucket, words))
        self.order = np.array(sorted(range(len(words)), key=keys.__getitem__), np.int64)
        self.rank = np.empty(len(words), np.int64)
        self.rank[self.order] = np.arange(len(words))
        letters = np.frombuffer("".join(w[:length] for w in words).encode("utf-32-le"), np.uint32).reshape(-1, length)[self.order]
        same = np.concatenate((letters[1:] == letters[:-1], np.zeros((max(0, len(words) - 1), 1), bool)), 1)
        home = np.array(bucket)[self.order]
        self.shared = np.concatenate(([-1], np.where(home[1:] == home[:-1], same.argmin(1), -1)))

    def interval(self, prefix: int) -> tuple[np.ndarray, np.ndarray]:
        """For each word, the first and the last rank (exclusive) of words that share ``prefix`` letters with it."""
        begins = np.flatnonzero(self.shared < prefix)
        which = np.cumsum(self.shared < prefix) - 1
        ends = np.append(begins[1:], len(self.order))
        return begins[which][self.rank], ends[which][self.rank]


def _within(order: Order, index: np.ndarray) -> np.ndarray:
    """How many of the words ``index`` (a mask) stand before each rank."""
    return np.concatenate(([0], np.cumsum(index[order.order])))


def near_pairs(words: list[str], bucket: list[int], length: int, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of near words of one bucket, for each position in [low, high).

    ``words`` have ``length`` letters or one more. Pairs of equal length come in both directions,
    others from the shorter to the longer.
    """
    count = np.fromiter(map(len, words), np.int64, len(words))
    forward, backward = Order(words, bucket, length), Order([w[::-1] for w in words], bucket, length)
    letter = np.frombuffer("".join(w.ljust(length + 1, "\0") for w in words).encode("utf-32-le"), np.uint32).reshape(-1, length + 1)
    short = np.flatnonzero(count == length)
    for size, gap in ((length, 1), (length + 1, 0)):
        index = count == size
        if not index.any() or not len(short):
            continue
        before_f, before_b = _within(forward, index), _within(backward, index)
        points = forward.order[index[forward.order]]
        named = backward.order[index[backward.order]]
        tree = Wavelet(before_b[backward.rank[points]])
        for p in range(low, min(high, length + 1 - gap)):
            left, right = (before_f[x[short]] for x in forward.interval(p))
            bottom, top = (before_b[x[short]] for x in backward.interval(length - p - gap))
            i, value = tree.report(left, right, bottom, top)
            i, j = short[i], named[value]
            # Not the word itself, and of a run of equal letters the place behind it.
            keep = letter[i, p] != letter[j, p]
            yield i[keep], j[keep]


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word of a bucket, how many near words it has there, and the most frequent of them."""
    held: list[tuple] = []
    letters = 0

    def out() -> Iterator[pa.RecordBatch]:
        home = [row[3] for row in held]
        begins = {k: i for i, k in enumerate(dict.fromkeys(home))}
        words = [row[4] for row in held]
        n = np.array([row[5] for row in held])
        rank = np.empty(len(held), np.int64)
        best = sorted(range(len(held)), key=lambda i: (-n[i], words[i]))
        rank[best] = np.arange(len(held))
        total, first = np.zeros(len(held), np.int64), np.full(len(held), len(held))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        length, low, high = held[0][:3]
        for i, j in near_pairs(words, [begins[k] for k in home], length, low, high):
            total += np.bincount(i, minlength=len(held))
            np.minimum.at(first, i, rank[j])
            longer = sizes[j] > length
            total += np.bincount(j[longer], minlength=len(held))
            np.minimum.at(first, j[longer], rank[i[longer]])
        found = np.flatnonzero(total).tolist()
        forms = [best[first[k]] for k in found]
        columns = [words[k] for k in found], total[found].tolist(), [words[k] for k in forms], n[forms].tolist() if forms else []
        kinds = pa.string(), pa.int64(), pa.string(), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n_near", "near", "near_n"])

    # Whole buckets of one length and range of positions go together, up to CHUNK letters.
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("m", "low", "high", "key", "word", "n"))):
            if held and (row[:3] != held[-1][:3] or (row[3] != held[-1][3] and letters > CHUNK)):
                yield from out()
                held, letters = [], 0
            held.append(row)
            letters += row[0] + 1
    if held:
        yield from out()


def _dealt(words: DataFrame) -> DataFrame:
    """``words`` (m, low, high, word, n) in two rows each: for both halves of the range of positions.

    The key is what the words share that differ in the half: the letters before it, and the
    m - high letters that a change at its last position leaves behind it.
    """
    middle = F.expr("cast((low + high) div 2 as int)")
    halves = F.array(F.struct(F.col("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high")))
    rows = words.withColumn("half", F.explode(halves)).filter("half.low < half.high")
    key = F.concat_ws(":", F.col("m"), F.col("half.low"), F.expr("left(word, half.low)"), F.expr("right(word, greatest(m - half.high, 0))"))
    return rows.select("m", F.col("half.low").alias("low"), F.col("half.high").alias("high"), key.alias("key"), "word", "n")


def _buckets(scratch: Scratch, words: DataFrame) -> DataFrame:
    """Words in buckets of at most BUCKET words, or of one position, where there is something to compare."""
    length = F.length("word")
    sides = F.array_compact(F.array(length, F.when(length > LEAST_LETTERS, length - 1)))
    level = words.select(F.explode(sides).alias("m"), F.lit(0).alias("low"), "word", "n").withColumn("high", F.col("m") + 1)
    done = None
    while True:
        level = scratch.table(_dealt(level))
        sizes = level.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.count_if(F.length("word") == F.col("m")).alias("short"))
        # A bucket holds something to find if it has two words, one of them of the shorter length.
        sizes = scratch.table(sizes.filter("size > 1 and short > 0").select("key", "size"))
        held = level.join(sizes, "key")
        splits = (F.col("size") > BUCKET) & (F.col("high") - F.col("low") > 1)
        ready = held.filter(~splits).drop("size")
        done = ready if done is None else done.unionByName(ready)
        if sizes.filter(F.col("size") > BUCKET).isEmpty():
            return done
        level = held.filter(splits).select("m", "low", "high", "word", "n")
        if level.isEmpty():
            return done


def near_words(scratch: Scratch, words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n): of ``words`` (word, n) that have near words, how many, and the most frequent."""
    dealt = _buckets(scratch, words).repartition("key").sortWithinPartitions("m", "low", "high", "key")
    parts = map_batches(dealt.select("m", "low", "high", "key", "word", "n"), _summed, "word string, n_near long, near string, near_n long")
    order = F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))
    best = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(order).alias("best"))
    return best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.n")).alias("near_n"))


def _rooted(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): where following the forms ends; each step doubles."""
    now = scratch.table(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = scratch.table(now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        scratch.drop(now)
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        now = after.drop("moved")
        now.scratch_path = after.scratch_path


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n).

    Two words are near if one inserted, deleted or replaced code point makes one of the other. A
    word's form is its near word of largest n (of equals the first in code-point order) if that n
    is at least RATIO times its own, else null; its root is where following forms ends, the word
    itself without one.

    Edge cases: rows with a null word or n take no part; words of fewer than LEAST_LETTERS code
    points are near to nothing; rows that repeat a word count as one with their n added up; an
    empty table gives an empty one; words may be of any length. Other columns are not read.
    """
    scratch = Scratch(words.sparkSession, "spelling")
    own = scratch.table(words.filter("word is not null and n is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n")))
    found = near_words(scratch, own.filter(F.length("word") >= LEAST_LETTERS))
    joined = own.join(found, "word", "left")
    taken = F.col("near_n") >= RATIO * F.col("n")
    told = scratch.table(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("near")).alias("form"), F.when(taken, F.col("near_n")).alias("form_n"))
    )
    roots = _rooted(scratch, told.filter("form is not null"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", noise: int | None = 97) -> DataFrame:
    """``variants`` of the words of ``docs``; see ``word_counts`` for what counts as a word."""
    return variants(word_counts(docs, key, text, noise))
