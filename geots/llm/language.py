"""Language identification by hyperdimensional profiles.

Every letter has a random vector of plus and minus ones. An n-gram is bound from its letters'
vectors, each permuted (rolled) by its place, by multiplying them; a text is the bundle (the sum)
of its n-grams' vectors. A language's prototype bundles the texts of its sample, each at unit
length. A text's language is the prototype of the largest cosine with it. What all prototypes
share tells languages apart as little as it does texts, so their mean is taken from both sides.

Vectors come from code points by a hash, so that every task makes the same ones and none is sent.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, with_columns

DIM = 2048  # components of a vector
GRAM = 3  # letters of an n-gram
SAMPLE = 20_000  # texts a language, about, that are learnt
LANGUAGES = 1000  # the commonest values of the column that are learnt
UNKNOWN = "und"
FIXED = 1 << 20  # steps of a unit in prototypes' sums, which are whole numbers and the same in any order
GRAMS = 8192  # n-grams whose vectors a worker remembers
TOGETHER = 64  # texts that are bundled at once
STRETCH = 1 << 20  # characters of a text that are looked at together

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@functools.cache
def _is_letter() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letter_vector(code: int) -> np.ndarray:
    """A letter's vector of plus and minus ones."""
    with np.errstate(over="ignore"):
        h = (np.uint64(code + 1) * np.uint64(DIM) + np.arange(DIM // 64, dtype=np.uint64)) * _STEP
        h = (h ^ (h >> np.uint64(30))) * _MIX
        h = (h ^ (h >> np.uint64(27))) * _STEP
    bits = np.unpackbits((h ^ (h >> np.uint64(31))).view(np.uint8))
    return bits.astype(np.int8) * 2 - 1


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, one row of code points each, and how often each occurs.

    Letters are lower-cased; what stands between words is one blank (0), as are the text's ends.
    """
    rows = counts = None
    for at in range(0, max(1, len(text)), STRETCH):
        part = text[at : at + STRETCH].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(codes):
            continue
        letters = np.where(_is_letter()[codes], codes, 0)
        if not letters.any():
            continue
        letters = np.concatenate(([0], letters, [0])).astype(np.uint64)
        letters = letters[np.concatenate(([True], (letters[1:] != 0) | (letters[:-1] != 0)))]
        keys = np.zeros(max(0, len(letters) - GRAM + 1), np.uint64)
        for k in range(GRAM):
            keys = (keys << np.uint64(21)) | letters[k : k + len(keys)]
        own, n = np.unique(keys, return_counts=True)
        if rows is None:
            rows, counts = own, n
        else:
            every = np.concatenate((rows, own))
            rows, back = np.unique(every, return_inverse=True)
            counts = np.bincount(back, np.concatenate((counts, n))).astype(np.int64)
    if rows is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return rows, counts


class Encoder:
    """Unit vectors of texts; a worker remembers the vectors of letters and of some n-grams."""

    def __init__(self):
        self.letters: dict[int, np.ndarray] = {}
        self.place: dict[int, int] = {}
        self.known = np.empty((GRAMS, DIM), np.int8)

    def _bound(self, keys: list[int]) -> np.ndarray:
        """Vectors of n-grams: the product of their letters' vectors, each rolled by its place."""
        mask = (1 << 21) - 1
        if len(self.letters) > 4096:
            self.letters.clear()
        out = np.ones((len(keys), DIM), np.int8)
        for k in range(GRAM):
            roll = GRAM - 1 - k
            for row, key in enumerate(keys):
                code = (key >> (21 * roll)) & mask
                if code not in self.letters:
                    own = letter_vector(code)
                    self.letters[code] = np.stack([np.roll(own, r) for r in range(GRAM)])
                out[row] *= self.letters[code][roll]
        return out

    def _vectors(self, keys: list[int]) -> np.ndarray:
        """Vectors of at most GRAMS n-grams, new ones bound."""
        fresh = [k for k in keys if k not in self.place]
        if len(self.place) + len(fresh) > GRAMS:
            self.place.clear()
            fresh = keys
        if fresh:
            begin = len(self.place)
            self.known[begin : begin + len(fresh)] = self._bound(fresh)
            self.place.update(zip(fresh, range(begin, begin + len(fresh))))
        return self.known[[self.place[k] for k in keys]].astype(np.float32)

    def bundles(self, texts: list[str | None]) -> Iterator[np.ndarray | None]:
        """Each text's bundle at unit length; None without a letter.

        Some texts go together, as a matrix of counts times the matrix of their n-grams' vectors.
        """
        for at in range(0, len(texts), TOGETHER):
            found = [grams(t or "") for t in texts[at : at + TOGETHER]]
            owner = np.repeat(np.arange(len(found)), [len(k) for k, _ in found])
            counts = np.concatenate([n for _, n in found])
            keys, place = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            total = np.zeros((len(found), DIM), np.float32)
            for low in range(0, len(keys), GRAMS // 2):
                part = keys[low : low + GRAMS // 2].tolist()
                own = (place >= low) & (place < low + len(part))
                dense = np.zeros((len(found), len(part)), np.float32)
                dense[owner[own], place[own] - low] = counts[own]
                total += dense @ self._vectors(part)
            for row, (k, _) in zip(_unit(total), found):
                yield row if len(k) else None


@dataclass(frozen=True)
class Profiles:
    """Languages in order, their prototypes less the mean, at unit length, and that mean."""

    languages: tuple[str, ...]
    prototypes: np.ndarray
    mean: np.ndarray


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sum of its texts' vectors for each language, in whole numbers."""
    encoder, sums = Encoder(), {}
    for batch in batches:
        for language, own in zip(batch.column("language").to_pylist(), encoder.bundles(batch.column("text").to_pylist())):
            if own is not None:
                sums[language] = sums.get(language, 0) + np.rint(own.astype(np.float64) * FIXED).astype(np.int64)
    kinds = pa.string(), pa.list_(pa.int64())
    columns = list(sums), list(sums.values())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["language", "bundle"])


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, languages: int = LANGUAGES) -> Profiles:
    """Prototypes of the languages that ``docs`` names.

    Of each of the ``languages`` commonest values (of equals the first in order) about ``sample``
    texts are learnt, chosen by a hash of key and text, all if there are fewer. Rows with a null
    language or text teach nothing, nor do texts without a letter.
    """
    known = docs.select(F.col(lang).alias("language"), F.col(key).alias("k"), F.col(text).alias("text")).filter("language is not null and text is not null")
    commonest = known.groupBy("language").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "language").limit(languages)
    space = 1 << 30
    share = commonest.select("language", F.least(F.lit(float(space)), F.lit(float(space * sample)) / F.col("n")).alias("share"))
    # At most ``languages`` rows of two values: a proven bound.
    chosen = known.join(F.broadcast(share), "language").filter(F.pmod(F.xxhash64("k", "text", F.lit("language")), F.lit(space)) < F.col("share"))
    parts = map_batches(chosen.select("language", "text"), _bundles, "language string, bundle array<bigint>")
    sums = parts.select("language", F.posexplode("bundle").alias("place", "s")).groupBy("language", "place").agg(F.sum("s").alias("s"))
    # One vector a language, of which there are at most ``languages``.
    rows = sums.groupBy("language").agg(F.sort_array(F.collect_list(F.struct("place", "s"))).alias("bundle")).orderBy("language")
    found = rows.select("language", "bundle.s").collect()
    prototypes = np.array([r["s"] for r in found], np.float64).reshape(-1, DIM)
    prototypes = _unit(prototypes)
    mean = prototypes.mean(0) if len(found) > 1 else np.zeros(DIM)
    return Profiles(tuple(r["language"] for r in found), _unit(prototypes - mean).astype(np.float32), mean.astype(np.float32))


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=-1, keepdims=True)
    return rows / np.where(length > 0, length, 1.0)


def predict(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine of the text with that prototype, 0 if negative.

    Edge cases: a text that is null, empty or without a letter is ``und`` with score 0, and so is
    every text if nothing was learnt; of equal cosines the first language in order wins; repeated
    rows get the same; existing columns of these names are replaced; an empty table gives an empty
    one. A text of any length is read whole, a stretch at a time.
    """
    docs = docs.drop("lang_pred", "score")
    schema = with_columns(docs, ("lang_pred", T.StringType()), ("score", T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            named, scores = [], []
            for own in encoder.bundles(batch.column(text).to_pylist()):
                if own is None or not profiles.languages:
                    named.append(UNKNOWN), scores.append(0.0)
                    continue
                cosines = profiles.prototypes @ _unit(own - profiles.mean)
                best = int(cosines.argmax())
                named.append(profiles.languages[best]), scores.append(min(1.0, max(0.0, float(cosines[best]))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(named, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    return map_batches(docs, run, schema)
