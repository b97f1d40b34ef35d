"""Toxic passages by maximum-scoring segments over token log-odds.

Features of words (the word, its beginnings and endings) get log-odds between toxic and clean
training texts under an informative Dirichlet prior; those that stand out make the lexicon. A
text is then scanned in linear time for all maximal segments of the sum of word scores, where a
lexicon word adds its log-odds and any other word takes a small drift away. Under the clean
texts' distribution the best segment's score has an extreme-value law with expectation
E = K n exp(-S) for n words; K is estimated from the clean training texts. A segment with a small
E is a significant passage, and a text's score is a logistic function of its best E and of the
sum over its segments.

Fitted is a bounded sample of labelled rows; every text is scored whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, with_columns

SAMPLE = 30_000  # labelled rows that are fitted, chosen by a hash of their key
LEXICON = 50_000  # features of a model at most, those that stand out most
PRIOR = 0.1  # weight of the Dirichlet prior, as a share of all counts
Z, ODDS = 3.5, 1.5  # a lexicon feature's least z-score and log-odds
EDGES = range(3, 7)  # lengths of a word's beginnings and endings that are features
SIGNIFICANT = 0.05  # a passage's largest E

WORD = re.compile(r"[^\W_]+")
PASSAGE = T.StructType(
    [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("e", T.DoubleType())]
)


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]  # feature -> log-odds
    drift: float  # what another word takes away
    k: float  # of the extreme-value law
    weights: tuple[float, float, float]  # logistic: constant, evidence, sum


def features(word: str) -> list[str]:
    """The word, its beginnings and its endings, marked as such."""
    low = word.lower()
    return ["=" + low, *("^" + low[:n] for n in EDGES if n < len(low)), *(low[-n:] + "$" for n in EDGES if n < len(low))]


class Scores(dict):
    """Word -> score, 0.0 outside the lexicon; remembers words within a bound."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) > 400_000:
            self.clear()
        self[word] = value = max((self.lexicon.get(f, 0.0) for f in features(word)), default=0.0)
        return value


def segments(values: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, last word + 1, score), in linear time.

    A segment is maximal if no longer one around it and no part of it scores more. ``values``
    are the words' scores; a word with 0 takes ``drift`` away.
    """
    stack: list[list] = []  # first, end, sum before the segment, sum after it
    total, last = 0.0, -1
    for at, value in enumerate(values):
        if not value:
            continue
        total -= drift * (at - last - 1)
        first, end, before, total = at, at + 1, total, total + value
        last = at
        after = total
        while True:
            # Segments whose sum before is not below ours cannot begin a longer one with us.
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j -= 1
            if j < 0 or stack[j][3] >= after:
                break
            first, before = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append([first, end, before, after])
    return [(a, b, y - x) for a, b, x, y in stack]


def _signature(words: list[str]) -> bytes:
    """128-bit hash of a text's sorted words: only texts of the same words share it."""
    return xxhash.xxh3_128_digest("\n".join(words).encode())


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int) -> DataFrame:
    chosen = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("k"), "k", F.desc("y"))
        .limit(sample)
    )
    chosen = chosen.groupBy("k").agg(F.max("y").alias("y"))
    # At most ``sample`` rows of two numbers: a proven bound.
    return docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(chosen), "k").select("y", "t")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from the texts of ``docs`` that ``labels`` (key, label 0 or 1) marks.

    Rows with a null or another label take no part; a key with several labels counts as toxic if
    one of them is. Texts of the same distinct words count once. Without toxic or without
    clean rows the lexicon is empty and every text gets the share of toxic rows as its score.
    """
    rows = _sample(docs, labels, key, text, label, sample)

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for y, t in zip(batch.column("y").to_pylist(), batch.column("t").to_pylist()):
                words = sorted({w.lower() for w in WORD.findall(t)})
                if words:
                    out.append((y, _signature(words), words))
            columns = list(zip(*out)) if out else ((), (), ())
            kinds = (pa.int32(), pa.binary(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["y", "words_id", "words"])

    # Rows of one hash hold the same words, so it does not matter which of them stays.
    texts = map_batches(rows, distinct_words, "y int, words_id binary, words array<string>").dropDuplicates(["y", "words_id"])
    words = texts.select("y", F.explode("words").alias("word")).groupBy("word").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    named = [
        F.concat(F.lit("="), "word"),
        *(F.when(F.length("word") > n, F.concat(F.lit("^"), F.substring("word", 1, n))) for n in EDGES),
        *(F.when(F.length("word") > n, F.concat(F.expr(f"right(word, {n})"), F.lit("$"))) for n in EDGES),
    ]
    counts = (
        words.select(F.explode(F.array_compact(F.array(*named))).alias("feature"), "a", "b")
        .groupBy("feature")
        .agg(F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b"))
    )
    totals = words.agg(F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    big_a, big_b = float(totals[0]), float(totals[1])
    lexicon: dict[str, float] = {}
    if big_a and big_b:
        prior, whole = PRIOR * (F.col("a") + F.col("b")), PRIOR * (big_a + big_b)

        def log_odds(n, of: float):
            return F.log((n + prior) / (of + whole - n - prior))

        delta = log_odds(F.col("a"), big_a) - log_odds(F.col("b"), big_b)
        z = delta / F.sqrt(1 / (F.col("a") + prior) + 1 / (F.col("b") + prior))
        best = counts.select("feature", "a", "b", delta.alias("delta"), z.alias("z")).filter((F.col("z") >= Z) & (F.col("delta") >= ODDS))
        best = best.orderBy(F.desc("z"), "feature").limit(LEXICON).collect()
        lexicon = {r["feature"]: r["delta"] for r in best}
    return _calibrated(rows, lexicon)


def _calibrated(rows: DataFrame, lexicon: dict[str, float]) -> Model:
    """Drift, extreme-value constant and logistic weights from the sample, for a given lexicon."""

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Scores(lexicon)
        for batch in batches:
            out = []
            for y, t in zip(batch.column("y").to_pylist(), batch.column("t").to_pylist()):
                values = list(map(known.__getitem__, WORD.findall(t)))
                out.append((y, len(values), sum(1 for v in values if v)))
            columns = list(zip(*out)) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["y", "n", "hits"])

    by_label = {r["y"]: r for r in map_batches(rows, hits, "y long, n long, hits long").groupBy("y").agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.sum(F.least("hits", F.lit(1))).alias("hit")).collect()}
    none = {"d": 0, "n": 0, "hits": 0, "hit": 0}
    toxic, clean = by_label.get(1, none), by_label.get(0, none)
    share = (toxic["d"] + 0.5) / (toxic["d"] + clean["d"] + 2)
    if not lexicon:
        return Model({}, 0.0, 1.0, (math.log(share / (1 - share)), 0.0, 0.0))
    inside, outside = ((r["hits"] + 0.5) / (r["n"] + 1) for r in (toxic, clean))
    drift = max(1e-3, -math.log((1 - inside) / (1 - outside)))
    k = (clean["hit"] + 0.5) / ((clean["n"] + 1) * math.exp(-min(lexicon.values())))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Scores(lexicon)
        for batch in batches:
            out = []
            for y, t in zip(batch.column("y").to_pylist(), batch.column("t").to_pylist()):
                values = list(map(known.__getitem__, WORD.findall(t)))
                found = segments(values, drift)
                out.append((float(y), *evidence(found, len(values), k)))
            columns = list(zip(*out)) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in columns], names=["y", "x1", "x2"])

    # Three numbers for each row of the bounded sample.
    points = np.array(map_batches(rows, best, "y double, x1 double, x2 double").collect(), float).reshape(-1, 3)
    return Model(lexicon, drift, k, _logistic(points[:, 1:], points[:, 0]))


def evidence(found: list[tuple[int, int, float]], n: int, k: float) -> tuple[float, float]:
    """-log E of the best segment, within bounds, and the logarithm of the segments' sum."""
    top = max((s for _, _, s in found), default=0.0)
    return max(-5.0, min(40.0, top - math.log(k * max(n, 1)))) / 10, math.log1p(sum(s for _, _, s in found))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + 1e-2 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``passages``.

    ``passages`` are the significant toxic passages of the whole text: start and end in code
    points, score and expectation. Edge cases: a null or empty text has no words and no passage,
    and scores what a text without evidence does; repeated rows score alike; existing columns of
    these names are replaced; an empty table gives an empty one.
    """
    docs = docs.drop("score", "predicted", "passages")
    schema = with_columns(docs, ("score", T.DoubleType()), ("passages", T.ArrayType(PASSAGE)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Scores(model.lexicon)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e", pa.float64())]))
        w0, w1, w2 = model.weights
        for batch in batches:
            scores, passages = [], []
            for t in batch.column(text).to_pylist():
                t = t or ""
                values = list(map(known.__getitem__, WORD.findall(t)))
                found = segments(values, model.drift) if any(values) else []
                x1, x2 = evidence(found, len(values), model.k)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, w0 + w1 * x1 + w2 * x2)))))
                expected = [(a, b, s, model.k * len(values) * math.exp(-s)) for a, b, s in found]
                told = [x for x in expected if x[3] <= SIGNIFICANT]
                spans = [m.span() for m in WORD.finditer(t)] if told else []
                passages.append([{"start": spans[a][0], "end": spans[b - 1][1], "score": s, "e": e} for a, b, s, e in told])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(passages, kind)], names=[*batch.schema.names, "score", "passages"])

    return map_batches(docs, run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
