"""Line deduplication with overlapping three-line windows, in DataFrame operations only.

Every run of three consecutive lines of a document is a window. Windows are hashed and
grouped over the whole corpus; the first occurrence of each (by document id, then by line)
stays, and every later occurrence marks its three lines. Marked lines go, so overlapping
occurrences merge into longer cut passages.

Only hashes are shuffled to find the repeats; texts move once, to meet their own cut lines.
A window that a large part of the corpus shares is one row after the map-side aggregation,
and the join that brings its first occurrence back is an ordinary sort-merge join that
adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

WINDOW = 3


def _windows(lines: Column) -> Column:
    """Positions and 128-bit hashes of the windows that hold a character other than blanks."""
    shingles = F.transform(
        F.sequence(F.lit(0), F.size(lines) - F.lit(WINDOW)),
        lambda i: F.struct(
            i.alias("at"),
            F.xxhash64(*(lines[i + k] for k in range(WINDOW))).alias("h1"),
            F.xxhash64(F.lit("second"), *(lines[i + k] for k in range(WINDOW))).alias("h2"),
            F.concat(*(lines[i + k] for k in range(WINDOW))).rlike(r"\S").alias("inked"),
        ),
    )
    return F.when(F.size(lines) >= WINDOW, F.filter(shingles, lambda w: w["inked"]))


def _identity(key: str, text: str) -> list[Column]:
    """A document: its key and the hash of its text (rows that repeat both are the same document)."""
    return [F.col(key).alias("k"), F.xxhash64(F.col(text)).alias("r")]


def repeated_lines(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, r, cut): for each document with later occurrences, the sorted positions of its cut lines.

    Rows with a null key take no part: they have no place in the order of occurrences.
    """
    windows = scratch.table(
        docs.filter(F.col(key).isNotNull() & F.col(text).isNotNull())
        .select(*_identity(key, text), F.split(text, "\n").alias("lines"))
        .select("k", "r", F.explode(_windows(F.col("lines"))).alias("w"))
        .select("k", "r", "w.at", "w.h1", "w.h2")
    )
    place = F.struct("k", "r", "at")
    first = scratch.table(
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first <> last")
        .select("h1", "h2", "first")
    )
    later = windows.join(first, ["h1", "h2"]).filter(place != F.col("first"))
    covered = later.select("k", "r", F.explode(F.array(*(F.col("at") + k for k in range(WINDOW)))).alias("line"))
    cut = scratch.table(covered.groupBy("k", "r").agg(F.sort_array(F.collect_set("line")).alias("cut")))
    scratch.drop(windows, first)
    return cut


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with later occurrences of repeated three-line windows removed from ``text``.

    All other columns stay as they are, and no row goes: a document that loses every line
    keeps an empty text. Two columns are added, ``lines_total`` and ``lines_removed``
    (an existing column of that name is replaced).

    Edge cases: a null text stays null (0 lines); an empty text is one empty line; texts under
    three lines have no window and stay; windows of blank lines alone never count; a row with a
    null key is kept unchanged; rows that repeat key and text are one document and are cut
    alike; rows that repeat a key with another text are documents of their own, ordered by the
    text's hash; an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    cut = repeated_lines(docs, scratch, key, text).toDF("__k", "__r", "__cut")
    # A merge join at every size: the table of cut lines grows with the corpus.
    cut = cut.hint("merge")
    joined = docs.withColumn("__hash", F.xxhash64(F.col(text))).join(
        cut, (F.col(key) == F.col("__k")) & (F.col("__hash") == F.col("__r")), "left"
    )
    # Split once, into a column: inside the lambda below it would be split for each line.
    split = joined.withColumn("__lines", F.when(F.col("__cut").isNotNull(), F.split(F.col(text), "\n")))
    kept = F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__cut")), lambda i: F.col("__lines")[i]), "\n"
    )
    newlines = F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit("")))
    total = F.coalesce(newlines + 1, F.lit(0)).cast("long")
    removed = F.when(F.col("__cut").isNull(), F.lit(0)).otherwise(F.size("__cut")).cast("long")
    return (
        split.withColumn("lines_total", total)
        .withColumn("lines_removed", removed)
        .withColumn(text, F.when(F.col("__cut").isNull(), F.col(text)).otherwise(kept))
        .drop("__hash", "__k", "__r", "__cut", "__lines")
    )
