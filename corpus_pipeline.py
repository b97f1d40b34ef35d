"""A training-data pipeline over the table of documents, one operator a stage.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before it kept.
All but the last return the columns of the documents table; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geots.llm import line_dedup, near_dedup, packing, secret_scan, toxicity
from geots.llm.common import Scratch, table
from geots.llm.queries import held_out

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of the documents table, with the number of characters of the present text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go.

    Null and empty texts score what a text without evidence does, and stay; a null key is scored
    like any other; repeated rows stay or go together; without labels of both kinds, and from an
    empty table, nothing goes. Only ``COLUMNS`` are handed on.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    return toxicity.score(docs, model).filter("predicted = 0").select(*COLUMNS)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three repeated lines go; a document that loses all its text goes.

    Null and empty texts, and rows with a null key, stay as they are; rows that repeat key and
    text are cut alike; rows that repeat a key with another text are documents of their own; an
    empty table gives an empty one.
    """
    cut = line_dedup.dedup_lines(docs)
    return _documents(cut.filter((F.col("lines_removed") == 0) | (F.trim("text") != "")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Texts without words (null and empty ones too) and rows with a null key stay; rows that repeat
    key and text stay or go together; of rows that repeat a key with other texts each goes only
    for its own text; an empty table gives an empty one.
    """
    groups = near_dedup.near_duplicates(docs, percent=80)
    gone = groups.filter("not kept").select("doc_id", "text_hash").distinct()
    hashed = docs.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    return hashed.join(gone.hint("merge"), ["doc_id", "text_hash"], "left_anti").select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts become a mark; no document goes.

    Null texts stay null, and rows with a null key and repeated rows are treated as any other.
    """
    return _documents(secret_scan.redact_secrets(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences.

    A null or empty text is the end token alone; repeated rows are packed each for itself; a null
    key stays null; an empty table gives no piece.
    """
    # The workers serve all stages, so that the words of this one are not kept.
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remember=False)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_lines),
    ("near_dedup", drop_near_copies),
    ("secrets", redact),
    ("packing", pack),
]

#: Scores of a fitted model and components of a graph are not SQL's to compute; tests compare the
#: stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table; each stage's rows are a table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, scratch.table(stage(spark, docs, sf_dir))
        if k:  # what the stage has read is its own table, written and done with
            scratch.drop(before)
    return docs
