"""The registered queries opN_<name> of this subpackage and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import bpe, html_extract, language, line_dedup, matroska, near_dedup, packing, secret_scan, spelling, token_counts, topk, toxicity, whitening
from .common import table


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all others."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    return topk.top_k(rows, rows.filter(F.col("vec_id") % 50 == 0), k=5)


OP1_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.c, v.c) AS BIGINT) AS score
      FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(v.c) = len(q.c)),
r AS (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""


def held_out(key: str = "doc_id"):
    """A fifth of the documents, by a checksum of their id: no label of theirs is learnt."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted", F.size("passages").cast("long").alias("n_passages")
    )


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of 2048 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text stored as a Matroska file and read back."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    stored = matroska.read(matroska.store(docs).drop("text"))
    return stored.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingles are 0.85 alike."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with later occurrences of repeated three-line windows cut."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "text", "lines_total", "lines_removed")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS a FROM documents),
w AS (SELECT doc_id, a, unnest(generate_series(0, len(a) - 3)) AS i FROM d WHERE len(a) >= 3),
k AS (SELECT doc_id, i, a[i + 1] || chr(10) || a[i + 2] || chr(10) || a[i + 3] AS win FROM w),
o AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth
      FROM k WHERE regexp_matches(win, '\S')),
c AS (SELECT doc_id, list(DISTINCT i + j) AS cut FROM o, (SELECT unnest([0, 1, 2]) AS j) WHERE nth > 1 GROUP BY doc_id)
SELECT d.doc_id,
       CASE WHEN c.cut IS NULL THEN d.text
            ELSE coalesce(array_to_string(list_filter(d.a, lambda x, n: NOT list_contains(c.cut, n - 1)), chr(10)), '') END AS text,
       CAST(coalesce(len(d.a), 0) AS BIGINT) AS lines_total,
       CAST(coalesce(len(c.cut), 0) AS BIGINT) AS lines_removed
FROM d LEFT JOIN c USING (doc_id)
"""


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document, with counts and a digest of the base kinds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = secret_scan.BASE + secret_scan.EXTRA
    found = secret_scan.find_secrets(docs, rules=rules)

    def number(i: int, name: str):
        return F.size(F.filter("found", lambda s: s["ord"] == i)).cast("long").alias(name)

    return found.select(
        "doc_id",
        number(0, "n_assign"),
        number(1, "n_access"),
        number(2, "n_hex"),
        F.sha2(secret_scan.spans_text(F.col("found"), rules, secret_scan.BASE), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("found"), rules).alias("spans"),
    )


def _op10_sql() -> str:
    rules = secret_scan.BASE + secret_scan.EXTRA
    parts = []
    for i, r in enumerate(rules):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""
SELECT doc_id, {i} AS ord, '{r.kind}' AS kind, p + list_sum(list_transform(g[1:n], lambda x: length(x))) AS s,
       length(m[n]) AS l, length(regexp_extract(m[n], '{pattern}', {r.value})) AS v, {r.least} AS least
FROM (SELECT doc_id, m, g, n, coalesce(list_sum(list_transform(m[1:n - 1], lambda x: length(x))), 0) AS p
      FROM (SELECT doc_id, m, g, unnest(generate_series(1, len(m))) AS n
            FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') AS m,
                         string_split_regex(coalesce(text, ''), '{pattern}') AS g FROM documents)))""")
    return f"""
WITH every AS ({" UNION ALL ".join(parts)}),
kept AS (SELECT doc_id, ord, CAST(s AS BIGINT) AS s, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + l AS BIGINT) AS t FROM every WHERE v >= least),
g AS (SELECT doc_id, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
             string_agg(t, ',' ORDER BY s, ord) FILTER (ord < 3) AS base, string_agg(t, ',' ORDER BY s, ord) AS spans FROM kept GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN g USING (doc_id)
"""


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with the variant that each is taken for."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the four leading components of all distinct vectors."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    return whitening.whiten(rows).withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    bucket = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    profiles = language.fit(docs.filter(bucket != 2))
    told = language.predict(docs.select("doc_id", "text"), profiles)
    return told.select("doc_id", F.coalesce(bucket == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES = {
    "op1_top_k": op1_top_k,
    "op2_toxicity": op2_toxicity,
    "op3_html_text": op3_html_text,
    "op4_bpe": op4_bpe,
    "op5_packing": op5_packing,
    "op6_token_counts": op6_token_counts,
    "op7_matroska": op7_matroska,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_line_dedup": op9_line_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_whitening": op12_whitening,
    "op13_language_id": op13_language_id,
}
ORACLE_SQL = {
    "op1_top_k": OP1_SQL,
    "op9_line_dedup": OP9_SQL,
    "op10_secret_scan": _op10_sql(),
}
