"""The registered queries of this subpackage: each operator over its whole table, and the pipeline.

``SQL`` holds the DuckDB twin of the queries that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, table
from .exact_dedup import exact_dedup
from .mixing import mixed_sizes
from .ngram_join import ngram_join
from .outliers import BASE, robust_outliers
from .packing import packed_documents
from .phrases import collocations
from .quality import THRESHOLD, fit_quality, held_out, scored
from .shards import shard_report
from .suffix_dedup import suffix_dedup
from .token_count import token_counts
from .token_output import matrix_report, packed_matrix
from .warc import archive_report, read_warc, write_warc
from .whitening import whitened_vectors


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk-recipe exact deduplication of all documents: which row of each group of equal texts stays."""
    return exact_dedup(table(spark, sf_dir, "documents")).selectExpr(
        "id AS doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes that strings of 200 bytes found twice or more cover."""
    return suffix_dedup(table(spark, sf_dir, "documents")).selectExpr(
        "id AS doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids packed best fit decreasing into a written matrix of 4096 ids a row, and read back."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return matrix_report(packed_matrix(table(spark, sf_dir, "documents"), path, 49_408))


def op4_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust multivariate outliers per language and source, over all documents."""
    return robust_outliers(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), *BASE, "base_failed", "kept")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compression classifier over all documents, learned from a bounded sample of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count-only Viterbi over all documents with the 32k piece vocabulary."""
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")).withColumnRenamed(
        "id", "doc_id")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PartEnum join of all documents' 3-word shingle sets at a Jaccard similarity of 0.9."""
    return ngram_join(table(spark, sf_dir, "documents")).selectExpr("id AS doc_id", "n_shingles", "component_id")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splitting-tree mixture of all documents: words of each document that the mix takes."""
    return mixed_sizes(table(spark, sf_dir, "documents")).selectExpr(
        "id AS doc_id", "size", "source_size", "target", "taken")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-two-fit packing of all documents' tokens into sequences of 4096."""
    return packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed(
        "id", "doc_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records (repeats as revisits, long ones in segments) and read back."""
    path = scratch(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return archive_report(read_warc(spark, path))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the four leading components of the distinct vectors, whitened; null deviation beyond 64 bits."""
    return whitened_vectors(table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "whitened",
        "explained", "identity_error")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of two and three words of each language, over all documents."""
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into 16 written shards of equal row counts, read back."""
    return shard_report(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline`` over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_token_matrix": op3_token_matrix,
    "op4_quality_outliers": op4_quality_outliers,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_token_counts": op6_token_counts,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_source_mixing": op8_source_mixing,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_warc": op10_warc,
    "op11_whitening": op11_whitening,
    "op12_collocations": op12_collocations,
    "op13_sharding": op13_sharding,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {
    "op1_exact_dedup": r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
     r AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
                  count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r
""",
    "op12_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, w, size, unnest(range(1, CAST(len(w) AS BIGINT) - size + 2)) AS i FROM lists, (VALUES (1), (2), (3)) s(size)),
f AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS f
      FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
cuts AS (SELECT lang, size, phrase, a, unnest(range(1, size)) AS k, w FROM cand),
scored AS (SELECT c.lang, c.size, c.phrase, c.a, c.k, x.f AS l, y.f AS r, (1000000 * c.a * c.a) // (x.f * y.f) AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
                       JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.size], ' ')),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, phrase, max(a) AS a FROM (
               SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cand WHERE size = 3
               UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE size = 3) GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN longer g ON g.lang = low.lang AND g.phrase = low.phrase
         WHERE g.a IS NULL OR 100 * g.a < 50 * low.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, CAST(r.a AS BIGINT) AS a, CAST(r.l AS BIGINT) AS l, CAST(r.r AS BIGINT) AS r,
       CAST(t.n AS BIGINT) AS n, CAST(r.score AS BIGINT) AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
""",
    "op10_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
     r AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY body) ELSE page_id END AS held
           FROM p)
SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN held = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN held <> page_id THEN held END AS refers_to, true AS ok
FROM r
""",
}
