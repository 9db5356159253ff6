"""A training corpus from ``documents``: quality, exact and near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before kept; ``docs`` is a table that was written and read again. All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from idweave.llm.common import keep_rows, store, table
from idweave.llm.exact_dedup import exact_dedup
from idweave.llm.mixing import mixture
from idweave.llm.ngram_join import ngram_join
from idweave.llm.packing import packed_documents
from idweave.llm.quality import fit_quality, good_documents


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts."""
    return good_documents(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_rows(docs, exact_dedup(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle sets of a similarity of 0.8 or more."""
    return keep_rows(docs, ngram_join(docs, words=5, num=80, den=100))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture draws; one drawn twice is there twice."""
    return mixture(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in a sequence."""
    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


STAGES = [("quality_classifier", quality_classifier), ("exact_dedup", exact_duplicates),
          ("ngram_jaccard", near_duplicates), ("source_mixing", source_mixing), ("best_fit_packing", best_fit_packing)]

#: SQL cannot express the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
