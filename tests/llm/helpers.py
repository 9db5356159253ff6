"""Shared rows and brute-force pieces for the tests of the llm operators."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside; a table may hold them as extra columns.
CLASHING = ["row_no", "id", "kept", "llm_row_no", "LLM_Score", "llm_shard", "size", "label", "rep"]


def edge_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows, null and repeated ids."""
    long = " ".join(f"word{i % 997} and{i % 13}," for i in range(30_000))
    return [(1, "The cat sat on the mat today, and the dog ran off.", "en", "a", 10), (2, None, "en", "a", None),
            (3, "", None, "b", 0), (4, " \t\n\x0b\x0c\r ", "de", None, 7), (5, "The cat sat on\tthe mat today,\nand the dog ran off.", None, None, 10),
            (6, "The  cat sat on the mat today, and the dog ran off.", "en", "a", 11), (6, "The  cat sat on the mat today, and the dog ran off.", "en", "a", 11),
            (None, "no id here", "en", "b", 3), (None, None, None, None, None), (8, "one", "fr", "b", 1), (9, "two words", "fr", "b", 2), (9_007_199_254_740_993, "an id that no float holds", "fr", "b", 2),
            (10, long, "en", "c", len(long)), (11, long + " end", "en", "c", len(long) + 4), (12, "é x́ 汉字 😀 ßtraße ÄÖÜ", "de", "c", 20),
            (13, "aaaa " * 300, "en", "a", 1500), (14, "WARC/1.1\r\nContent-Length: 5\r\n\r\nab", "en", "a", 30)]


def edge_docs(spark, clash=True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    return df.withColumns({c: F.lit("extra") for c in CLASHING}) if clash else df


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def random_docs(spark, texts, partitions=3):
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randint(1, vocabulary)}" for _ in range(n))


def stored(df):
    from idweave.llm.common import store
    return store(df, "test")
