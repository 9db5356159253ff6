"""Quality classifier and robust outliers."""

import collections
import random
import re
import zlib

import numpy as np

from idweave.llm.outliers import chi_square, robust_outliers
from idweave.llm.quality import dictionary, fit_quality, good_documents, held_out, scored

from .helpers import edge_docs, edge_rows, empty_docs, prose, random_docs, stored, words

SF = "/root/testdata/sf0.01"


def test_classifier_on_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_quality(docs, labels)
    rows = scored(docs, model).withColumn("out", held_out()).join(labels, "doc_id").select(
        "doc_id", "out", "quality", "quality_score").collect()
    for r in rows:
        assert r.out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.quality_score <= 1
    out = [r for r in rows if r.out and r.quality is not None]
    good = [r.quality_score for r in out if r.quality == 1]
    bad = [r.quality_score for r in out if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean(np.array(good) >= 0.3) > 0.97
    assert np.mean([(r.quality_score - r.quality) ** 2 for r in out]) < 0.06


def test_held_out_labels_do_not_change_the_model(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F
    turned = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert fit_quality(docs, labels) == fit_quality(docs, turned)


def test_classifier_edges(spark):
    docs = stored(edge_docs(spark))
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 0), (8, 0, 0), (8, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    model = fit_quality(docs, labels)  # one class only
    assert model.prior == 1.0 and {r.quality_score for r in scored(docs, model).collect()} == {1.0}
    assert fit_quality(docs, labels.limit(0)).prior == 0.5
    few = fit_quality(docs, spark.createDataFrame([(i, i % 2, 0) for i in range(1, 15)], "doc_id bigint, quality int, toxic int"))
    got = scored(docs, few).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.quality_score <= 1 for r in got)
    empty = [r.quality_score for r in got if not r.text]
    assert len(set(empty)) == 1
    kept = good_documents(docs, few)
    assert kept.columns == docs.columns and kept.count() == sum(r.quality_score >= 0.3 for r in got)
    assert good_documents(empty_docs(spark), few).count() == 0
    assert dictionary([b"tiny"]) == b"tiny"


def base(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    out = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
    return out + (len(w) < 10 or 100 * len(covered) > 20 * len(w),)


def test_base_counts_and_edges(spark):
    docs = stored(edge_docs(spark))
    got = robust_outliers(docs).collect()
    want = collections.Counter((r[0], *base(r[1])) for r in edge_rows())
    have = collections.Counter((r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert have == want
    assert not any(r.kept for r in got if r.base_failed)
    assert robust_outliers(empty_docs(spark)).count() == 0


def test_outliers_are_rejected_and_clean_texts_kept(spark):
    rng = random.Random(8)
    clean = [prose(rng, rng.randint(30, 300)) + ".\n" + prose(rng, 40) + "." for _ in range(240)]
    odd = [" ".join(f"{w}&&&" for w in prose(rng, 80).split()) for _ in range(12)] + [prose(rng, 80).upper() for _ in range(12)]
    got = {r.id: r for r in robust_outliers(stored(random_docs(spark, clean + odd))).collect()}
    assert all(got[i].kept for i in range(len(clean)))
    assert not any(got[i].kept for i in range(len(clean), len(clean) + 12))
    again = {r.id: r.distance for r in robust_outliers(stored(random_docs(spark, clean + odd, 7))).collect()}
    assert all(abs(again[i] - got[i].distance) < 1e-9 for i in again)  # the order of rows does not matter


def test_chi_square_quantiles():
    assert abs(chi_square(0.5, 8) - 7.344) < 0.02 and abs(chi_square(0.999, 8) - 26.12) < 0.3
