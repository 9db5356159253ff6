"""The pipeline's stages one by one, on edge rows, and the SQL twins of the queries."""

import collections

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from idweave.llm import queries
from idweave.llm.common import keep_rows, numbered, store
from idweave.llm.ngram_join import ngram_join

from .helpers import edge_docs, edge_rows, empty_docs, random_docs
from .test_dedup import components, norm


@pytest.fixture(scope="module")
def edge_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge"))
    edge_docs(spark).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i != 13), 0) for i in range(1, 15)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    empty = str(tmp_path_factory.mktemp("empty"))
    empty_docs(spark).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    return path, empty


def test_stages_take_effect_and_keep_the_columns(spark, edge_dir):
    path, _ = edge_dir
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "ngram_jaccard", "source_mixing",
                                                      "best_fit_packing"]
    good = store(corpus_pipeline.quality_classifier(spark, docs, path), "good")
    assert good.columns == columns and 0 < good.count() <= len(edge_rows())
    exact = store(corpus_pipeline.exact_duplicates(spark, docs, path), "exact")
    texts = [r.text for r in exact.collect()]
    assert exact.columns == columns and collections.Counter(map(norm, texts)) == collections.Counter({norm(r[1]) for r in edge_rows()})
    near = store(corpus_pipeline.near_duplicates(spark, exact, path), "near")
    assert near.columns == columns and near.count() == len(set(components(texts)[1]))
    mixed = store(corpus_pipeline.source_mixing(spark, near, path), "mixed")
    assert mixed.columns == columns
    packed = corpus_pipeline.best_fit_packing(spark, mixed, path)
    assert packed.filter("piece = 0").count() == mixed.count()


def test_near_copies_between_the_thresholds_of_op7_and_the_stage(spark):
    text = [f"w{i}" for i in range(102)]
    other = ["x" if i in (30, 70) else w for i, w in enumerate(text)]  # 5 words: 88 / 108; 3 words: 94 / 106
    apart = ["y" if i in (20, 50, 80) else w for i, w in enumerate(text)]  # 5 words: 83 / 113 to the first, under 0.8
    docs = store(random_docs(spark, [" ".join(t) for t in (text, other, apart)]), "docs")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [0, 2]
    assert {r.component_id for r in ngram_join(docs).collect()} == {0, 1, 2}


def test_row_numbers_outlive_a_change_of_cores(spark):
    """Cores come and go between two scans of a query; small files are packed by the number of cores."""
    pinned, cost, cores = (f"spark.sql.{k}" for k in ("files.minPartitionNum", "files.openCostInBytes", "leafNodeDefaultParallelism"))
    before = {k: spark.conf.get(k, None) for k in (pinned, cost, cores)}
    try:
        spark.conf.unset(pinned)
        spark.conf.set(cost, "1")
        docs = store(spark.range(60).selectExpr("id AS doc_id", "CAST(id AS string) AS text").repartition(6), "docs")
        seen = []
        for n in (1, 6, 3):
            spark.conf.set(cores, str(n))
            seen.append({r.doc_id: r.row_no for r in numbered(docs).collect()})
        assert len(set(seen[0].values())) == 60 and seen[0] == seen[1] == seen[2]
        spark.conf.set(cores, "1")
        spark.conf.unset(pinned)
        decided = store(numbered(docs).selectExpr("row_no", "doc_id % 2 = 0 AS kept"), "decided")
        spark.conf.set(cores, "6")
        assert sorted(r.doc_id for r in keep_rows(docs, decided).collect()) == list(range(0, 60, 2))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_run_on_edge_and_empty_tables(spark, edge_dir):
    path, empty = edge_dir
    assert corpus_pipeline.run(spark, path).count() > 0
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_first_stage_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.quality_classifier(spark, docs, sf).select("doc_id").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.95 * len(good)


def test_every_query_is_registered_once():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")} == set(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES) <= set(entry.queries())
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in queries.QUERIES


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = entry.queries()[name](spark, sf)
    cols = sorted(got.columns)
    want = con.execute(queries.SQL[name])
    order = [[d[0] for d in want.description].index(c) for c in cols]
    assert collections.Counter(tuple(r[c] for c in cols) for r in got.collect()) == collections.Counter(
        tuple(r[i] for i in order) for r in want.fetchall())
