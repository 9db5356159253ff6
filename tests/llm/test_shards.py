"""Shards of the two-pass shuffle: a round trip, the row law, and the order by a plain Fisher-Yates shuffle."""

import collections
import zlib

import numpy as np
import pytest

from idweave.llm.common import scratch, store
from idweave.llm.queries import op13_sharding
from idweave.llm.shards import shard_report, shard_starts, shuffled_shards, write_shards

from .helpers import edge_docs, edge_rows, empty_docs, prose


def even(rows, shards, n):
    """Counts at most one apart, slots gapless from 0."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert set(by) <= set(range(shards)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    counts = [len(by[s]) for s in range(shards)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1


def test_starts():
    for n in (0, 1, 5, 16, 17, 1000):
        sizes = np.diff(shard_starts(n, 16))
        assert sizes.sum() == n and sizes.max() - sizes.min() <= 1


@pytest.mark.parametrize("bucket_bytes", [48 << 20, 2000])
def test_all_rows_come_back_whole(spark, bucket_bytes):
    docs = store(edge_docs(spark).selectExpr("*", "doc_id AS shard", "lang AS SLOT"), "test")
    path = scratch(spark, "test-shards")
    shard, slot = write_shards(docs, path, 4, bucket_bytes=bucket_bytes)
    assert (shard, slot) == ("_shard", "_slot")
    back = spark.read.parquet(path)
    assert sorted(back.columns) == sorted([*docs.columns, shard, slot])
    key = lambda r: repr(sorted(r.asDict().items(), key=str))
    assert sorted(map(key, back.select(docs.columns).collect())) == sorted(map(key, docs.collect()))
    got = shard_report(docs, 4, bucket_bytes=bucket_bytes).collect()
    even(got, 4, len(edge_rows()))
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in edge_rows())
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_order_is_the_buckets_fisher_yates(spark):
    """Positions by hand: buckets by the hash of the place, each in order of places, then the seeded permutation."""
    docs = store(spark.range(500).selectExpr("id AS doc_id", "concat('t', id) AS text").repartition(3), "test")
    rows, shard, slot = shuffled_shards(docs, 4, seed=5, bucket_bytes=4000)
    got = {r.doc_id: (r[shard], r[slot]) for r in rows.collect()}
    buckets = -(-docs.selectExpr("sum(64 + octet_length(text))").first()[0] // 4000)
    assert buckets > 4
    places = docs.selectExpr("doc_id", "struct(_metadata.file_name AS file, _metadata.row_index AS row) AS place").selectExpr(
        "doc_id", "place", f"pmod(xxhash64(5, place), {buckets}) AS bucket").collect()
    by = collections.defaultdict(list)
    for r in sorted(places, key=lambda r: (r.place.file, r.place.row)):
        by[r.bucket].append(r.doc_id)
    order = [by[b][i] for b in sorted(by) for i in np.random.default_rng([5, b]).permutation(len(by[b]))]
    starts = [-(-s * 500 // 4) for s in range(5)]
    want = {d: next((s, p - starts[s]) for s in range(4) if starts[s] <= p < starts[s + 1]) for p, d in enumerate(order)}
    assert got == want
    assert sorted(rows.collect()) == sorted(shuffled_shards(docs, 4, seed=5, bucket_bytes=4000)[0].collect())
    assert got != {r.doc_id: (r[shard], r[slot]) for r in shuffled_shards(docs, 4, seed=6, bucket_bytes=4000)[0].collect()}


def test_splits_and_computed_rows_change_nothing(spark):
    docs = store(spark.range(2000).selectExpr("id AS doc_id", "repeat('x', 50) AS text").repartition(2), "test")
    key = lambda rows: sorted((r.doc_id, r.shard, r.slot) for r in rows)
    first = key(shard_report(docs).collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        assert key(shard_report(docs).collect()) == first
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    even(shard_report(spark.range(33).selectExpr("id AS doc_id", "'copy' AS text")).collect(), 16, 33)


def test_copies_are_scattered(spark):
    """A third of all rows is one text with one id; every shard gets its share."""
    import random
    rng = random.Random(4)
    rows = [(7, "one text", "en", "s", 8)] * 1000 + [(100 + i, prose(rng, 20), "en", "s", 0) for i in range(2000)]
    got = shard_report(store(spark.createDataFrame(rows, edge_docs(spark, False).schema), "test"), bucket_bytes=20_000).collect()
    even(got, 16, 3000)
    copies = collections.Counter(r.shard for r in got if r.doc_id == 7)
    assert len(copies) == 16 and max(copies.values()) < 110


def test_few_and_no_rows(spark):
    even(shard_report(spark.createDataFrame(edge_rows()[:3], edge_docs(spark, False).schema)).collect(), 16, 3)
    assert shard_report(empty_docs(spark)).collect() == []
    assert shard_report(store(empty_docs(spark), "test")).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = op13_sharding(spark, sf).collect()
    even(got, 16, len(docs))
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs)
