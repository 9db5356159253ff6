"""Mixing and WARC archives."""

import collections
import gzip
import hashlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from idweave.llm import mixing
from idweave.llm.common import scratch
from idweave.llm.mixing import mixed_sizes, mixture, split_quotas, targets
from idweave.llm.warc import (archive_report, chunked, dechunked, parse_warc, read_warc, reassembled, record, records,
                              write_warc)

from .helpers import edge_docs, edge_rows, empty_docs, stored, words


def test_targets_and_quotas():
    assert targets([100, 100, 100], [3, 1, 2], Fraction(450)) == [200, Fraction(250, 3), Fraction(500, 3)]
    assert targets([10, 0, 1000], [3, 1, 2], Fraction(1515)) == [20, 0, 1495]
    assert targets([], [], Fraction(0)) == []
    quotas = np.array([17, 0, 230, 4])
    split = split_quotas(quotas, 13, np.random.default_rng(1))
    assert split.shape == (13, 4) and (split.sum(axis=0) == quotas).all() and (split >= 0).all()
    assert max(split.sum(axis=1)) - min(split.sum(axis=1)) <= 2


def test_mixture_meets_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixed_sizes(docs).collect()
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    taken, sizes, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[source[r.id]] += r.taken
        sizes[source[r.id]] += r.size
        target[source[r.id]] = r.target
    names = sorted(sizes, key=lambda s: s.encode())
    want = targets([sizes[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], Fraction(3, 2) * sum(sizes.values()))
    for s, t in zip(names, want):
        assert abs(target[s] - float(t)) < 1e-6 and abs(taken[s] - t) <= 0.02 * t
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixed_sizes(docs).collect()))
    mixed = collections.Counter(r.doc_id for r in mixture(docs).select("doc_id").collect())
    by_id = {r.id: r for r in got}
    assert all(mixed[i] * by_id[i].size == by_id[i].taken for i in by_id)


def test_a_long_document_leaves_no_gap(spark):
    """One document holds a third of the source's words; the others can fill any rest."""
    rows = [(i, "w " * (250_000 if i == 1000 else 500), "en", "a", 0) for i in range(1001)]
    docs = stored(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    for seed in range(4):
        got = mixed_sizes(docs, share=Fraction(7, 10), seed=seed, blocks=16).collect()
        assert abs(sum(r.taken for r in got) - 525_000) <= 250 and all(r.taken <= 2 * r.size for r in got)


def test_blocks_and_shards_grow_with_the_input(spark, monkeypatch):
    assert mixing.parts([], [], 2) == ([], 64) and mixing.parts([5, 5], [0, 0], 2) == ([256, 256], 64)
    assert mixing.parts([1 << 30, 1 << 34], [1 << 46, 0], 2) == ([1 << 19, 1 << 18], 1 << 17)
    monkeypatch.setattr(mixing, "SHARDS", 2)
    monkeypatch.setattr(mixing, "SHARD_BYTES", 5_000)
    rows = [(i, f"{i} " * 5, "en", "a", 0) for i in range(2_000)]
    docs = stored(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    mixed = mixture(docs)
    held = collections.Counter()
    for r in mixed.withColumn("part", F.spark_partition_id()).collect():
        held[r.part] += len(r.text)
    assert mixed.count() > 2_900 and max(held.values()) <= 4 * 5_000


def test_mixing_edges(spark):
    docs = stored(edge_docs(spark))
    got = mixed_sizes(docs).collect()
    assert collections.Counter((r.id, r.size) for r in got) == collections.Counter((r[0], len(words(r[1]))) for r in edge_rows())
    assert all(r.taken <= 2 * r.size for r in got)
    mixed = mixture(docs)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert mixed_sizes(empty_docs(spark)).count() == 0 and mixture(empty_docs(spark)).count() == 0


PAGES = [(1, "http://a/1", "x" * 1500), (2, "http://a/2", "x" * 1500), (3, "http://a 3", None), (4, None, ""), (5, "u", "short"),
         (6, "u", "short"), (7, "u\r\nv", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc" + "y" * 5000), (8, "u", "z" * 200_000),
         (9, "u", "z" * 200_000), (None, "u", "n" * 1200), (9, "u", "z" * 200_000), (10, "u", "0\r\n\r\n" * 400), (11, "u", "é" * 499 + "a")]


def pages(spark):
    return stored(spark.createDataFrame([(*p, "extra", 1) for p in PAGES],
                                        "page_id bigint, url string, html string, row_no string, refers int"))


def test_warc_round_trip(spark):
    path = scratch(spark, "warc")
    write_warc(pages(spark), path, segment_bytes=4096, records_per_file=5)
    archive = stored(read_warc(spark, path))
    got = archive_report(archive).collect()
    assert len(got) == len(PAGES) and all(r.ok for r in got)
    by_payload = collections.defaultdict(list)
    for page, _, html in PAGES:
        by_payload[(html or "").encode()].append(page)
    rows = collections.defaultdict(list)
    for r in got:
        rows[r.page_id].append(r)
    for page, _, html in PAGES:
        body = (html or "").encode()
        for r in rows[page]:
            assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
            held = max((p for p in by_payload[body] if p is not None), default=None)
            if len(body) < 1000 or len(by_payload[body]) == 1:
                assert (r.record_type, r.refers_to) == ("response", None)
            elif page != held:
                assert (r.record_type, r.refers_to) == ("revisit", held)
    assert sorted(r.record_type for r in rows[9]) == ["response", "revisit"]  # equal in page id and payload: one holds it
    payload = {r.page_id: bytes(r.payload) for r in archive.filter("record_type = 'response'").collect()}
    assert payload[7] == PAGES[6][2].encode()
    assert payload.get(8, payload.get(9)) == b"z" * 200_000
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).filter("path like '%.gz'").collect()]
    heads = [h for f in files for h, _ in records(gzip.decompress(f))]
    assert sum("warc-segment-origin-id" in h for h in heads) > 40
    assert {h["warc-type"] for h in heads} == {"response", "revisit", "continuation"}


def test_broken_segments_are_not_whole(spark):
    path = scratch(spark, "warc")
    write_warc(pages(spark), path, segment_bytes=4096)
    parsed = stored(parse_warc(spark, path))
    whole = reassembled(parsed).filter("block IS NULL").count()
    assert whole == 0
    lost = stored(reassembled(parsed.filter("NOT (segment = 3 AND record_type = 'continuation')")))
    assert lost.filter("block IS NULL").count() > 0
    twice = reassembled(parsed.unionByName(parsed.filter("segment = 2")))
    assert twice.filter("block IS NULL").count() > 0


def test_warc_without_pages(spark):
    path = scratch(spark, "warc")
    write_warc(pages(spark).limit(0), path)
    assert archive_report(read_warc(spark, path)).count() == 0


def test_chunked_framing():
    for body in (b"", b"a", b"x" * 8192, b"y" * 20_001):
        assert dechunked(chunked(body)) == body
    assert dechunked(b"5;ext=1\r\nhello\r\n0\r\n\r\n") == b"hello"
    for broken in (b"", b"zz\r\n", b"5\r\nhel", b"5\r\nhelloXX0\r\n\r\n", b"-5\r\n"):
        assert dechunked(broken) is None
    data = record([("WARC-Type", "x")], b"block") + b"\r\n\r\n" + record([("A", None), ("B", 2)], b"") + b"\r\n\r\n"
    assert [(h.get("b"), b) for h, b in records(data)] == [(None, b"block"), ("2", b"")]
