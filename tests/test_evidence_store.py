"""The evidence store: what a load adds, which files it touches, and that stored rows are never exchanged."""

import os
import re

from pyspark.sql import functions as F

from idweave.sources.evidence_store import EvidenceStore
from idweave.sources.scratch import scratch

SCHEMA = "rowkey string, attr string, value string, ev string"


def evidence(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def files(store):
    return {f for f in os.listdir(store.path.removeprefix("file:")) if f.startswith("part-")}


def bucket(name):
    return int(re.search(r"_(\d{5})\.", name)[1])


def many(n, first=0):
    return [(f"r{i % 17}", f"a{i % 3}", f"v{i % 40}", f"e{i}") for i in range(first, first + n)]


def test_loads_merge_as_a_set(spark):
    store = EvidenceStore(spark, scratch(spark, "store"), 4)
    old, new = many(300) + many(5), many(300, 200) + [("only", "a", "v", "e"), (None, "a", "v", "e"), ("r", None, "v", "e")]
    store.add(evidence(spark, old), "b1")
    before = files(store)
    store.add(evidence(spark, new), "b2")
    assert before < files(store)  # nothing is written again
    got = {tuple(r)[:4]: (r.batch, r.score) for r in store.scored().collect()}
    want = {r: "b1" for r in old} | {r: "b2" for r in new if None not in r and r not in set(old)}
    assert {k: b for k, (b, _) in got.items()} == want and store.table().count() == len(want)
    for (k, a, v, _), (_, score) in got.items():
        assert score == sum(x[:3] == (k, a, v) for x in want)
    store.add(evidence(spark, new), "b3")  # a repeated load adds nothing
    assert store.table().count() == len(want) and {r.batch for r in store.table().collect()} == {"b1", "b2"}
    small = store.compact(scratch(spark, "compact"))
    assert sorted(map(tuple, small.scored().collect())) == sorted(map(tuple, store.scored().collect()))
    assert len(files(small)) <= 4


def test_only_touched_buckets_get_files(spark):
    store = EvidenceStore(spark, scratch(spark, "store"), 8)
    store.add(evidence(spark, many(500)), "b1")
    before = files(store)
    store.add(evidence(spark, [("r1", "a1", "new", "e"), *many(50)]), "b2")
    more = files(store) - before
    assert len(more) == 1
    at = evidence(spark, [("r1", "a1", "new", "e")]).select(F.expr("pmod(hash(rowkey, attr, value), 8)")).first()[0]
    assert {bucket(f) for f in more} == {at}


def test_a_load_that_broke_off_is_repeated(spark):
    """A load of which only some rows became visible: the next run adds the rest and repeats nothing."""
    store = EvidenceStore(spark, scratch(spark, "store"), 4)
    store.add(evidence(spark, many(90)), "b1")
    store.add(evidence(spark, many(200)), "b1")
    assert sorted(tuple(r)[:4] for r in store.table().collect()) == sorted(set(many(200)))


def exchanged_scans(df):
    """Scans of the stored table that stand below an exchange in the physical plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    depth, below, bad = [], [], 0
    for line in text.splitlines():
        if not re.search(r"[A-Z]", line):
            continue
        at = re.search(r"[A-Z*(]", line).start()
        while depth and depth[-1] >= at:
            depth.pop(), below.pop()
        node = line[at:]
        depth.append(at)
        below.append((below[-1] if below else False) or bool(re.match(r"(Broadcast)?Exchange", node)))
        if "FileScan" in node and "idweave_evidence" in node:
            assert "Bucketed: true" in node, node
            bad += below[-1]
    assert "FileScan" in text
    return bad


def test_no_exchange_of_stored_rows(spark):
    store = EvidenceStore(spark, scratch(spark, "store"), 4)
    store.add(evidence(spark, many(100)), "b1")
    assert exchanged_scans(store.unseen(evidence(spark, many(10)))) == 0
    assert exchanged_scans(store.scored()) == 0
    text = store.unseen(evidence(spark, many(10)))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") <= 2  # the batch: distinct, then its buckets


def test_the_stored_rows_are_in_no_exchange_when_shuffles_are_wide(spark, tmp_path):
    """More shuffle partitions than buckets, and a batch that is an aggregate: the anti join used to go below the batch's exchange."""
    store = EvidenceStore(spark, str(tmp_path / "wide"), 4)
    rows = spark.range(200).selectExpr("concat('r', id % 50) AS rowkey", "concat('a', id % 2) AS attr", "CAST(id AS STRING) AS value", "concat('{', id % 3, '}') AS ev")
    store.add(rows.filter("value < '5'"), "one")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        new = store.unseen(rows.unionByName(rows).distinct())
        assert new.count() == rows.filter("value >= '5'").count() > 0 and new.columns == ["rowkey", "attr", "value", "ev"]
        assert exchanged_scans(new) == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
