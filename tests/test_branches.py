"""Every branch that ``plans.branches`` plants has rows, and the quarantine's counts add up."""

from pyspark.sql import functions as F

from idweave.plans import branches, views
from idweave.plans.catalog import QUERIES
from idweave.sources.quarantine import quarantine
from idweave.sources.scratch import scratch

SF = "/root/testdata/sf0.001"


def test_branches_have_rows(spark):
    n = {name: QUERIES[name](spark, SF).count() for name in ("msg_dedup", "msg_dedup_copies", "gmsg_dedup", "gmsg_dedup_copies")}
    assert n["msg_dedup"] == n["msg_dedup_copies"] and n["gmsg_dedup"] == n["gmsg_dedup_copies"]
    assert views.message_source(spark, SF).filter(F.col("messagetoken").endswith(".1")).count() > 100
    m = QUERIES["rekey_messages_both_ends"](spark, SF)
    legs = {(r.s, r.p): r["count"] for r in m.groupBy(F.col("user").startswith("N").alias("s"), F.col("party").startswith("N").alias("p")).count().collect()}
    assert legs[True, True] > 100 and legs[False, True] > 100
    e = QUERIES["resolve_edges_both_ends"](spark, SF)
    assert e.filter("c_uid LIKE 'N%' AND NOT u_uid LIKE 'N%'").count() > 100
    fan = QUERIES["pair_with_user_fanout"](spark, SF)
    assert fan.groupBy("uuid").count().filter("count > 1").count() > 10 and fan.filter("mail IS NOT NULL").count() > 10
    stored, incoming = (d.select("rowkey").distinct() for d in branches._thirds(spark, SF))
    assert min(stored.join(incoming, "rowkey", "left_anti").count(), incoming.join(stored, "rowkey", "left_anti").count(),
               stored.join(incoming, "rowkey").count()) > 10
    assert QUERIES["profile_snapshot_thirds"](spark, SF).count() > QUERIES["profile_merge_thirds"](spark, SF).count()
    assert sum(r._corrupt_record is not None for r in QUERIES["csv_bad_lines"](spark, SF).collect()) > 10
    reasons = {x for r in QUERIES["rejected_rows"](spark, SF).select("reasons").distinct().collect() for x in r.reasons.split(",")}
    assert reasons == {"no_phone", "bad_phone", "no_name", "no_sender", "no_receiver"}


def test_quarantine_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "y"), (None, None), (5, "x")], "id bigint, t string").repartition(3)
    q = quarantine(df, {"no_id": F.col("id").isNull(), "no_t": F.col("t").isNull(), "is_x": F.col("t") == "x"}, scratch(spark, "q"))
    assert q.counts == {"rows": 5, "accepted": 1, "rejected": 4, "no_id": 1, "no_t": 2, "is_x": 2}
    assert [tuple(r) for r in q.accepted.collect()] == [(3, "y")]
    assert {r.id: r.reasons for r in q.rejected.collect()} == {1: ["no_t"], 2: ["is_x"], None: ["no_id", "no_t"], 5: ["is_x"]}
    none = quarantine(df.limit(0), {"no_id": F.col("id").isNull()}, scratch(spark, "q"))
    assert none.counts["rows"] == 0 and none.accepted.collect() == [] and none.rejected.collect() == []
