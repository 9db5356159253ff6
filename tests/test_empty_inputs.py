"""An empty input gives an empty output (no emptiness guard, no failure)."""

from pyspark.sql import functions as F

from idweave.operators import counts, latest, merge, profiles, resolve


def test_empty_inputs_give_empty_outputs(spark):
    msgs = spark.createDataFrame([], "mid string, user string, party string, timesent long, msgtype int, "
                                     "content string, platform_msg_id string, partyuid string, platform string")
    assert counts.pair_count_latest(msgs).count() == 0
    assert counts.pair_count_latest(msgs, join_back=True).count() == 0
    assert counts.total_per_person(msgs).count() == 0
    assert latest.latest_with_count(msgs, ["user"], "timesent", F.col("msgtype") == 0).count() == 0
    links = spark.createDataFrame([], "org_id string, connect_id string")
    assert resolve.resolve_column(msgs, links, "user").count() == 0
    out, cycles = merge.flatten_links(links, links)
    assert out.count() == 0 and cycles.count() == 0
    cells = spark.createDataFrame([], "rowkey string, field string, value string")
    assert merge.merge_profiles(cells, links).count() == 0
    ev = spark.createDataFrame([], "rowkey string, attr string, value string, ev struct<platform:string>")
    assert profiles.score(profiles.merge_evidence(ev, ev)).count() == 0
    day = spark.createDataFrame([], "day string, uid string")
    mids = spark.createDataFrame([], "day string, mid string")
    assert counts.daily_counters([day], day, mids, mids).count() == 0
