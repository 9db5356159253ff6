"""What travels between tasks: narrow rows, ids as bytes, nothing that an output does not read."""

import re

import pytest

from idweave.functions.ids import packed_id, unpacked_id
from idweave.operators import conform, merge, profiles, resolve
from idweave.operators.lists import ordered_cells
from idweave.plans import pipelines, views
from idweave.plans.catalog import QUERIES
from idweave.schemas import Catalog
from idweave.sources import cells as cellio

SF = "/root/testdata/sf0.001"
H = "0123456789abcdef" * 2


def _plan(df, which="executedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


def _aggregates(df):
    """The grouping keys of every aggregate of the plan."""
    return re.findall(r"Aggregate \[(.*?)\], \[", _plan(df, "optimizedPlan"))


def test_packed_ids_give_their_text_back_and_stay_distinct(spark):
    ids = [H + "-cust", H, H[:-1], H.upper() + "-cust", "C1-BUILDING", "", H + "-é \n", "\x01" + H, None]
    df = spark.createDataFrame([(i,) for i in ids], "id string").withColumn("b", packed_id("id")).withColumn("back", unpacked_id("b"))
    got = df.collect()
    assert [r.back for r in got] == ids
    assert len({bytes(r.b) for r in got if r.b is not None}) == len(ids) - 1
    assert len(got[0].b) == 1 + 16 + len("-cust") and got[-1].b is None


def _messages(spark):
    row = [(f"{H}-a-5-t1", "t1", f"{H}-a", f"{H}-b", 5), ("odd", "t2", f"{H}-a", None, 5), (None, "t3", f"{H}-a", "x", 6),
           ("-own-", "t4", None, f"{H}-b", 7), ("y-8-t5", "t5", "y", "z", 8), ("n", None, f"{H}-a", "z", 8)]
    return spark.createDataFrame(row, "mid string, platform_msg_id string, user string, party string, timesent bigint")


def test_rekeyed_messages_join_on_bytes_and_keep_every_mid(spark):
    links = spark.createDataFrame([(f"{H}-a", "C"), (f"{H}-b", f"{H}-c")], "org_id string, connect_id string")
    m = _messages(spark)
    out = merge.rekey_messages(m, links)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([
        ("C-5-t1", "t1", "C", f"{H}-c", 5), ("C-5-t2", "t2", "C", None, 5), ("C-6-t3", "t3", "C", "x", 6),
        ("-own-", "t4", None, f"{H}-c", 7), ("y-8-t5", "t5", "y", "z", 8), (None, None, "C", "z", 8)], key=str)
    assert sorted(map(tuple, merge.rekey_messages(m, links.limit(0)).collect()), key=str) == sorted(map(tuple, m.collect()), key=str)
    assert "unhex" in _plan(out, "optimizedPlan")
    assert "unhex" in _plan(resolve.resolve_columns(m, links, ["user", "party"]), "optimizedPlan")
    assert "unhex" in _plan(merge.rekey_edges(m.select("user", "party").toDF("u_uid", "c_uid"), links), "optimizedPlan")


def test_contacts_are_distinct_on_raw_keys(spark):
    edges = views.contacts(spark, SF)
    assert _aggregates(edges) and all(keys.count("#") <= 3 and "uid" not in keys for keys in _aggregates(edges))
    assert edges.count() == edges.distinct().count()


def test_fan_out_users_are_distinct_before_they_are_wide(spark):
    for phone_ids in (False, True):
        users = conform.contact_fanout(views.fanout_source(spark, SF), "pc", phone_ids=phone_ids)[1]
        assert all(keys.count("#") <= 5 for keys in _aggregates(users))
        assert users.count() == users.distinct().count()
    spec = conform.spec_basic("pa", "c_custkey", "raw_name", "raw_phone", "raw_mail")
    day = pipelines.platform_day(views.dirty(spark, SF), spec, views.fanout_source(spark, SF))["users"]
    assert "RepartitionByExpression" in _plan(day, "optimizedPlan")
    assert day.count() == day.distinct().count()


def test_cells_are_exchanged_before_they_are_compared(spark):
    u = conform.conform_users(views.dirty(spark, SF), conform.spec_phone_id("pd", "raw_phone"))
    cat = Catalog.for_columns("USER", "rowkey", "INFO", ["rowkey", "userid", "phone"])
    assert "RepartitionByExpression [rowkey" in _plan(cellio.from_cells(cellio.to_cells(u, cat), cat), "optimizedPlan")


def test_merge_outputs_do_not_build_the_cells_they_do_not_read(spark):
    def cells():
        raise AssertionError("cells are read")
    links = spark.createDataFrame([("a", "C1")], "org_id string, connect_id string")
    ask = spark.createDataFrame([("C1", "N1", 1, "t"), ("b", "C1", 0, "t")], "org_id string, connect_id string, status int, insert_time string")
    m = _messages(spark)
    out = pipelines.identity_merge_job(cells, m, m.withColumnRenamed("user", "sender"),
                                       m.select("user", "party").toDF("u_uid", "c_uid"), links, ask, "t")
    assert sorted(out) == ["archive", "edges", "group_messages", "link_cycles", "links", "messages", "profiles", "requests"]
    assert out["requests"].count() == 1 and out["messages"].count() == m.count()
    assert [tuple(r) for r in out["links"].collect()] == [("a", "N1")]
    for name in ("profiles", "archive"):
        with pytest.raises(AssertionError, match="cells are read"):
            out[name]


def test_distinct_lists_drop_copies_at_every_size(spark):
    df = spark.createDataFrame([("a", v) for v in (3, 1, 2, 3, None, None)] + [("b", 1), ("b", 1), (None, 5), (None, 5)], "k string, v int")
    text = df.withColumn("v", df.v.cast("string"))
    for size in (100, 2):
        got = ordered_cells(text, ["k"], "v", ",", size, distinct=True)
        want = ordered_cells(text.distinct(), ["k"], "v", ",", size)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_profiles_are_merged_and_scored_on_bytes(spark):
    ev = spark.createDataFrame([(f"{H}-a", "x", "1", "p"), (f"{H}-a", "x", "1", "q"), ("C", "x", "1", "p")],
                               "rowkey string, attr string, value string, ev string")
    out = profiles.score(profiles.merge_evidence(ev.filter("ev = 'p'"), ev.filter("ev = 'q'"), snapshot=False))
    assert out.columns == ["rowkey", "attr", "value", "ev", "score"] and "unhex" in _plan(out, "optimizedPlan")
    assert sorted(map(tuple, out.collect())) == [(f"{H}-a", "x", "1", "p", 2), (f"{H}-a", "x", "1", "q", 2)]


def test_merged_cells_are_written_once(spark):
    cells = spark.createDataFrame([("a", "PHONE", "1"), ("a", "MSG_COUNT", "2")], "rowkey string, field string, value string")
    links = spark.createDataFrame([("a", "C")], "org_id string, connect_id string")
    out = merge.merge_profiles(cells, links)
    assert "LogicalRDD [rowkey" not in _plan(out, "optimizedPlan")
    assert sorted((r.field, r.entry) for r in out.collect()) == [("MSG_COUNT", "2"), ("PHONE", "1")]


@pytest.mark.parametrize("name, exchanges", [("profile_snapshot", 3), ("profile_snapshot_thirds", 3), ("profile_merge", 4),
                                             ("profile_merge_thirds", 4), ("profile_merge_maps", 6)])
def test_both_sides_of_a_profile_merge_read_one_exchange(spark, name, exchanges):
    """Messages, evidence and scores (and row keys, or the maps of both sides) move once; nothing is checkpointed."""
    df = QUERIES[name](spark, SF)
    df._jdf.queryExecution().toRdd().count()
    text = _plan(df).split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in text and "ExistingRDD" not in text
    assert len(re.findall(r"[+:]- Exchange hashpartitioning", text)) <= exchanges


def test_scores_of_repeated_and_null_keys(spark):
    ev = spark.createDataFrame([("r", "a", "1", "p"), ("r", "a", "1", "q"), ("r", "a", None, "p"), (None, "a", "1", "p"), ("s", "a", "1", "p")],
                               "rowkey string, attr string, value string, ev string")
    assert sorted(map(tuple, profiles.score(ev).collect())) == [("r", "a", "1", "p", 2), ("r", "a", "1", "q", 2), ("s", "a", "1", "p", 1)]


def test_a_days_contacts_travel_as_bytes_and_once(spark):
    df = QUERIES["platform_day_contacts"](spark, SF)
    assert "unhex" in _plan(df, "optimizedPlan")
    df._jdf.queryExecution().toRdd().count()
    text = _plan(df).split("== Initial Plan ==")[0]
    assert re.search(r"HashAggregate\(keys=\[u_uid[^\n]*\n[ +-:*()\d]*HashAggregate\(keys=\[u_uid[^\n]*\n[ +-:*()\d]*Union", text)   # no exchange above the union
    assert df.count() == df.distinct().count()


def test_a_days_regions_read_three_columns_once(spark):
    text = _plan(QUERIES["platform_day_region"](spark, SF), "optimizedPlan")
    assert all(keys.count("#") <= 5 for keys in re.findall(r"RepartitionByExpression \[(.*?)\]", text))
    assert len(re.findall(r"Relation \[l_orderkey", text)) == 2     # the owners and the contacts of the fan-out


def test_region_of_phones_without_match_key_or_platform(spark):
    from idweave.operators.enrich import region_lookup
    users = spark.createDataFrame([("r", "0211", "t"), ("r", "0211", "t"), ("r", "99", "t"), (None, "02", "t"), ("s", "02", None), ("q", "", "t"),
                                   ("q", None, "t")], "rowkey string, phone string, platform string")
    pre = spark.createDataFrame([("02", "C", "P", None, None), ("021", "", "P", "city", "021"), (None, "x", "x", "x", "x")],
                                "prefix string, country string, province string, city string, code string")
    got = sorted((tuple(r) for r in region_lookup(users, pre).select("rowkey", "phone", "platform", "country", "city", "code").collect()), key=str)
    unknown = ("Unknown", "Unknown", None)
    assert got == sorted([("r", "0211", "t", "Unknown", "city", "021"), ("r", "99", "t", *unknown), (None, "02", "t", *unknown),
                          ("s", "02", None, *unknown), ("q", "", "t", *unknown)], key=str)


def test_list_cells_travel_as_bytes_and_sort_as_text(spark):
    values = [H + "|b", H + "|a", "zz", "a", H[:31] + "g", None, H.upper(), H + "|a"]
    df = spark.createDataFrame([(k, v) for k in (H + "-cust", "plain", None) for v in values], "k string, v string")
    for size in (100, 3):
        for distinct in (False, True):
            out = ordered_cells(df, ["k"], "v", ",", size, distinct=distinct)
            assert "unhex" in _plan(out, "optimizedPlan")
            some = [v for v in (dict.fromkeys(values) if distinct else values) if v is not None]
            want = sorted(some) + [None]        # nulls are last in a sorted array of structs, or first in sorted runs
            cells = {(r.k, r.part): r.value for r in out.collect()}
            for k in (H + "-cust", "plain", None):
                got = [x for p in range(5) if (k, p) in cells for x in cells[k, p].split(",") if x]
                assert got == want[:-1]


def test_counts_and_names_of_packed_profiles_travel_as_bytes(spark):
    text = _plan(views.packed_profiles(spark, SF), "optimizedPlan")
    assert text.count("unhex") >= 6
