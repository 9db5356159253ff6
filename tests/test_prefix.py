"""Running sums against a plain loop."""

import random

from idweave.operators.prefix import global_positions, running_sum


def test_running_sum(spark):
    rng = random.Random(2)
    rows = [(p, rng.randint(0, 9)) for p in rng.sample(range(200), 90)] + [(-3, 5), (10_000, 1)]
    got = {r.p: r.before for r in running_sum(spark.createDataFrame(rows, "p bigint, v bigint"), "p", "v", "before", block=16).collect()}
    assert got == {p: sum(v for q, v in rows if q < p) for p, _ in rows}
    assert running_sum(spark.createDataFrame([], "p bigint, v bigint"), "p", "v", "before").collect() == []


def test_global_positions(spark):
    rng = random.Random(3)
    data = [("hot", rng.randint(0, 50)) for _ in range(3000)] + [("tie", 7)] * 2000 + [(None, v) for v in (3, 1, 2)]
    rng.shuffle(data)
    got = global_positions(spark.createDataFrame(data, "k string, v int").repartition(6), ["k"], ["v"]).collect()
    for k in ("hot", "tie", None):
        mine = sorted((r.position, r.v) for r in got if r.k == k)
        assert [p for p, _ in mine] == list(range(len(mine)))
        assert [v for _, v in mine] == sorted(v for x, v in data if x == k)


def test_a_name_with_many_sources_is_several_entries(spark):
    from idweave.operators import merge
    rows = [("r", "n", f"s{i}-p") for i in range(7)] + [("r", "m", "a-b-q")]
    cells = merge.packed_names(spark.createDataFrame(rows, "rowkey string, name string, source string"), max_entries=3)
    assert [tuple(r) for r in cells.collect()] == [("r", "NAME", "\x02".join([
        "name:m|platforms:a-b-q|score:1", "name:n|platforms:s0-p,s1-p,s2-p|score:7", "name:n|platforms:s3-p,s4-p,s5-p|score:7",
        "name:n|platforms:s6-p|score:7"]))]
    links = spark.createDataFrame([("r", "C"), ("s4", "C"), ("a-b", "D")], "org_id string, connect_id string")
    got = {r.pos: r.entry for r in merge.merge_profiles(cells, links).collect()}
    assert got == {0: "name:m|platforms:D-q|score:1", 1: "name:n|platforms:s0-p,s1-p,s2-p|score:7",
                   2: "name:n|platforms:s3-p,C-p,s5-p|score:7", 3: "name:n|platforms:s6-p|score:7"}


def test_a_list_of_over_100000_entries(spark):
    """One shape at every size: parts in order are the whole list, and merging numbers its entries on."""
    from idweave.operators import merge
    n = 130_000
    edges = spark.range(n).selectExpr("'hub' AS u_uid", "concat('c', lpad(CAST(id AS STRING), 6, '0')) AS c_uid", "'p' AS platform").unionByName(
        spark.createDataFrame([("one", "c000001", "p")], "u_uid string, c_uid string, platform string"))
    cells = merge.packed_contacts(edges)
    found = {(r.rowkey, r.field): r.value.split("\x02") for r in cells.collect()}
    assert sorted(found) == [("hub", "CONTACT"), ("hub", "CONTACT#1"), ("one", "CONTACT")]
    want = [f"c{i:06d}|p" for i in range(n)]
    assert found["hub", "CONTACT"] + found["hub", "CONTACT#1"] == want and len(found["hub", "CONTACT"]) == 100_000
    links = spark.createDataFrame([("hub", "C"), ("one", "C"), ("c000002", "X")], "org_id string, connect_id string")
    merged = merge.merge_profiles(cells, links)
    rows = {(r.org_id, r.pos): r.entry for r in merged.collect()}
    assert len(rows) == n + 1 and rows["hub", 120_000] == "c120000|p" and rows["hub", 2] == "X|p" and rows["one", 0] == "c000001|p"
    packed = {r.field: r.value.split("\x02") for r in merge.pack_entries(merged).collect()}
    want[2] = "X|p"
    assert sorted(packed) == ["CONTACT", "CONTACT#1"] and packed["CONTACT"] + packed["CONTACT#1"] == want + ["c000001|p"]
