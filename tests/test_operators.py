"""Operator cases from FIXTURES.md §4 plus properties."""

import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idweave.operators import counts, latest, match, merge, profiles, resolve, setops
from idweave.sources import sinks

from .conftest import rows


def test_latest_keeps_ties(spark):
    df = spark.createDataFrame([
        ("u", "p", 5, 0, "x"), ("u", "p", 5, 0, "y"), ("u", "p", 3, 0, "z"), ("u", "p", 9, 1, "w"),
        ("v", "p", 1, 0, "q")], "user string, party string, timesent long, msgtype int, content string")
    out = latest.latest_with_count(df, ["user", "party"], "timesent", F.col("msgtype") == 0)
    got = sorted(rows(out, "user", "content", "timesent", "count"))
    assert got == [("u", "x", 5, 3), ("u", "y", 5, 3), ("v", "q", 1, 1)]
    back = latest.latest_with_count(df, ["user", "party"], "timesent", F.col("msgtype") == 0, join_back=True)
    assert sorted(rows(back, "content")) == [("q",), ("x",), ("y",)]


def test_pair_count_latest_filters_signin(spark):
    df = spark.createDataFrame([
        ("m1", "u", "p", 5, 0, "Ann is back on Tango", "1", "pu", "cust"),
        ("m2", "u", "p", 4, 0, "hi", "2", "pu", "cust"),
        ("m3", "v", "p", 4, 0, "hey", "3", "pu", "cust")],
        "mid string, user string, party string, timesent long, msgtype int, content string, "
        "platform_msg_id string, partyuid string, platform string")
    out = counts.pair_count_latest(df)
    assert rows(out, "uuid", "count", "content") == [("v-p", 1, "hey")]


def test_map_merge(spark):
    vt = T.StructType([T.StructField("evidence", T.ArrayType(T.StringType())),
                       T.StructField("score", T.IntegerType())])
    mt = T.MapType(T.StringType(), vt)
    df = spark.createDataFrame([({"k1": (["t"], 1), "k2": (["x"], 1)}, {"k1": (["h", "t"], 2), "k3": (["z"], 1)})],
                               T.StructType([T.StructField("s", mt), T.StructField("i", mt)]))
    m = df.select(profiles.merge_maps("s", "i").alias("m")).first().m
    assert {k: (v.evidence, v.score) for k, v in m.items()} == {
        "k1": (["t", "h"], 2), "k2": (["x"], 1), "k3": (["z"], 1)}
    nul = df.select(profiles.merge_maps(profiles.coalesce_map(F.lit(None).cast(mt), vt), "i").alias("m")).first().m
    assert set(nul) == {"k1", "k3"}


def test_evidence_merge_idempotent_and_scored(spark):
    ev = spark.createDataFrame([("r1", "mail", "a@x", ("pa",)), ("r1", "mail", "a@x", ("pc",)),
                                ("r2", "mail", "b@x", ("pa",))],
                               "rowkey string, attr string, value string, ev struct<platform:string>")
    once = profiles.merge_evidence(ev, ev)
    assert sorted(rows(once)) == sorted(rows(ev.distinct()))
    scored = profiles.score(profiles.merge_evidence(ev, ev.limit(0), snapshot=True))
    assert sorted(rows(scored, "rowkey", "score")) == [("r1", 2), ("r1", 2), ("r2", 1)]
    only_inc = profiles.merge_evidence(ev, ev.filter("rowkey = 'r2'"), snapshot=False)
    assert {r[0] for r in rows(only_inc, "rowkey")} == {"r2"}


def test_bag_difference(spark):
    a = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), ("c", 2)], "k string, v int")
    b = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2)], "k string, v int")
    assert sorted(rows(setops.subtract_rows(a, b))) == [("b", 1), ("b", 1)]
    assert rows(setops.subtract_by_key(a, b, ["k"])) == []
    n = spark.createDataFrame([(None, 1), ("x", 1)], "k string, v int")
    assert rows(setops.subtract_rows(n, n.limit(1).filter("k is null"))) == [("x", 1)]


def test_upsert_unique_keys(spark):
    old = spark.createDataFrame([("t1", 1), ("t2", 2)], "time string, n int")
    new = spark.createDataFrame([("t2", 20), ("t3", 30)], "time string, n int")
    assert sorted(rows(sinks.upsert(old, new, ["time"]))) == [("t1", 1), ("t2", 20), ("t3", 30)]


def test_rekey_messages(spark):
    links = spark.createDataFrame([("a", "C"), ("b", "D")], "org_id string, connect_id string")
    m = spark.createDataFrame([("a-1-t1", "a", "x", 1, "t1"), ("y-2-t2", "y", "b", 2, "t2"),
                               ("a-3-t3", "a", "b", 3, "t3"), ("z-4-t4", "z", "w", 4, "t4")],
                              "mid string, user string, party string, timesent long, platform_msg_id string")
    got = sorted(rows(merge.rekey_messages(m, links), "mid", "user", "party"))
    assert got == [("C-1-t1", "C", "x"), ("C-3-t3", "C", "D"), ("y-2-t2", "y", "D"), ("z-4-t4", "z", "w")]


def test_link_flatten(spark):
    stored = spark.createDataFrame([("a", "C1"), ("b", "C1"), ("e", "C9")], "org_id string, connect_id string")
    new = spark.createDataFrame([("C1", "C2"), ("d", "C2"), ("C2", "C3")], "org_id string, connect_id string")
    out, cycles = merge.flatten_links(stored, new)
    assert sorted(rows(out)) == [("C2", "C3"), ("a", "C3"), ("b", "C3"), ("d", "C3"), ("e", "C9")]
    assert rows(cycles) == []
    cyc = spark.createDataFrame([("p", "q"), ("q", "p")], "org_id string, connect_id string")
    out2, cycles2 = merge.flatten_links(stored.limit(0), cyc)
    assert rows(out2) == [] and sorted(rows(cycles2)) == [("p", "p"), ("q", "q")]


def test_resolve_keeps_unlinked(spark):
    links = spark.createDataFrame([("a", "C")], "org_id string, connect_id string")
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "rowkey string, v int")
    got = rows(resolve.resolve_column(df, links, "rowkey"))
    assert sorted(got, key=str) == sorted([("C", 1), (None, 3), ("b", 2)], key=str)


def test_merge_profiles_policy(spark):
    prof = spark.createDataFrame([
        ("a", "PHONE", "1\x022"), ("b", "PHONE", "3"), ("a", "MSG_COUNT", "2"), ("b", "MSG_COUNT", "5"),
        ("a", "CONTACT", "b|pa"), ("b", "NAME", "name:Bo|platforms:a-pa,x-pc|score:2"),
        ("a", "RELATION", "r"), ("a", "OTHER", "o")], "rowkey string, field string, value string")
    links = spark.createDataFrame([("a", "C"), ("b", "C")], "org_id string, connect_id string")
    packed_ = {r.field: r.value for r in merge.pack_entries(merge.merge_profiles(prof, links)).collect()}
    assert packed_ == {"PHONE": "1\x022\x023", "MSG_COUNT": "7", "CONTACT": "C|pa",
                       "NAME": "name:Bo|platforms:C-pa,x-pc|score:2"}


def _brute_scores(tok_rows, weights, threshold, block_attr="phone"):
    sets = {}
    for r, a, v in tok_rows:
        sets.setdefault(r, {}).setdefault(a, set()).add(v)
    ids = sorted(sets)
    out = {}
    for x, y in itertools.combinations(ids, 2):
        if not (sets[x].get(block_attr, set()) & sets[y].get(block_attr, set())):
            continue
        s = 0.0
        for k, w in weights.items():
            A, B = sets[x].get(k, set()), sets[y].get(k, set())
            if A | B:
                s += w * 100.0 * len(A & B) / len(A | B)
        s = round(s, 6)
        if s >= threshold:
            out[(x, y)] = s
    return out


@pytest.mark.parametrize("seed,threshold,hot,ranked", [(1, 50.0, 3, 100), (2, 35.0, 2, 100), (3, 70.0, 64, 100),
                                                        (4, 20.0, 2, 100), (5, 60.0, 1, 100), (6, 45.0, 2, 2)])
def test_pair_scores_equal_brute_force(spark, seed, threshold, hot, ranked):
    """The pruned scorer returns exactly the brute-force pairs, with hot
    blocks, hot tokens and multi-phone ids present."""
    rnd = random.Random(seed)
    weights = {"phone": 0.3, "name": 0.3, "mail": 0.2, "contacts": 0.2}
    toks = set()
    for i in range(60):
        r = f"id{i:03d}"
        for _ in range(rnd.choice([1, 1, 2])):
            toks.add((r, "phone", rnd.choice(["P0", "P0", "P0", "P1", "P2", f"Q{i}"])))
        for _ in range(rnd.randint(0, 3)):
            toks.add((r, "name", rnd.choice(["ann", "bo", "cy", "hot", "hot", f"n{i}"])))
        if rnd.random() < 0.6:
            toks.add((r, "mail", rnd.choice(["m1", "m2", "hotmail", "hotmail"])))
        for _ in range(rnd.randint(0, 6)):
            toks.add((r, "contacts", f"c{rnd.randint(0, 12)}"))
    df = spark.createDataFrame(sorted(toks), "rowkey string, attr string, value string")
    got = {(r.rowkey_a, r.rowkey_b): r.score for r in
           match.pair_scores(df, threshold, weights, hot_postings=hot, max_ranked_set=ranked).collect()}
    want = _brute_scores(toks, weights, threshold)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-6)


def test_block_keys(spark):
    df = spark.createDataFrame([("a", "phone", "1"), ("b", "phone", "1"), ("c", "phone", "2")],
                               "rowkey string, attr string, value string")
    assert sorted(rows(match.block_keys(df))) == [("1", "a"), ("1", "b")]


def test_region_longest_prefix(spark):
    from idweave.operators.enrich import region_lookup
    users = spark.createDataFrame([("r1", "0211", "t"), ("r2", "0299", "t"), ("r3", "77", "t"), ("r4", "null", "t")],
                                  "rowkey string, phone string, platform string")
    pre = spark.createDataFrame([("02", "C", "P", None, None), ("021", "C", "P", "city", "021")],
                                "prefix string, country string, province string, city string, code string")
    got = sorted(rows(region_lookup(users, pre), "rowkey", "city", "code"))
    assert got == [("r1", "city", "021"), ("r2", "Unknown", None), ("r3", "Unknown", None)]


def test_load_profiles_composition(spark):
    from idweave.operators.conform import to_user_model
    from idweave.plans.pipelines import load_profiles
    users = to_user_model(spark.createDataFrame(
        [("a", "Ann", "s1", "a@x", "1", "pa"), ("b", "Bo", "s2", "a@x", "null", "pc")],
        "rowkey string, name string, name_source string, mail string, phone string, platform string"), is_user=1)
    edges = spark.createDataFrame([("a", "b", "Bo", "pa")], "u_uid string, c_uid string, name string, platform string")
    regions = spark.createDataFrame([("a", "C", "P", "Unknown", None, "1", "pa")],
                                    "rowkey string, country string, province string, city string, code string, "
                                    "phone string, platform string")
    links = spark.createDataFrame([("b", "a")], "org_id string, connect_id string")
    ev = load_profiles(users, edges, regions, links)
    got = {(r.rowkey, r.attr, r.value, r.score) for r in ev.collect()}
    assert ("a", "mail", "a@x", 2) in got            # two platforms after b -> a
    assert ("a", "contacts", "a", 1) in got and ("a", "be_contacts", "a", 1) in got
    assert not any(r[0] == "b" for r in got)
    again = load_profiles(users, edges, regions, links, stored=ev)
    assert {(r.rowkey, r.attr, r.value, r.score) for r in again.collect()} == got


def test_ordered_cells_of_hot_keys(spark):
    from idweave.operators.lists import ordered_cells
    df = spark.createDataFrame([("hot", f"v{i:03d}") for i in range(250)] + [("cold", "b"), ("cold", "a")],
                               "k string, v string")
    out = ordered_cells(df.repartition(5), ["k"], "v", ",", max_entries=100).collect()
    cold = [r for r in out if r.k == "cold"]
    assert [(r.part, r.value) for r in cold] == [(0, "a,b")]
    hot = sorted((r.part, r.value.split(",")) for r in out if r.k == "hot")
    assert [len(v) for _, v in hot] == [100, 100, 50] and [p for p, _ in hot] == [0, 1, 2]
    assert [x for _, v in hot for x in v] == [f"v{i:03d}" for i in range(250)]


def test_link_flatten_long_chain(spark):
    new = spark.createDataFrame([(f"c{i}", f"c{i + 1}") for i in range(12)], "org_id string, connect_id string")
    out, cycles = merge.flatten_links(new.limit(0), new)
    assert sorted(rows(out)) == sorted((f"c{i}", "c12") for i in range(12)) and rows(cycles) == []


def test_link_cycles_and_conflicts(spark):
    schema = "org_id string, connect_id string"
    none = spark.createDataFrame([], schema)
    for n in (2, 3, 5, 7):  # cycles of any length, with a tail
        ring = [(f"r{i}", f"r{(i + 1) % n}") for i in range(n)] + [("tail", "r0"), ("x", "Y"), ("s", "s")]
        out, cycles = merge.flatten_links(none, spark.createDataFrame(ring, schema))
        assert rows(out) == [("x", "Y")]
        assert sorted(r.org_id for r in cycles.collect()) == sorted(["tail", *(f"r{i}" for i in range(n))])
    both = spark.createDataFrame([("a", "C1"), ("a", "C2"), ("b", "C2")], schema)  # two requests join their groups
    assert sorted(rows(merge.flatten_links(none, both)[0])) == [("C2", "C1"), ("a", "C1"), ("b", "C1")]


def test_second_generation_merge(spark):
    from idweave.plans import pipelines
    schema = "org_id string, connect_id string"
    stored = spark.createDataFrame([("a", "C1"), ("b", "C1")], schema)
    requests = spark.createDataFrame([("C1", "C2", 1, "t"), ("n", "C2", 1, "t")], schema + ", status int, insert_time string")
    cells = spark.createDataFrame([("a", "MSG_COUNT", "1"), ("b", "MSG_COUNT", "2"), ("C1", "MSG_COUNT", "10"), ("n", "MSG_COUNT", "5")],
                                  "rowkey string, field string, value string")
    msgs = spark.createDataFrame([("C1-5-9", "C1", "z", 5, "9"), ("a-6-8", "a", "C1", 6, "8")],
                                 "mid string, user string, party string, timesent long, platform_msg_id string")
    groups = spark.createDataFrame([("C1", "t")], "sender string, text string")
    edges = spark.createDataFrame([("C1", "n", "x"), ("a", "C1", "x")], "u_uid string, c_uid string, name string")
    out = pipelines.identity_merge_job(cells, msgs, groups, edges, stored, requests, "t")
    assert rows(out["profiles"], "connect_id", "entry") == [("C2", "15")]  # C1's own cells and n's, not a's and b's again
    assert sorted(rows(out["messages"], "mid", "user", "party")) == [("C2-5-9", "C2", "z"), ("C2-6-8", "C2", "C2")]
    assert rows(out["group_messages"], "sender") == [("C2",)]
    assert sorted(rows(out["edges"])) == [("C2", "C2", "x")]
    assert sorted(rows(out["links"])) == [("a", "C2"), ("b", "C2"), ("n", "C2")]
    assert {r.rowkey for r in out["archive"].collect()} == {"n"}


def test_remap_in_array(spark):
    links = spark.createDataFrame([("a", "C")], "org_id string, connect_id string")
    df = spark.createDataFrame([("k", ["a", "b", "a"])], "key string, ids array<string>")
    got = sorted(rows(resolve.remap_in_array(df, links, "key", "ids"), "pos", "element", "new_id"))
    assert got == [(0, "a", "C"), (1, "b", "b"), (2, "a", "C")]


def test_merge_profile_rows_and_pivot(spark):
    vt = T.StructType([T.StructField("evidence", T.ArrayType(T.StringType())), T.StructField("score", T.IntegerType())])
    mt = T.MapType(T.StringType(), vt)
    schema = T.StructType([T.StructField("rowkey", T.StringType()), T.StructField("mail", mt),
                           T.StructField("contacts", mt)])
    stored = spark.createDataFrame([("r1", {"a@x": (["p1"], 1)}, {"u": (["n|p"], 1)}), ("r9", {"z@x": (["p"], 1)}, None)],
                                   schema)
    inc = spark.createDataFrame([("r1", {"a@x": (["p2"], 1)}, None), ("r2", None, {"v": (["n|p"], 1)})], schema)
    left = {r.rowkey: r for r in profiles.merge_profile_rows(stored, inc, ["mail", "contacts"], vt).collect()}
    assert set(left) == {"r1", "r2"}
    assert (left["r1"].mail["a@x"].evidence, left["r1"].mail["a@x"].score) == (["p1", "p2"], 2)
    assert left["r1"].contact_count == 1 and left["r2"].mail is None and left["r2"].contact_count == 1
    snap = {r.rowkey for r in profiles.merge_profile_rows(stored, inc, ["mail", "contacts"], vt, snapshot=True).collect()}
    assert snap == {"r1", "r2", "r9"}
    ev = spark.createDataFrame([("r1", "mail", "a@x", ("p",)), ("r1", "phone", "1", ("p",))],
                               "rowkey string, attr string, value string, ev struct<platform:string>")
    wide = profiles.pivot_profiles(profiles.to_nested(ev), ["mail", "phone"]).first()
    assert wide.mail["a@x"].score == 1 and wide.phone["1"].evidence[0].platform == "p"


def test_salted_resolution_equals_plain(spark):
    links = spark.createDataFrame([("hot", "C"), ("x", "D")], "org_id string, connect_id string")
    df = spark.createDataFrame([("hot", i) for i in range(500)] + [("x", 1), ("y", 2), (None, 3)], "rowkey string, v int")
    plain = sorted(rows(resolve.resolve_column(df, links, "rowkey")), key=str)
    salted = sorted(rows(resolve.resolve_column(df, links, "rowkey", salt_buckets=8)), key=str)
    assert plain == salted and len(salted) == 503


def test_merge_ids_repeatable(spark):
    a = rows(merge.merge_ids(spark, ["u2", "u1"]))
    b = rows(merge.merge_ids(spark, ["u1", "u2"]))
    assert {x[1] for x in a} == {x[1] for x in b} and len({x[1] for x in a}) == 1
    assert sorted(x[0] for x in a) == ["u1", "u2"]


def test_small_helpers(spark):
    from idweave.operators.conform import split_rejects, to_user_model
    links = spark.createDataFrame([("a", "C2", 2), ("a", "C1", 1), ("b", "C1", 5)], "org_id string, connect_id string, t int")
    assert sorted(rows(resolve.latest_links(links, "t"))) == [("a", "C2"), ("b", "C1")]
    assert sorted(rows(resolve.latest_links(links.drop("t")))) == [("a", "C1"), ("b", "C1")]
    users = to_user_model(spark.createDataFrame([("k1", "1"), (None, "2")], "rowkey string, userid string"))
    good, bad = split_rejects(users)
    assert rows(good, "userid") == [("1",)] and rows(bad, "userid") == [("2",)]
    pairs = spark.createDataFrame([("a", "b", 80.0)], "rowkey_a string, rowkey_b string, score double")
    assert rows(match.links_from_pairs(pairs)) == [("b", "a")]
    tok = spark.createDataFrame([("a", "phone", "1"), ("b", "phone", "1"), ("a", "name", "x"), ("b", "name", "y")],
                                "rowkey string, attr string, value string")
    sizes = tok.groupBy("rowkey", "attr").count().withColumnRenamed("count", "n")
    cand = spark.createDataFrame([("a", "b")], "ra string, rb string")
    got = rows(match.score_pairs(cand, tok, sizes, {"phone": 0.5, "name": 0.5}, "phone", None))
    assert got == [("a", "b", 50.0)]


def test_rekey_leaves_no_linked_ids(spark):
    links = spark.createDataFrame([("a", "C"), ("b", "C"), ("d", "E")], "org_id string, connect_id string")
    edges = spark.createDataFrame([("a", "b", "n", "p"), ("a", "x", "n", "p"), ("d", "a", "m", "q"), ("x", "y", "k", "p")],
                                  "u_uid string, c_uid string, name string, platform string")
    out = merge.rekey_edges(edges, links)
    ids = {v for r in out.collect() for v in (r.u_uid, r.c_uid)}
    assert not ids & {"a", "b", "d"}
    assert ("C", "C") in {(r.u_uid, r.c_uid) for r in out.collect()}          # self edge kept by default
    assert ("C", "C") not in {(r.u_uid, r.c_uid) for r in merge.rekey_edges(edges, links, drop_self=True).collect()}


def test_weighted_jaccard_properties(spark):
    from idweave.functions.similarity import weighted_jaccard
    rnd = random.Random(11)
    attrs = ["phone", "name", "mail", "contacts"]
    data = []
    for _ in range(200):
        a = [rnd.sample("abcdef", rnd.randint(0, 4)) for _ in attrs]
        b = [rnd.sample("abcdef", rnd.randint(0, 4)) for _ in attrs]
        data.append(tuple(a + b))
    data.append(tuple([["x"], ["y"], ["z"], ["w"]] * 2))                     # identical, all non-empty
    schema = ", ".join(f"{s}_{k} array<string>" for s in "ab" for k in attrs)
    df = spark.createDataFrame(data, schema)
    ab = weighted_jaccard({k: (f"a_{k}", f"b_{k}") for k in attrs})
    ba = weighted_jaccard({k: (f"b_{k}", f"a_{k}") for k in attrs})
    got = df.select(ab.alias("ab"), ba.alias("ba")).collect()
    assert all(abs(r.ab - r.ba) < 1e-9 and -1e-9 <= r.ab <= 100 + 1e-9 for r in got)
    assert round(got[-1].ab, 6) == 100.0


@pytest.mark.parametrize("case", ["skip", "no_skip"])
def test_pair_scores_hot_branches(spark, case):
    rnd = random.Random(3)
    weights = {"phone": 0.3, "name": 0.3, "mail": 0.2, "contacts": 0.2}
    toks = set()
    for i in range(40):
        r = f"id{i:02d}"
        toks.add((r, "phone", "P0" if i < 30 else "P1"))
        if case == "skip":       # big contact sets, one hot contact: hot share 1/9
            toks.add((r, "contacts", "HOTC"))
            for c in rnd.sample(range(60), 8):
                toks.add((r, "contacts", f"c{c}"))
            toks.add((r, "name", f"n{i % 13}"))
        else:                    # tiny name sets made only of a hot value: hot share 1
            toks.add((r, "name", "HOTN"))
            toks.add((r, "mail", f"m{i % 4}"))
    df = spark.createDataFrame(sorted(toks), "rowkey string, attr string, value string")
    tok = df.filter(F.col("attr").isin(list(weights)))
    sizes = tok.groupBy("rowkey", "attr").agg(F.count(F.lit(1)).alias("n"))
    blocks = match.block_keys(tok)
    tb = tok.join(blocks, "rowkey")
    post = tb.groupBy("gid", "attr", "value").agg(F.count(F.lit(1)).alias("f"))
    hot = tb.join(post, ["gid", "attr", "value"]).filter(F.col("f") > 5)
    assert match._hot_tokens_cannot_qualify(hot, sizes, weights, "phone", 50.0) == (case == "skip")
    got = {(r.rowkey_a, r.rowkey_b): r.score for r in match.pair_scores(df, 50.0, weights, hot_postings=5).collect()}
    want = _brute_scores(toks, weights, 50.0)
    assert got.keys() == want.keys() and len(want) > 0
