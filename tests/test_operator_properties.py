"""Operators against plain-Python statements of their rules on random inputs."""

import collections
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idweave.operators import latest, merge, profiles, setops
from idweave.sources import sinks

from .conftest import rows

SEEDS = [1, 2, 3]


@pytest.mark.parametrize("seed", SEEDS)
def test_map_merge_rule(spark, seed):
    rnd = random.Random(seed)
    vt = T.StructType([T.StructField("evidence", T.ArrayType(T.StringType())), T.StructField("score", T.IntegerType())])
    mt = T.MapType(T.StringType(), vt)

    def rmap():
        if rnd.random() < 0.15:
            return None
        m = {}
        for k in rnd.sample("abcdef", rnd.randint(0, 4)):
            ev = list(dict.fromkeys(rnd.choice("xyz") for _ in range(rnd.randint(1, 3))))
            m[k] = (ev, len(ev))
        return m

    data = [(rmap(), rmap()) for _ in range(60)]
    df = spark.createDataFrame(data, T.StructType([T.StructField("s", mt), T.StructField("i", mt)]))
    got = df.select(profiles.merge_maps(profiles.coalesce_map(F.col("s"), vt),
                                        profiles.coalesce_map(F.col("i"), vt)).alias("m")).collect()
    for (s, i), r in zip(data, got):
        s, i = s or {}, i or {}
        want = {}
        for k in set(s) | set(i):
            if k in s and k in i:
                ev = s[k][0] + [x for x in i[k][0] if x not in s[k][0]]
                want[k] = (ev, len(ev))
            else:
                want[k] = s.get(k) or i.get(k)
        assert {k: (v.evidence, v.score) for k, v in (r.m or {}).items()} == want


@pytest.mark.parametrize("seed", SEEDS)
def test_bag_difference_rule(spark, seed):
    rnd = random.Random(seed)
    left = [(rnd.choice(["a", "b", None]), rnd.randint(0, 2)) for _ in range(80)]
    right = [(rnd.choice(["a", "c", None]), rnd.randint(0, 2)) for _ in range(10)]
    got = sorted(rows(setops.subtract_rows(spark.createDataFrame(left, "k string, v int"),
                                           spark.createDataFrame(right, "k string, v int"))), key=str)
    rset = set(right)
    assert got == sorted([r for r in left if r not in rset], key=str)


@pytest.mark.parametrize("seed", SEEDS)
def test_latest_with_ties_rule(spark, seed):
    rnd = random.Random(seed)
    data = [(f"u{rnd.randint(0, 5)}", rnd.randint(0, 6), rnd.randint(0, 1), f"r{i}") for i in range(120)]
    df = spark.createDataFrame(data, "k string, ts long, t int, id string")
    got = sorted(rows(latest.latest_with_count(df, ["k"], "ts", F.col("t") == 0), "k", "id", "count"))
    typed = [r for r in data if r[2] == 0]
    cnt = collections.Counter(r[0] for r in typed)
    mx = {k: max(r[1] for r in typed if r[0] == k) for k in cnt}
    assert got == sorted((r[0], r[3], cnt[r[0]]) for r in typed if r[1] == mx[r[0]])


@pytest.mark.parametrize("seed", SEEDS)
def test_link_flatten_rule(spark, seed):
    rnd = random.Random(seed)
    stored = {f"o{i}": f"C{rnd.randint(0, 4)}" for i in range(30)}
    # new generation: some canonical ids and new originals point further, without cycles
    new = {f"C{i}": f"D{rnd.randint(0, 2)}" for i in rnd.sample(range(5), 3)}
    new.update({f"n{i}": rnd.choice([f"C{j}" for j in range(5)] + ["D0", "D1"]) for i in range(6)})
    new.update({f"D{i}": "E0" for i in range(2)})
    out, cycles = merge.flatten_links(spark.createDataFrame(list(stored.items()), "org_id string, connect_id string"),
                                      spark.createDataFrame(list(new.items()), "org_id string, connect_id string"))

    allmap = {k: v for k, v in stored.items() if k not in new}
    allmap.update(new)

    def root(x):
        while x in allmap:
            x = allmap[x]
        return x

    old_canon = set(stored.values())
    want = sorted((k, root(k)) for k in allmap if k not in old_canon)
    assert sorted(rows(out)) == want and rows(cycles) == []


@pytest.mark.parametrize("seed", SEEDS)
def test_upsert_rule(spark, seed):
    rnd = random.Random(seed)
    old = {f"k{i}": rnd.randint(0, 9) for i in rnd.sample(range(20), 12)}
    new = {f"k{i}": rnd.randint(10, 19) for i in rnd.sample(range(20), 8)}
    got = dict(rows(sinks.upsert(spark.createDataFrame(list(old.items()), "k string, v int"),
                                 spark.createDataFrame(list(new.items()), "k string, v int"), ["k"])))
    assert got == {**old, **new}


@pytest.mark.parametrize("seed", SEEDS)
def test_merge_profiles_rule(spark, seed):
    """Policy merge against a Python rendering: concat in (org, position)
    order, integer sums, ids inside CONTACT entries remapped."""
    rnd = random.Random(seed)
    orgs = [f"o{i}" for i in range(8)]
    links = {o: f"C{rnd.randint(0, 2)}" for o in orgs}
    cells = []
    for o in orgs:
        if rnd.random() < 0.8:
            cells.append((o, "PHONE", "\x02".join(str(rnd.randint(100, 999)) for _ in range(rnd.randint(1, 3)))))
        if rnd.random() < 0.8:
            cells.append((o, "MSG_COUNT", str(rnd.randint(0, 50))))
        if rnd.random() < 0.8:
            cells.append((o, "CONTACT", "\x02".join(f"{rnd.choice(orgs + ['x', 'y'])}|p{rnd.randint(0, 1)}"
                                                     for _ in range(rnd.randint(1, 3)))))
    df = spark.createDataFrame(cells, "rowkey string, field string, value string")
    lk = spark.createDataFrame(list(links.items()), "org_id string, connect_id string")
    got = {(r.connect_id, r.field): r.value for r in merge.pack_entries(merge.merge_profiles(df, lk)).collect()}
    want = {}
    for c in set(links.values()):
        members = sorted(o for o in orgs if links[o] == c)
        for field in ("PHONE", "CONTACT"):
            parts = []
            for o in members:
                for v in [v for (r, f, v) in cells if r == o and f == field]:
                    for e in v.split("\x02"):
                        if field == "CONTACT":
                            i, rest = e.split("|", 1)
                            e = links.get(i, i) + "|" + rest
                        parts.append(e)
            if parts:
                want[(c, field)] = "\x02".join(parts)
        counts = [int(v) for (r, f, v) in cells if f == "MSG_COUNT" and links[r] == c]
        if counts:
            want[(c, "MSG_COUNT")] = str(sum(counts))
    assert got == want


@pytest.mark.parametrize("seed", SEEDS)
def test_narrow_key_dedup_equals_reference_shape(spark, seed):
    """T8 on raw source rows (group by raw columns, min token, derive keys)
    gives exactly the rows of the reference shape (derive keys, group by
    all derived columns, min mid)."""
    from idweave.plans import pipelines
    rnd = random.Random(seed)
    texts = ["hi", "Ann is back on Tango, x", "Bo也登入 Tangoo", "hey"]
    src = [(str(rnd.randint(1, 4)), str(rnd.randint(1, 3)), rnd.randint(0, 3), f"t{rnd.randint(0, 30)}.{i % 3}",
            rnd.choice(texts), rnd.choice(["m1", "m2"]), rnd.choice(["d"]), rnd.randint(0, 1)) for i in range(300)]
    df = spark.createDataFrame(src, "useruid string, partyuid string, timesent long, messagetoken string, "
                                    "mtext string, media string, direction string, msgtype int")
    narrow = pipelines.clean_messages_from_source(df, "pa", "pa", "pa")
    wide = pipelines.clean_messages(pipelines.message_rows(df, "pa", "pa", "pa"))
    assert sorted(rows(narrow), key=str) == sorted(rows(wide.select(*narrow.columns)), key=str)


@pytest.mark.parametrize("seed", SEEDS)
def test_region_longest_prefix_rule(spark, seed):
    from idweave.operators.enrich import region_lookup
    rnd = random.Random(seed)
    prefixes = {}
    for _ in range(25):
        p = "".join(rnd.choice("0123") for _ in range(rnd.randint(1, 4)))
        prefixes[p] = (f"C{p}", "P", None, None)
    phones = sorted({("r" + str(i), "".join(rnd.choice("0123") for _ in range(rnd.randint(3, 8))), "pa")
                     for i in range(60)})
    pre = spark.createDataFrame([(k, *v) for k, v in prefixes.items()],
                                "prefix string, country string, province string, city string, code string")
    got = {(r.rowkey, r.phone): r.country for r in
           region_lookup(spark.createDataFrame(phones, "rowkey string, phone string, platform string"), pre).collect()}
    for rk, ph, _ in phones:
        best = max((p for p in prefixes if ph.startswith(p)), key=len, default=None)
        assert got[(rk, ph)] == (prefixes[best][0] if best else "Unknown")


@pytest.mark.parametrize("seed", SEEDS)
def test_dedup_and_daily_counters_rules(spark, seed):
    from idweave.operators.counts import daily_counters
    from idweave.operators.dedup import dedup_keep_min
    rnd = random.Random(seed)
    data = [(f"id{rnd.randint(0, 50)}", rnd.choice(["a", "b", None]), rnd.randint(0, 2)) for _ in range(150)]
    got = sorted(rows(dedup_keep_min(spark.createDataFrame(data, "mid string, c string, v int"), "mid")), key=str)
    groups = collections.defaultdict(list)
    for mid, c, v in data:
        groups[(c, v)].append(mid)
    assert got == sorted(((min(m), c, v) for (c, v), m in groups.items()), key=str)

    days = ["20240101", "20240102"]
    ev = [(rnd.choice(days), rnd.choice([1, 2, 3, None])) for _ in range(40)]
    mids = [(rnd.choice(days), rnd.choice(["m1", "m2", None])) for _ in range(40)]
    u = spark.createDataFrame(ev, "day string, uid int")
    m = spark.createDataFrame(mids, "day string, mid string")
    out = {r.day: r for r in daily_counters([u], u.select("day", "uid"), m, m).collect()}
    for d in days:
        assert out[d].user_count == len({x for (dd, x) in ev if dd == d})          # NULL is a group (D8)
        assert out[d].message_count == len({x for (dd, x) in mids if dd == d})
        assert out[d].contact_count == len({(dd, x) for (dd, x) in ev if dd == d})
