"""Hot keys: one pair / one id holding about a third of all rows. Results must
equal a DuckDB computation over the same rows."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from idweave.operators import counts, profiles, resolve


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(30000):
        hot = i % 3 == 0
        user = "HOT" if hot else f"u{rnd.randint(0, 400)}"
        party = "P0" if hot else f"p{rnd.randint(0, 60)}"
        ts = 1000 if (hot and i % 7 == 0) else rnd.randint(0, 999)   # many ties at the hot pair's last time
        rows.append((f"m{i}", user, party, ts, rnd.randint(0, 1), f"c{rnd.randint(0, 5)}", "pmid", "pu", "pf"))
    cols = ["mid", "user", "party", "timesent", "msgtype", "content", "platform_msg_id", "partyuid", "platform"]
    pdf = pd.DataFrame(rows, columns=cols)
    sdf = spark.createDataFrame(pdf).repartition(8)
    return pdf, sdf


def _duck(pdf, sql):
    con = duckdb.connect()
    con.register("m", pdf)
    return sorted(tuple(r) for r in con.execute(sql).fetchall())


def test_latest_with_hot_pair(spark, skewed):
    pdf, sdf = skewed
    got = sorted(tuple(r) for r in counts.pair_count_latest(sdf).select("uuid", "count", "content", "timesent")
                 .collect())
    want = _duck(pdf, """
        SELECT DISTINCT t."user" || '-' || t.party, c.n, t.content, t.timesent FROM
          (SELECT *, rank() OVER (PARTITION BY "user", party ORDER BY timesent DESC) rk FROM m WHERE msgtype = 0) t
          JOIN (SELECT "user", party, count(*) n FROM m WHERE msgtype = 0 GROUP BY 1, 2) c USING ("user", party)
        WHERE rk = 1""")
    assert got == want
    hot = [r for r in got if r[0] == "HOT-P0"]
    assert len(hot) > 1 and hot[0][1] > 4000          # ties kept, full count of the hot pair


def test_join_back_with_hot_pair(spark, skewed):
    pdf, sdf = skewed
    got = sorted(tuple(r) for r in counts.pair_count_latest(sdf, join_back=True)
                 .select("uuid", "count", "content", "timesent").collect())
    want = _duck(pdf, """
        SELECT DISTINCT m."user" || '-' || m.party, a.n, m.content, m.timesent FROM m JOIN
          (SELECT "user", party, count(*) n, max(timesent) mx FROM m WHERE msgtype = 0 GROUP BY 1, 2) a
          ON m."user" = a."user" AND m.party = a.party AND m.timesent = a.mx""")
    assert got == want


def test_totals_and_resolution_with_hot_id(spark, skewed):
    pdf, sdf = skewed
    got = sorted(tuple(r) for r in counts.total_per_person(sdf).collect())
    want = _duck(pdf, """SELECT u, count(DISTINCT mid) FROM
                         (SELECT "user" u, mid FROM m UNION ALL SELECT party, mid FROM m) GROUP BY u""")
    assert got == want
    links = spark.createDataFrame([("HOT", "C1"), ("u1", "C1")], "org_id string, connect_id string")
    res = resolve.resolve_column(sdf, links, "user")
    n_c1 = res.filter(F.col("user") == "C1").count()
    assert n_c1 == int(((pdf.user == "HOT") | (pdf.user == "u1")).sum())
    assert res.count() == len(pdf)


def test_profile_score_with_hot_profile(spark, skewed):
    pdf, sdf = skewed
    ev = sdf.select(F.col("user").alias("rowkey"), F.lit("party").alias("attr"), F.col("party").alias("value"),
                    F.struct(F.col("content").alias("platform")).alias("ev")).distinct()
    got = sorted((r.rowkey, r.value, r.score) for r in profiles.score(ev).select("rowkey", "value", "score")
                 .distinct().collect())
    want = _duck(pdf, 'SELECT "user", party, count(DISTINCT content) FROM m GROUP BY 1, 2')
    assert got == want
