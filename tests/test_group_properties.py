"""J6 / A9 against plain-Python statements of the rules on random group messages."""

import collections
import random

import pytest

from idweave.operators import counts


@pytest.mark.parametrize("seed", [1, 2])
def test_group_latest_and_totals_rule(spark, seed):
    rnd = random.Random(seed)
    gm = [(f"m{i}", f"g{rnd.randint(0, 5)}", "pa", rnd.randint(0, 8), rnd.randint(0, 1), f"s{rnd.randint(0, 3)}",
           f"c{i}", "media", f"t{i}") for i in range(150)]
    df = spark.createDataFrame(gm, "mid string, gid string, platform string, timesent long, msgtype int, "
                                   "sender string, content string, media string, platform_msg_id string")
    got = sorted((r.guid, r.sender, r["count"], r.content, r.timesent) for r in counts.group_count_latest(df).collect())
    typed = [g for g in gm if g[4] == 1]
    n = collections.Counter(g[1] for g in typed)
    mx = {k: max(g[3] for g in typed if g[1] == k) for k in n}
    # the latest time comes from type-1 messages; rows of any type at that time are kept
    want = sorted((f"pa-{g[1]}", g[5], n[g[1]], g[6], g[3]) for g in gm if g[1] in mx and g[3] == mx[g[1]])
    assert got == want
    totals = {r.guid: r["count"] for r in counts.group_totals(df).collect()}
    assert totals == {f"pa-{k}": v for k, v in collections.Counter(g[1] for g in gm).items()}
