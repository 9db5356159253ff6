"""J3 against a plain-Python statement of the rule on random messages."""

import random

import pytest

from idweave.operators import resolve


@pytest.mark.parametrize("seed", [1, 2])
def test_resolve_messages_rule(spark, seed):
    rnd = random.Random(seed)
    links = {f"u{i}": f"C{rnd.randint(0, 2)}" for i in rnd.sample(range(10), 5)}
    msgs = [(f"m{i}", f"u{rnd.randint(0, 9)}", f"u{rnd.randint(0, 9)}", rnd.randint(0, 99), f"t{i}") for i in range(80)]
    df = spark.createDataFrame(msgs, "mid string, user string, party string, timesent long, platform_msg_id string")
    lk = spark.createDataFrame(list(links.items()), "org_id string, connect_id string")
    got = sorted((r.mid, r.user, r.party, r.platform_msg_id) for r in resolve.resolve_messages(df, lk).collect())
    want = []
    for _mid, u, p, ts, tok in msgs:
        nu, np_ = links.get(u, u), links.get(p, p)
        want.append((f"{nu}-{ts}-{tok}", nu, np_, tok))
    assert got == sorted(want)
