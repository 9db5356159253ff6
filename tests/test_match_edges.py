"""Pair scoring edge cases: no shared block, empty input."""

from idweave.operators import match


def test_no_blocks_and_empty_input(spark):
    toks = spark.createDataFrame([("a", "phone", "1"), ("b", "phone", "2"), ("a", "name", "x"), ("b", "name", "x")],
                                 "rowkey string, attr string, value string")
    assert match.pair_scores(toks, 10.0).count() == 0
    empty = toks.limit(0)
    assert match.pair_scores(empty, 50.0).count() == 0
    assert match.block_keys(empty).count() == 0


def _jaccard_pairs(toks, weights, threshold):
    sets = {}
    for r, a, v in toks:
        sets.setdefault(r, {}).setdefault(a, set()).add(v)
    out = {}
    for a in sets:
        for b in sets:
            if a < b and sets[a].get("phone", set()) & sets[b].get("phone", set()):
                parts = [(w, sets[a].get(k, set()), sets[b].get(k, set())) for k, w in weights.items()]
                score = sum(100 * w * len(x & y) / len(x | y) for w, x, y in parts if x | y)
                if score >= threshold:
                    out[a, b] = round(score, 6)
    return out


def test_pairs_of_a_hot_list_are_scored_where_they_meet(spark):
    """One mail held by most ids of a block, in tiles of three; one id with a set too large for a row."""
    weights = {"phone": 0.3, "name": 0.3, "mail": 0.2, "contacts": 0.2}
    toks = {(f"i{i:02}", "phone", p) for i in range(40) for p in ({"P0", "P1"} if i % 5 == 0 else {"P0"} if i < 30 else {"P1"})}
    toks |= {(f"i{i:02}", "mail", "hot" if i % 4 else f"m{i}") for i in range(40)}
    toks |= {(f"i{i:02}", "name", n) for i in range(40) for n in (f"n{i % 17}", "seg" if i % 2 else "ment")}
    toks |= {(f"i{i:02}", "contacts", f"c{(i * j) % 11}") for i in range(40) for j in range(1, 5)}
    toks |= {("i03", "contacts", f"d{j}") for j in range(30)}
    df = spark.createDataFrame(sorted(toks), "rowkey string, attr string, value string")
    want = _jaccard_pairs(toks, weights, 50.0)
    plain = match.pair_scores(df, 50.0, weights)
    text = plain._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in text and "Aggregate" not in text    # no pair is moved or grouped
    for got in (plain, match.pair_scores(df, 50.0, weights, tile=3), match.pair_scores(df, 50.0, weights, tile=3, max_ranked_set=20)):
        found = got.collect()
        assert len(found) == len(want) > 100
        assert {(r.rowkey_a, r.rowkey_b): r.score for r in found} == want
