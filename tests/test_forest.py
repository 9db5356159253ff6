"""Splits to earlier generations against a plain walk of the link log."""

import random

from idweave.operators import forest

LOG = "generation bigint, org_id string, connect_id string"


def ends(log, generation):
    """Canonical ids by following each id's last link (one link an id and generation here)."""
    last = {}
    for g, a, b in sorted(log):
        if g <= generation:
            last[a] = b
    out = {}
    for a in last:
        at = a
        while at in last:
            at = last[at]
        out[a] = at
    return out


def test_any_generation_comes_back(spark):
    rng = random.Random(8)
    names, log = [f"i{k:02d}" for k in range(40)], []
    free = list(names)
    for g in (1, 2, 3, 4):  # ends are merged into other ends: no cycles
        for _ in range(7):
            a = free.pop(rng.randrange(len(free)))
            log.append((g, a, rng.choice(free)))
    df = spark.createDataFrame(log, LOG)
    targets = spark.createDataFrame([(n,) for n in names[::2]], "connect_id string")
    now = ends(log, 4)
    for g in (0, 2, 3):
        then = ends(log, g)
        split = forest.split_to(df, targets, g, 4)
        got = {r.org_id: (r.was, r.connect_id) for r in split.collect()}
        assert got == {a: (c, then.get(a, a)) for a, c in now.items() if c in set(names[::2])}
        left = [tuple(r) for r in forest.undone_log(df, split, g).collect()]
        again = ends(left, 4)
        for a, (_, c) in got.items():
            assert again.get(a, a) == c
        assert all(again[a] == c for a, c in now.items() if a not in got)


def test_second_generation_by_hand(spark):
    log = forest.grown(forest.grown(spark.createDataFrame([], LOG), spark.createDataFrame(
        [("a", "C"), ("b", "C"), ("d", "D")], "org_id string, connect_id string"), 1), spark.createDataFrame(
        [("C", "N"), ("D", "N"), ("e", "N")], "org_id string, connect_id string"), 2)
    split = forest.split_to(log, spark.createDataFrame([("N",)], "connect_id string"), 1, 2)
    assert {r.org_id: (r.was, r.connect_id) for r in split.collect()} == {
        "a": ("N", "C"), "b": ("N", "C"), "C": ("N", "C"), "d": ("N", "D"), "D": ("N", "D"), "e": ("N", "e")}
    archive = spark.createDataFrame([(1, "a", "old a"), (2, "C", "C's cells"), (2, "e", "e's cells"), (3, "C", "later")],
                                    "generation bigint, rowkey string, value string")
    assert sorted(map(tuple, forest.restored_rows(archive, split, 1).collect())) == [("C", "C's cells"), ("e", "e's cells")]


def test_groups_that_share_an_id_are_one(spark):
    groups = [("g1", "b"), ("g1", "a"), ("g2", "c"), ("g2", "b"), ("g3", "x"), ("g3", None), (None, "y"), ("g4", "m"), ("g4", "n"), ("g4", "n")]
    got = {}
    for r in forest.merge_groups(spark.createDataFrame(groups, "group string, id string")).collect():
        got.setdefault(r.connect_id, set()).add(r.org_id)
    assert sorted(map(sorted, got.values())) == [["a", "b", "c"], ["m", "n"]]
    turned = spark.createDataFrame([("z" + str(g), i) for g, i in groups[::-1] if g], "group string, id string")
    assert {r.connect_id for r in forest.merge_groups(turned).collect()} == set(got)
