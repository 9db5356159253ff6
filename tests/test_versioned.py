"""Staged commits, exactly-once batches, and change sets, against plain dictionaries."""

import random

import pytest

from idweave.operators import counts
from idweave.sources.changes import change_set, compact, merged, puts, tombstones
from idweave.sources.scratch import scratch
from idweave.sources.versioned import VersionedTable, apply_to_all

ROWS = "k string, v int, time string, platform string"


def table(spark, cols=("time", "platform")):
    return VersionedTable(spark, scratch(spark, "table"), spark.createDataFrame([], ROWS).schema, cols)


def content(t):
    return sorted(map(tuple, t.current().collect()), key=repr)


def test_partitions_are_replaced_and_others_survive(spark):
    t = table(spark)
    assert content(t) == []
    day1 = [(f"a{i}", i, "d1", p) for i in range(5) for p in ("pa", "pb", None)]
    day2 = [(f"b{i}", i, "d2", "pa") for i in range(3)]
    t.replace(spark.createDataFrame(day1, ROWS), "one")
    t.replace(spark.createDataFrame(day2, ROWS), "two")
    new = [("new", 9, "d1", None), ("new", 8, "d2", "pc")]
    t.replace(spark.createDataFrame(new, ROWS), "three")
    want = [r for r in day1 if r[3]] + day2 + new
    assert content(t) == sorted(want, key=repr)
    t.replace(spark.createDataFrame([], ROWS), "four", empty=(("d1", "pa"),))
    assert content(t) == sorted((r for r in want if r[2:] != ("d1", "pa")), key=repr)


def test_a_run_that_stops_before_its_commit(spark):
    """Readers see the old state until the commit and the new one after it; a repeated run changes nothing more."""
    t = table(spark)
    old, new = [("a", 1, "d1", "pa"), ("b", 2, "d1", "pb")], [("a", 3, "d1", "pa"), ("c", 4, "d2", "pa")]
    t.replace(spark.createDataFrame(old, ROWS), "run1")
    staged = t.stage(spark.createDataFrame(new, ROWS), "run2")
    assert content(t) == old and not t.applied("run2")
    broken = spark.createDataFrame(new, ROWS).selectExpr("k", "CAST(raise_error('stopped') AS INT) AS v", "time", "platform")
    with pytest.raises(Exception, match="stopped"):
        t.stage(broken, "run2")
    assert content(t) == old
    t.commit(staged)
    want = sorted([old[1], *new], key=repr)
    assert content(t) == want and t.applied("run2")
    t.replace(spark.createDataFrame(new, ROWS), "run2")
    assert content(t) == want


def test_one_batch_reaches_every_target_once(spark):
    targets = [table(spark, ()) for _ in range(3)]
    for t in targets:
        t.replace(spark.createDataFrame([("a", 1, "t", "p"), ("b", 2, "t", "p")], ROWS), "stored")
    batch = spark.createDataFrame([("b", 20, "t", "p"), ("c", 30, "t", "p")], ROWS)

    class Stops(VersionedTable):
        def commit(self, staged):
            raise OSError("lost")
    second = Stops(spark, targets[1].path, targets[1].schema)
    with pytest.raises(OSError):
        apply_to_all([targets[0], second, targets[2]], "b1", batch, ["k"])
    states = [[r[1] for r in content(t)] for t in targets]
    assert states == [[1, 20, 30], [1, 2], [1, 2]]
    targets[0].replace(spark.createDataFrame([("a", 7, "t", "p")], ROWS), "later")  # b1 must not be applied to it again
    assert apply_to_all(targets, "b1", batch, ["k"]) == 2 and apply_to_all(targets, "b1", batch, ["k"]) == 0
    assert [[r[1] for r in content(t)] for t in targets] == [[7], [1, 20, 30], [1, 20, 30]]


def test_change_sets_equal_a_dictionary(spark):
    rng = random.Random(6)
    base = {f"k{i}": i for i in range(40)}
    state, changes = dict(base), []
    for seq in range(1, 8):
        put = {f"k{rng.randint(0, 60)}": rng.randint(100, 999) for _ in range(6)}
        gone = {f"k{rng.randint(0, 60)}" for _ in range(6)}
        state = {k: v for k, v in state.items() if k not in gone} | put  # a put counts over a delete of the same run
        changes += [puts(spark.createDataFrame(list(put.items()), "k string, v int"), seq),
                    tombstones(spark.createDataFrame([(k,) for k in gone], "k string"), ["k"], seq)]
    df = spark.createDataFrame(list(base.items()), "k string, v int")
    every = change_set(*changes)
    assert dict(map(tuple, merged(df, every, ["k"]).collect())) == state
    assert dict(map(tuple, compact(df, every, ["k"], scratch(spark, "compact")).collect())) == state
    tied = change_set(puts(spark.createDataFrame([("k1", 5), ("k1", 3), ("k1", 4)], "k string, v int"), 9), tombstones(df.limit(0), ["k"], 9))
    assert dict(map(tuple, merged(df, tied, ["k"]).collect())) == base | {"k1": 3}
    none = change_set(puts(df.limit(0), 1), tombstones(df.limit(0), ["k"], 1))
    assert dict(map(tuple, merged(df, none, ["k"]).collect())) == base


def test_rekeyed_messages_with_one_mid_leave_one_row(spark):
    """Two senders merged into one, with messages of equal time and id; a receiver that moves; a message left alone."""
    from idweave.operators import merge
    m = spark.createDataFrame([("a-5-x", "x", "a", "z", 5), ("b-5-x", "x", "b", "q", 5), ("z-6-y", "y", "z", "a", 6), ("q-7-w", "w", "q", "z", 7),
                               (None, "n", None, "z", 8)], "mid string, platform_msg_id string, user string, party string, timesent bigint")
    links = spark.createDataFrame([("a", "C"), ("b", "C")], "org_id string, connect_id string")
    got = merged(m, merge.rekey_changes(m, links, 1), ["mid"], ["replaces"]).collect()
    assert sorted((r.mid or "", r.user, r.party) for r in got) == [("", None, "z"), ("C-5-x", "C", "z"), ("q-7-w", "q", "z"), ("z-6-y", "z", "C")]


def test_late_ids_touch_their_days_only(spark):
    t = VersionedTable(spark, scratch(spark, "state"), spark.createDataFrame([], counts.STATE_SCHEMA).schema, ("day",))
    ids = lambda rows: spark.createDataFrame(rows, "day string, uid string")
    none, contacts = ids([]).selectExpr("day", "uid AS mid"), ids([]).selectExpr("day", "uid AS a", "uid AS b")
    state = lambda rows, c=contacts: counts.counter_state([ids(rows)], c, none, none)
    counts.extend_state(t, state([("20240101", "u1"), ("20240101", None), ("20240102", "u1"), ("20240102", "u1")]), "b1")
    folders = {r.part: r.folder for r in t.log().collect()}
    late = ids([("20240101", "x"), ("20240101", None)]).selectExpr("day", "uid AS a", "CAST(NULL AS STRING) AS b")
    counts.extend_state(t, state([("20240101", "u1"), ("20240101", "u2"), ("20240101", None)], late), "b2")
    counts.extend_state(t, state([("20240101", "u9")]), "b2")
    got = {r.day: (r.user_count, r.contact_count, r.message_count) for r in counts.counters_of(t.current()).collect()}
    assert got == {"20240101": (3, 2, 0), "20240102": (1, 0, 0)}
    last = {r.part: r.folder for r in t.log().orderBy("version").collect()}
    assert {p for p in last if last[p] != folders[p]} == {'["20240101"]'}
