"""A party with several user rows fans out (kept, as in the reference)."""

from idweave.operators import counts


def test_pair_with_party_keeps_fanout(spark):
    pairs = spark.createDataFrame([("u-p", "u", 3, "hi", 5, "t", "pu", "p", "pa"),
                                   ("u-q", "u", 1, "yo", 4, "t", "qu", "q", "pa")],
                                  "uuid string, user string, count long, content string, timesent long, "
                                  "platform_msg_id string, partyuid string, party string, platform string")
    users = spark.createDataFrame([("p", "Ann", "1", None), ("p", "Anne", "2", "a@x")],
                                  "rowkey string, name string, phone string, mail string")
    out = counts.pair_with_party(pairs, users)
    got = sorted((r.uuid, r.name) for r in out.collect())
    assert got == [("u-p", "Ann"), ("u-p", "Anne"), ("u-q", None)]
