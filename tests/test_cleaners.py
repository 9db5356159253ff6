"""Unit tables for the scalar cleaners (expected values derived by hand from
the reference's rules; FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F

from idweave.functions import cleaners as C
from idweave.functions import codec, ids, packed

M = "null"


def apply(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    out = df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in out]


def test_phone(spark):
    cases = {
        None: M, "+1 (202) 010-0199": "12020100199", "02020100199": "02020100199", "123": M,
        "1" * 17: M, "1112020100": M, "3456201010": M, "2011112020": "2011112020", "": M,
        "86 138 0000 0001": "8613800000001",
    }
    assert apply(spark, lambda c: C.clean_phone(c, M), list(cases)) == list(cases.values())
    assert apply(spark, C.clean_phone, [None, "123"]) == [None, None]


def test_name(spark):
    cases = {"  Ann Lee ": "Ann Lee", ".,(*": M, "！@#": M, "a!": "a!", "-": "-", None: M,
             "\tAnn\t": "Ann", "": M, "   ": M, "——……": M}
    assert apply(spark, lambda c: C.clean_name(c, M), list(cases)) == list(cases.values())


def test_mail(spark):
    cases = {
        None: M, "abc": M, "a@b@c": M, "abc@x.org": M, "abcd@x.org": "abcd@x.org", "abcde@gmail.com": M,
        "abcdef@gmail.com": "abcdef@gmail.com", "ABCDEF@gmail.com": "ABCDEF@gmail.com",
        "abcde@Gmail.com": "abcde@Gmail.com", "robert@yahoo.com": M, "a-zrobert@yahoo.com": "a-zrobert@yahoo.com",
        "ab cd@x.org": "abcd@x.org",
    }
    assert apply(spark, lambda c: C.clean_mail(c, M), list(cases)) == list(cases.values())


def test_birth(spark):
    cases = {
        '{"day":7,"month":3,"year":1990}': "636768000", '{"year":2001}': "978307200",
        '{"day":1,"day":2,"year":2000}': "946771200", '{"day":1}': M, "a": M, "null": M, None: M,
        '{"day":31,"month":2,"year":2001}': M, '{ "month" : 13 , "year":1999}': M, '{"year":1850}': M,
        '{"year":2000,}': M, '{"day":"07","month":"03","year":"1990"}': "636768000",
    }
    assert apply(spark, lambda c: C.clean_birth(c, M), list(cases)) == list(cases.values())


def test_platforms(spark):
    rec = "a\tb\tc\td\t{}"
    cases = {rec.format("Y") + "\x02" + rec.format("X"): "X\tY", "a\tb\tc\td": M, "null": M, None: M,
             rec.format("X") + "\x02" + rec.format("X"): "X"}
    assert apply(spark, lambda c: C.clean_platforms(c, M), list(cases)) == list(cases.values())


def test_gender(spark):
    cases = {"Male": "true", "M": "true", "man": "true", "FM": "false", "woman": "false", "f": "false",
             "x": None, None: None}
    assert apply(spark, C.clean_gender, list(cases)) == list(cases.values())


def test_pad_millis(spark):
    assert apply(spark, C.pad_millis, [1533000000, 1533000000000], "bigint") == ["1533000000000", "1533000000000"]


def test_signin(spark):
    vals = ["Ann is back on Tango", "hello", "Bo也登入 Tangooo, hi", "Kim님이 Tango"]
    assert apply(spark, lambda c: C.signin_name(c, M), vals) == ["Ann ", M, "Bo", "Kim님이 Tango"]
    assert apply(spark, lambda c: C.signin_filter(c, M), vals) == [M, "hello", M, "Kim님이 Tango"]


def test_default_unknown_and_present(spark):
    assert apply(spark, C.default_unknown, [None, "", "x"]) == ["Unknown", "Unknown", "x"]
    assert apply(spark, C.is_present, [None, "null", "x"]) == [False, False, True]


def test_ids(spark):
    assert apply(spark, lambda c: ids.rowkey(c, "pa"), ["42"]) == ["a1d0c6e83f027327d8461063f4ac58a6-pa"]
    assert apply(spark, lambda c: ids.key_part(c, 3), ["a-b-c-d-e", "a-b"]) == ["d", None]
    assert apply(spark, ids.day_to_epoch_millis, ["20240101"]) == ["1704067200000"]


def test_codec_roundtrip(spark):
    df = spark.createDataFrame([(True, 0, 2.5)], "b boolean, n int, x double")
    r = df.select(codec.encode_value(F.col("b"), "boolean").alias("b"),
                  codec.encode_value(F.col("n"), "int").alias("n"),
                  codec.encode_value(F.col("n"), "int", legacy_falsy=True).alias("n_legacy"),
                  codec.encode_value(F.col("x"), "float").alias("x")).first()
    assert (r.b, r.n, r.n_legacy, r.x) == ("True", "0", "", "2.5")
    t = spark.createDataFrame([("False", "", "x1", "2024-01-02 03:04:05")], "b string, e string, bad string, d string")
    r = t.select(codec.decode_value("b", "boolean").alias("b"), codec.decode_value("e", "int").alias("e"),
                 codec.decode_value("bad", "long").alias("bad"), codec.decode_value("d", "datetime").alias("d"),
                 codec.decode_value("b", "boolean", legacy_bool=True).alias("lb")).first()
    assert r.b is False and r.e is None and r.bad is None and r.d is not None and r.lb is True


def test_packed_name_entry(spark):
    df = spark.createDataFrame([("name:Ann|platforms:u1-pa,u2-pc|score:2",)], "e string")
    r = df.select(packed.parse_name_entry("e").alias("p")).first().p
    assert r.name == "Ann" and r.score == "2"
    assert [(s.source_id, s.platform) for s in r.sources] == [("u1", "pa"), ("u2", "pc")]
    back = df.select(packed.parse_name_entry("e").alias("p")).select(
        packed.format_name_entry("p.name", "p.sources", "p.score").alias("e")).first().e
    assert back == "name:Ann|platforms:u1-pa,u2-pc|score:2"
    c = spark.createDataFrame([("id1|pa|x",)], "e string").select(packed.split_contact_entry("e").alias("c")).first().c
    assert (c.id, c.rest) == ("id1", "pa|x")


@pytest.mark.parametrize("a,b,expected", [
    ({"phone": ["p"], "name": ["a"], "mail": ["m"], "contacts": ["x", "y"]},
     {"phone": ["p"], "name": ["a", "b"], "mail": ["m"], "contacts": ["y"]}, 75.0),
    ({"phone": [], "name": [], "mail": [], "contacts": []},
     {"phone": [], "name": [], "mail": [], "contacts": []}, 0.0),
])
def test_weighted_jaccard(spark, a, b, expected):
    from idweave.functions.similarity import weighted_jaccard
    schema = ", ".join(f"{s}_{k} array<string>" for s in "ab" for k in a)
    df = spark.createDataFrame([tuple(a[k] for k in a) + tuple(b[k] for k in b)], schema)
    score = df.select(weighted_jaccard({k: (f"a_{k}", f"b_{k}") for k in a}).alias("s")).first().s
    assert round(score, 6) == expected


def test_dashed_ids_and_null_senders(spark):
    from idweave.plans.pipelines import message_rows
    df = spark.createDataFrame([("name:Ann|platforms:ab-cust-cust,x-pa|score:2",)], "e string")
    p = df.select(packed.parse_name_entry("e").alias("p")).first().p
    assert [(s.source_id, s.platform) for s in p.sources] == [("ab-cust", "cust"), ("x", "pa")]
    src = spark.createDataFrame([(None, "2", 5, "tok", "t", "m", "d", 0)],
                                "useruid string, partyuid string, timesent long, messagetoken string, mtext string, "
                                "media string, direction string, msgtype int")
    assert message_rows(src, "pa", "pa", "pa").first().mid is None
