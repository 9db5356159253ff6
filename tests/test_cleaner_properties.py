"""Cleaners against a direct Python rendering of the reference's rules, on
many generated inputs (one Spark job per batch of inputs)."""

import calendar
import re
import time

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from idweave.functions import cleaners as C

M = "null"
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def run(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


# ---- Python renderings of the rules (ASCII whitespace, as Python 2 str did) ----
def py_phone(p):
    if p is None:
        return M
    d = re.sub("[^0-9]", "", p)
    if len(d) < 7 or len(d) > 16 or re.match("|".join(C.PHONE_BLACKLIST), d):
        return M
    return d


NAME_CHARS = set(C.NAME_PUNCT_ASCII + C.NAME_PUNCT_WIDE + " \t\n\r\x0b\x0c")


def py_name(n):
    if n is None or all(ch in NAME_CHARS for ch in n):
        return M
    return n.strip(" \t\n\r\x0b\x0c")


def py_mail(m):
    if m is None or "@" not in m:
        return M
    parts = m.split("@")
    if len(parts) != 2:
        return M
    local, dom = parts
    if len(local.encode("utf-8")) < 4:
        return M
    rule = C.MAIL_DOMAIN_RULES.get(dom)
    if rule is not None and not re.match(rule, local, re.I | re.ASCII):
        return M
    return re.sub(r"\s+", "", m, flags=re.ASCII)


def py_birth(b):
    if b is None or b == "null":
        return M
    a = re.sub(r'"|{|}|\s+', "", b, flags=re.ASCII)
    day, month, year = "1", "1", None
    for x in a.split(","):
        kv = x.split(":")
        if len(kv) != 2:
            return M
        k, v = kv
        if k == "day":
            day = v
        if k == "month":
            month = v
        if k == "year":
            year = v
    if year is None:
        return M
    try:
        t = time.strptime(f"{year}-{month}-{day}", "%Y-%m-%d")
    except ValueError:
        return M
    if t.tm_year < 1900:
        return M
    return str(calendar.timegm(t))


def py_platforms(p):
    if p is None or p == "null":
        return M
    vals = set()
    for rec in p.split("\x02"):
        f = rec.split("\t")
        if len(f) < 5:
            return M
        vals.add(f[4])
    return "\t".join(sorted(vals))


def py_signin(c):
    if re.search("|".join(C.SIGNIN_PHRASES), c):
        return re.sub("|".join(C.SIGNIN_REMOVED), "", c).split(",")[0]
    return M


# ---- generators -------------------------------------------------------------------
phones = st.one_of(st.none(), st.text(alphabet="0123456789 +-()x", max_size=22),
                   st.text(alphabet="0123456789", min_size=6, max_size=17),
                   st.sampled_from(C.PHONE_BLACKLIST).flatmap(
                       lambda b: st.text(alphabet="0123456789", min_size=3, max_size=10).map(lambda t: b + t)))
names = st.one_of(st.none(), st.text(alphabet=list(NAME_CHARS) + list("abcXYZ-#@é李"), max_size=8))
locals_ = st.text(alphabet="abcdefXYZ0129._- \t", max_size=12)
domains = st.sampled_from(["gmail.com", "Gmail.com", "yahoo.com", "x.org", "", "a@b"])
mails = st.one_of(st.none(), st.text(alphabet="ab@. ", max_size=8),
                  st.tuples(locals_, domains).map(lambda t: t[0] + "@" + t[1]))
keys = st.sampled_from(["day", "month", "year", "x", "Day", ""])
vals = st.one_of(st.text(alphabet="0123456789", max_size=5), st.sampled_from(["07", "12", "13", "1990", "0000", "29"]))
piece = st.tuples(keys, vals, st.sampled_from([":", "::", ""]), st.sampled_from(["", '"', " "])).map(
    lambda t: f'{t[3]}{t[0]}{t[3]}{t[2]}{t[1]}')
good_year = st.sampled_from(["1990", "2000", "1850", "0000", "2024", "199", "1969"]).map(lambda y: f'"year":{y}')
good_md = st.tuples(st.sampled_from(["day", "month"]), st.sampled_from(["1", "07", "12", "13", "29", "31", "0"])).map(
    lambda t: f'"{t[0]}": {t[1]}')
births = st.one_of(st.none(), st.just("null"),
                   st.lists(piece, min_size=1, max_size=4).map(lambda ps: "{" + ",".join(ps) + "}"),
                   st.tuples(good_year, st.lists(good_md, max_size=3), st.randoms()).map(
                       lambda t: "{" + ",".join(t[2].sample([t[0], *t[1]], len(t[1]) + 1)) + "}"))
records = st.lists(st.text(alphabet="ab", max_size=2), min_size=3, max_size=6).map(lambda f: "\t".join(f))
platforms = st.one_of(st.none(), st.just("null"), st.lists(records, min_size=1, max_size=3).map("\x02".join))
signins = st.lists(st.sampled_from(["Ann ", "is back on Tang", "o", "oo", ", ", "也登入 Tang", "님이 Tango",
                                    "hi", "也登录了 Tango"]), max_size=6).map("".join)


def batch(s):
    return st.lists(s, min_size=40, max_size=120)


@SETTINGS
@given(batch(phones))
def test_phone_matches_rule(spark, xs):
    assert run(spark, lambda c: C.clean_phone(c, M), xs) == [py_phone(x) for x in xs]


@SETTINGS
@given(batch(names))
def test_name_matches_rule(spark, xs):
    assert run(spark, lambda c: C.clean_name(c, M), xs) == [py_name(x) for x in xs]


@SETTINGS
@given(batch(mails))
def test_mail_matches_rule(spark, xs):
    assert run(spark, lambda c: C.clean_mail(c, M), xs) == [py_mail(x) for x in xs]


@SETTINGS
@given(batch(births))
def test_birth_matches_rule(spark, xs):
    assert run(spark, lambda c: C.clean_birth(c, M), xs) == [py_birth(x) for x in xs]


@SETTINGS
@given(batch(platforms))
def test_platforms_match_rule(spark, xs):
    assert run(spark, lambda c: C.clean_platforms(c, M), xs) == [py_platforms(x) for x in xs]


@SETTINGS
@given(batch(signins))
def test_signin_matches_rule(spark, xs):
    assert run(spark, lambda c: C.signin_name(c, M), xs) == [py_signin(x) for x in xs]
