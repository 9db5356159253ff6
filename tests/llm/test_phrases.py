"""Collocations against a plain count of all phrases."""

import collections
import random
import re

import pytest

from idweave.llm.phrases import collocations, exact_counts, frequent_phrases, runs_of_pieces
from idweave.llm.queries import SQL, op12_collocations

from .helpers import edge_docs, edge_rows, empty_docs, prose


def plain(rows, least=10, most=3, share=50, top=2000):
    """rows of (text, lang) -> the result's rows, counting every phrase."""
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, most + 1):
                for i in range(len(w) - size + 1):
                    f[lang][tuple(w[i:i + size])] += 1
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            inside = any(len(q) > len(p) and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, b in cand.items())
            if not inside:
                score, _, l, r = min((1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]])
                                     for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def check(df, rows, **how):
    assert sorted(map(tuple, collocations(df, bits=1 << 16, **how).collect())) == plain(
        rows, **{k: v for k, v in how.items() if k in ("least", "most", "share", "top")})


def texts(seed, n=120):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        t = prose(rng, rng.randint(0, 60), 12 if i % 3 else 40).split(" ")
        for at in range(0, len(t), 7):
            t[at] += rng.choice([".", ",", "\n", "\t", "  ", "?!", " The Big Cat ", " the big dog"])
        out.append((" ".join(t), rng.choice(["en", "en", "fr", None, "und"])))
    return out + [out[0]] * 60  # copies


@pytest.mark.parametrize("seed,how", [(1, {}), (2, {"top": 5}), (3, {"most": 4, "least": 5}), (4, {"share": 90, "sample": 0.5})])
def test_equal_to_plain_counts(spark, seed, how):
    rows = texts(seed)
    check(spark.createDataFrame(rows, "text string, lang string").repartition(4), rows, **how)


@pytest.mark.parametrize("sample", [0.0, 0.02, 1.0])
def test_the_sample_never_changes_the_result(spark, sample):
    """Without proposals every phrase is a border failure: three passes find them all."""
    rows = texts(7)
    check(spark.createDataFrame(rows, "text string, lang string").repartition(3), rows, sample=sample)


def test_a_crowded_bitmap_changes_nothing(spark):
    rows = texts(9)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    frequent, totals = frequent_phrases(df, sample=0.05, bits=1 << 12)
    got = [(r.lang, r.phrase) for r in frequent.collect()]
    assert len(got) == len(set(got))
    full = {(r.lang, r.phrase): r.f for r in exact_counts(df.fillna("und", ["lang"]), 3, None).collect() if r.words}
    assert {(r.lang, r.phrase): r.f for r in frequent.collect()} == {k: v for k, v in full.items() if v >= 10}
    assert {r.lang: r.n for r in totals.collect()} == {lang: sum(v for (x, p), v in full.items() if x == lang and " " not in p)
                                                       for lang in {x for x, _ in full}}


def test_edges(spark):
    check(edge_docs(spark), [(r[1], r[2]) for r in edge_rows()])
    assert collocations(empty_docs(spark)).collect() == []
    assert collocations(spark.createDataFrame([(None, None), (" \t.\n", "en")], "text string, lang string")).collect() == []


def test_long_texts_are_cut_at_pieces(spark, monkeypatch):
    from idweave.llm import phrases
    text = "a b c. d e\nffff gggg hhhh iiii jjjj kkkk; " * 40
    parts = list(runs_of_pieces(text.encode(), 50))
    assert b"".join(parts) == text.encode() and len(parts) > 20 and list(runs_of_pieces(b"", 9)) == [b""]
    assert list(runs_of_pieces(b"x" * 30, 9)) == [b"x" * 30] and b"".join(runs_of_pieces(b"x" * 30 + b"." + b"y" * 40, 9))[30:31] == b"."
    monkeypatch.setattr(phrases, "SLICE", 64)
    pieces = [(bytes(p).decode(), "en") for p in parts]
    assert plain([(text, "en")]) == plain(pieces)


def test_query_equals_its_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = op12_collocations(spark, sf)
    want = con.sql(SQL["op12_collocations"]).select(", ".join(got.columns)).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
    assert sorted(want) == plain(con.sql("SELECT text, lang FROM documents").fetchall())


@pytest.mark.parametrize("most", [2, 3, 4])
def test_the_longest_phrases_need_no_pass_of_their_own(spark, monkeypatch, most):
    """Without proposals each pass fails by phrases of one word more; the last ones go to the exact counts."""
    from idweave.llm import phrases
    made, plain_bounds = [], phrases.bounds
    monkeypatch.setattr(phrases, "bounds", lambda *a: made.append(a) or plain_bounds(*a))
    rows = texts(11)
    check(spark.createDataFrame(rows, "text string, lang string").repartition(3), rows, sample=0.0, most=most)
    assert len(made) - 1 <= most - 1  # one more is the sample's
