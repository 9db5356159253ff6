"""Exact deduplication, suffix-array deduplication and the n-gram join against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

import idweave.llm.ngram_join as ngram
from idweave.llm.common import keep_rows
from idweave.llm.exact_dedup import cut_points, exact_dedup, split_texts
from idweave.llm.suffix_dedup import repeated_spans, suffix_dedup, window_runs
from idweave.llm.suffix_groups import lockstep, single

from .helpers import edge_docs, edge_rows, empty_docs, prose, random_docs, stored, words


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


@pytest.mark.parametrize("fingerprint", [16, 1])  # one byte: chunks clash and are told apart by content
def test_exact_dedup_edges(spark, fingerprint):
    rows = edge_rows() + [(100 + i, f"{'x' * 3000}{i % 7}", "en", "a", 1) for i in range(60)]
    from .helpers import SCHEMA
    docs = stored(spark.createDataFrame(rows, SCHEMA))
    got = exact_dedup(docs, fingerprint_bytes=fingerprint).collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r)
    assert len(got) == len(rows)
    by_hash = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    assert sum(r.kept for r in got) == len(groups)
    for r in got:
        own = by_hash[r.text_sha256]
        best = min(own, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))
        assert (r.group_size, r.keep_id) == (len(own), best[0])


def test_exact_dedup_empty_and_columns(spark):
    assert exact_dedup(empty_docs(spark)).count() == 0
    docs = stored(edge_docs(spark))
    kept = keep_rows(docs, exact_dedup(docs))
    assert kept.columns == docs.columns
    assert kept.count() == len({norm(r[1]) for r in edge_rows()})


def test_chunks_join_to_the_text_and_are_content_defined():
    rng = random.Random(3)
    text = bytes(rng.randrange(97, 123) for _ in range(60_000))
    for t in (b"", b"a", text, text[:700]):
        assert b"".join(split_texts([t])[0]) == t
    assert split_texts([b"zz", text, b""])[1] == split_texts([text])[0]
    assert max(map(len, split_texts([b"q" * 50_000])[0])) <= 16_384
    assert cut_points(b"x" * 10, []) == [10]


def naive(t):
    return sorted(range(len(t)), key=lambda i: t[i:])


def test_suffix_groups_against_sorting():
    rng = random.Random(5)
    for round_ in range(400):
        texts = []
        for _ in range(rng.randint(1, 8)):
            n, a = rng.randint(0, 30), rng.choice([1, 2, 3, 9])
            t = [rng.randint(1, a) for _ in range(n)]
            texts.append(((t[:3] * n)[:n] if round_ % 3 == 0 else t) + [0])
        texts.sort(key=len, reverse=True)
        out, at = lockstep(np.array(sum(texts, [])), np.array([len(t) for t in texts])).tolist(), 0
        for t in texts:
            assert [x - at for x in out[at:at + len(t)]] == naive(t) == [*single(t)]
            at += len(t)


def removed(texts, width):
    seen = collections.Counter(t[i:i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - width + 1):
            if seen[t[i:i + width]] > 1:
                cover[i:i + width] = True
        out.append(cover)
    return out


@pytest.mark.parametrize("most_runs", [4096, 1])  # 1: every bucket of several runs is counted, not sorted
def test_suffix_dedup_against_brute_force(spark, most_runs):
    rng = random.Random(11)
    passage = prose(rng, 30)
    texts = [prose(rng, rng.randint(0, 40)) + (passage[rng.randint(0, 40):rng.randint(60, 150)] if i % 2 else "") +
             prose(rng, rng.randint(0, 20)) for i in range(50)]
    texts += [texts[0], texts[1][:50] + "é" + texts[1][50:], "ab" * 60, "a" * 90, "", None, "short", passage + "x", "y" + passage]
    docs = stored(random_docs(spark, texts))
    got = {r.id: r for r in suffix_dedup(docs, width=20, gram=8, most_runs=most_runs).collect()}
    data = [(t or "").encode() for t in texts]
    for i, (t, cover) in enumerate(zip(data, removed(data, 20))):
        kept = bytes(np.frombuffer(t, np.uint8)[~cover]) if t else b""
        starts = int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == (len(t), int(cover.sum()), starts, kept), i
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_suffix_dedup_edges(spark):
    assert suffix_dedup(empty_docs(spark)).count() == 0
    assert repeated_spans(empty_docs(spark)).count() == 0
    got = suffix_dedup(stored(edge_docs(spark))).collect()
    assert len(got) == len(edge_rows())
    by_id = {r.id: r for r in got if r.id is not None}
    assert by_id[10].n_removed == by_id[10].n_bytes and by_id[11].n_bytes - by_id[11].n_removed == 3  # the text repeats itself, its last space too
    assert by_id[13].n_removed == 1500 and by_id[2].n_bytes == 0


def test_suffix_dedup_broadcasts_nothing_that_grows_with_the_texts(spark):
    passage = prose(random.Random(2), 20)
    docs = stored(random_docs(spark, [passage + f" {i} " + passage for i in range(8)]))
    plan = suffix_dedup(docs, width=20, gram=8)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan and "strategy=broadcast" not in plan


def test_runs_hold_every_window_once():
    rng = random.Random(2)
    data = bytes(rng.choice(b"ab") for _ in range(3000)) + b"c" * 500
    text, start, count, _, _, place = window_runs(data, np.array([0, 1200, 1200, len(data)]), 50, 8)
    found = sorted((t, s + i) for t, s, c in zip(text.tolist(), start.tolist(), count.tolist()) for i in range(c))
    assert found == [(0, i) for i in range(1200 - 49)] + [(2, i) for i in range(len(data) - 1200 - 49)]


def shingles(text, n=3):
    w = [x.lower() if x.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def components(texts, n=3, num=90):
    sets, parent = [shingles(t, n) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sets, [find(i) for i in range(len(texts))]


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        k = rng.randrange(len(w))
        w[k:k + 1] = rng.choice([[], [f"n{rng.randint(1, 9999)}"], [w[k], f"m{rng.randint(1, 50)}"]])
    return " ".join(w)


def test_word_hashes_tell_words_apart_across_blocks(monkeypatch):
    monkeypatch.setattr(ngram, "_BLOCK", 7)  # words begin, end and go on where a block does
    ngram._powers.cache_clear()
    rng = random.Random(4)
    for _ in range(200):
        text = bytes(rng.choice(b"abAB \t\n\x0b\x1c\xc3") for _ in range(rng.randint(0, 60)))
        place, got = ngram.word_hashes(text)
        w = text.lower().split()
        assert [text[a:a + len(x)].lower() for a, x in zip(place, w)] == w and len(got) == len(w)
        alone = [int(ngram.word_hashes(x)[1][0]) for x in w]
        assert alone == got.tolist()
        assert len({*zip(w, alone)}) == len(set(w)) == len(set(alone))
    ngram._powers.cache_clear()


def test_text_sets_keep_texts_apart():
    texts = [b"", b"a b c d", b"  ", b"One two", b"one TWO ", b"a b c"]
    sets = [s.tolist() for s in ngram.text_sets(texts, 3)]
    assert [len(s) for s in sets] == [0, 2, 0, 1, 1, 1] and sets[3] == sets[4] and sets[5][0] in sets[1]
    assert ngram.text_sets([], 3) == [] and ngram.text_sets([b""], 3)[0].size == 0


@pytest.mark.parametrize("n2,k2,gram,num,paired", [(2, 1, 3, 90, 32), (3, 1, 3, 90, 2), (4, 2, 3, 90, 4), (3, 1, 5, 80, 32)])
def test_ngram_join_against_brute_force(spark, monkeypatch, n2, k2, gram, num, paired):
    monkeypatch.setattr(ngram, "PAIRED", paired)  # small: more rounds
    rng = random.Random(n2)
    texts = []
    for size in (12, 25, 60, 150, 400):
        base = prose(rng, size)
        texts += [edited(rng, base, rng.randint(0, max(1, size // 25))) for _ in range(14)]
        texts.append(" ".join(base.split()[:int(size * 0.93)]))
    chain = prose(rng, 120)
    for _ in range(10):  # neighbours link, ends do not
        chain = edited(rng, chain, 2)
        texts.append(chain)
    texts += ["", None, "one", "One", "one two", "  one\ttwo ", "a b c", "a b c d"]
    docs = stored(random_docs(spark, texts))
    got = {r.id: r for r in ngram.ngram_join(docs, words=gram, num=num, n2=n2, k2=k2).collect()}
    sets, want = components(texts, gram, num)
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i].component_id for i in range(len(texts))] == want
    assert sorted(i for i in got if got[i].kept) == sorted(set(want))


@pytest.mark.parametrize("num", [80, 90])
def test_similar_sets_share_a_signature_and_others_few(num):
    rng = np.random.default_rng(num)
    signatures = ngram.Signatures(num, 100)

    def some(n):
        return rng.integers(0, 1 << 64, n, dtype=np.uint64)
    shared = 0
    for size in [*range(1, 60), 100, 300, 1000] * 6:
        own = some(size)
        apart = [(a, b) for a in range(size) for b in range(size) if 100 * (size - a) >= num * (size + b)][-40:]
        a, b = apart[rng.integers(len(apart))]
        other = np.concatenate([rng.permutation(own)[a:], some(b)])
        one, two = signatures.of(np.unique(own)), signatures.of(np.unique(other))
        assert np.intersect1d(one, two).size or not (a or b), (size, a, b)
        shared += np.intersect1d(one, signatures.of(np.unique(some(size)))).size if size > 8 else 0
    assert shared <= 30  # of 324 unrelated pairs: only signatures without elements


def test_ngram_join_edges(spark):
    assert ngram.ngram_join(empty_docs(spark)).count() == 0
    docs = stored(edge_docs(spark))
    got = ngram.ngram_join(docs).collect()
    assert len(got) == len(edge_rows())
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r.id].append(r)
    assert {r.component_id for i in (1, 5, 6) for r in by_id[i]} == {1} and by_id[11][0].component_id == 10
    assert all(r.kept and r.component_id == r.id for i in (2, 3, 4) for r in by_id[i])
    assert keep_rows(docs, ngram.ngram_join(docs)).columns == docs.columns


def test_sketches_differ_in_no_more_bits_than_sets_in_elements():
    rng = np.random.default_rng(5)
    for n, m in [(0, 0), (1, 1), (1, 70), (60, 64), (64, 65), (500, 520), (300, 1100)]:
        common = rng.integers(0, 1 << 64, min(n, m), dtype=np.uint64)
        for kept in {0, len(common) // 2, len(common)}:
            a = np.unique(np.concatenate([common[:kept], rng.integers(0, 1 << 64, n - kept, dtype=np.uint64)]))
            b = np.unique(np.concatenate([common[:kept], rng.integers(0, 1 << 64, m - kept, dtype=np.uint64)]))
            apart = ngram.bits_apart(ngram.sketch(a), ngram.sketch(b))
            assert apart == ngram.bits_apart(ngram.sketch(b), ngram.sketch(a)) <= len(np.setxor1d(a, b))
            assert apart % 2 == len(np.setxor1d(a, b)) % 2
    a, b = (np.unique(rng.integers(0, 1 << 64, 600, dtype=np.uint64)) for _ in range(2))
    assert ngram.bits_apart(ngram.sketch(a), ngram.sketch(b)) > 1200 * 20 // 180  # unrelated sets are told apart


def test_bucket_pairs_are_those_of_small_buckets(spark):
    rng = random.Random(8)
    sizes = [1, 2, 3, 5, 6, 7, 40, 2, 1, 5]
    rows = [(rep, sig) for sig, n in enumerate(sizes) for rep in rng.sample(range(100), n)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for batch in ("3", "10000"):  # buckets go on in the next batches
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            got = [tuple(r) for r in ngram.bucket_pairs(spark.createDataFrame(rows, "rep bigint, sig bigint").repartition(2), 5).collect()]
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        assert sorted((s, r) for s, r, o in got if o is None) == sorted((s, r) for r, s in rows if sizes[s] > 5)
        want = {(a, b) for a, s in rows for b, t in rows if s == t and a < b and sizes[s] <= 5}
        assert {(r, o) for _, r, o in got if o is not None} == want


@pytest.mark.parametrize("small,paired", [(1, 2), (4, 32), (9, 4)])
def test_ngram_join_with_buckets_small_and_large(spark, monkeypatch, small, paired):
    monkeypatch.setattr(ngram, "SMALL", small)
    monkeypatch.setattr(ngram, "PAIRED", paired)
    rng = random.Random(small)
    texts = []
    for size in (20, 60, 150):
        base = prose(rng, size)
        texts += [edited(rng, base, rng.randint(0, max(1, size // 25))) for _ in range(12)]
    docs = stored(random_docs(spark, texts))
    got = {r.id: r for r in ngram.ngram_join(docs, words=3, num=80).collect()}
    assert [got[i].component_id for i in range(len(texts))] == components(texts, 3, 80)[1]


def test_unrelated_texts_of_one_passage_are_not_moved(spark, monkeypatch):
    """They share signatures by the passage; their sketches tell them apart, so their sets go nowhere."""
    kept, store = {}, ngram.store
    monkeypatch.setattr(ngram, "store", lambda df, name: kept.setdefault(name, store(df, name)))
    rng = random.Random(3)
    passage = prose(rng, 120)
    docs = stored(random_docs(spark, [prose(rng, 60, 9999) + " " + passage + " " + prose(rng, 60, 9999) for _ in range(30)]))
    got = ngram.ngram_join(docs, words=5, num=80).collect()
    assert {r.component_id for r in got} == set(range(30)) and kept["shared"].count() > 0 and kept["grams"].count() == 0


def test_pairs_of_one_large_group_are_not_its_square(spark, monkeypatch):
    """Texts of one passage and near copies share many buckets; the rows of pairs grow with the members of the group."""
    made, store = collections.Counter(), ngram.store

    def counted(df, name):
        out = store(df, name)
        made[name] = max(made[name], out.count())
        return out
    monkeypatch.setattr(ngram, "store", counted)
    rng = random.Random(6)
    passage, base = prose(rng, 120), prose(rng, 150)
    texts = [prose(rng, 60, 9999) + " " + passage + " " + prose(rng, 60, 9999) for _ in range(60)]
    texts += [edited(rng, base, 3) for _ in range(60)]
    got = {r.id: r.component_id for r in ngram.ngram_join(stored(random_docs(spark, texts)), words=5, num=80).collect()}
    assert [got[i] for i in range(len(texts))] == components(texts, 5, 80)[1]
    assert 0 < made["pairs"] <= 60 * 59 // 2 and made["near"] <= 60 * 59 // 4  # of twice that many pairs in two groups


@pytest.mark.parametrize("num", [80, 90])
def test_similar_sets_share_a_signature_that_neither_keeps_back(spark, num):
    rng = np.random.default_rng(num)
    options, sets, pairs = {"num": num, "den": 100}, [], []
    passage = rng.integers(0, 1 << 64, 150, dtype=np.uint64)
    for n in (20, 60, 150, 300):
        for _ in range(12):
            own = np.concatenate([rng.integers(0, 1 << 64, n, dtype=np.uint64), passage[:n // 2]])
            most = len(own) * (100 - num) // 100
            pairs.append((len(sets), len(sets) + 1))
            sets += [np.unique(own), np.unique(own[most:])]
    signatures = ngram.Signatures(**options)
    rows = [(i, int(s)) for i, own in enumerate(sets) for s in signatures.of(own).view(np.int64)]
    members = collections.Counter(s for _, s in rows)
    shared = spark.createDataFrame([(i, s, members[s]) for i, s in rows if members[s] > 1], "rep bigint, sig bigint, members bigint")
    kept = collections.defaultdict(set)
    for r in ngram.kept_signatures(shared, signatures.spare()).collect():
        kept[r.rep].add(r.sig)
    assert all(kept[a] & kept[b] for a, b in pairs)
    assert sum(map(len, kept.values())) < shared.count()


def test_close_pairs_are_the_closest_of_each_member(spark):
    rng = np.random.default_rng(3)
    base = [rng.integers(0, 1 << 64, n, dtype=np.uint64) for n in (60, 70, 130)]
    sets = [np.unique(np.concatenate([b[rng.integers(0, 8):], rng.integers(0, 1 << 64, rng.integers(0, 5), dtype=np.uint64)]))
            for b in base for _ in range(8)]
    label = [i if i % 4 else 0 for i in range(len(sets))]
    sketches = [ngram.sketch(s) for s in sets]
    buckets = {1: range(0, 8), 2: range(4, 20), 3: [0, 4], 4: range(24), 5: [1, 9]}
    named = spark.createDataFrame([(i, len(s), bytearray(k), x) for i, (s, k, x) in enumerate(zip(sets, sketches, label))],
                                  "rep bigint, n bigint, sketch binary, label bigint")
    rows = spark.createDataFrame([(b, i) for b, m in buckets.items() for i in m], "bucket bigint, rep bigint").repartition(2)

    def near(a, b):
        n, m = len(sets[a]), len(sets[b])
        apart = ngram.bits_apart(sketches[a], sketches[b])
        return label[a] != label[b] and 100 * min(n, m) >= 80 * max(n, m) and apart <= (n + m) * 20 // 180
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for batch in ("3", "10000"):  # buckets go on in the next batches
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            every = [tuple(r) for r in ngram.close_pairs(rows, named, 20, 80, 100, 99).collect()]
            one = [tuple(r) for r in ngram.close_pairs(rows, named, 20, 80, 100, 1).collect()]
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        for got in (every, one):
            assert {(b, r) for b, r, o in got if r is not None and o is None} == {(4, i) for i in range(24)}
        pairs = {(b, r, o) for b, r, o in every if o is not None}
        exact = {(b, x, y) for b, m in buckets.items() if b != 4 for x in m for y in m if x < y and near(x, y)}
        # sketches of several lengths in a bucket are folded to the least, which may let more pairs through
        assert exact <= pairs and not [r for _, r, o in every if r is None]
        first = {(b, r, o) for b, r, o in one if o is not None}
        assert first < pairs and {(b, x) for b, r, o in pairs for x in (r, o)} == {(b, x) for b, r, o in first for x in (r, o)}
        assert {b for b, r, _ in one if r is None} == {b for b, _, _ in pairs - first}
