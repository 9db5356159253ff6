"""Removal of byte strings that occur more than once, by suffix arrays of candidate runs.

Only equal strings can have equal neighbours in a suffix array, so the corpus
is first cut into parts that hold all equal strings together. A window (a
string of ``width`` bytes) belongs to the bucket of its minimizer, the least
hash among its grams; neighbouring windows with the same gram form a run.
Equal windows have equal minimizers, so they meet in one bucket. Runs of equal
content are counted, not repeated: a run found twice is covered whole. The
distinct runs of a bucket become one text, whose suffix array
(``suffix_groups``) brings equal windows side by side; neighbours are compared
byte by byte.

A bucket of more than ``MOST_RUNS`` distinct runs (a passage that very many
texts continue differently) is not gathered: its windows are counted by a
128-bit hash with partial aggregation.

Defined results: null and empty texts have no bytes; texts shorter than
``width`` have no window; repeated rows cover each other; a null id stays
null; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, slices, store, texts
from .suffix_groups import lockstep, single

WIDTH, GRAM, MOST_RUNS = 200, 24, 4096
#: Bytes hashed in one step, and bytes of the texts that are sorted in one step.
STEP_BYTES, SORT_BYTES = 1 << 22, 1 << 22
#: Microseconds: a symbol of a text sorted alone; a step of many texts, and each symbol of theirs.
SINGLE_COST, STEP_COST, TOGETHER_COST = 1.2, 80, 0.2

_RNG = np.random.default_rng(20240611)
_BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _RNG.integers(0, 1 << 62, 40, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int) -> list[int]:
    """The binary parts of ``n``, largest first."""
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the ``k`` bytes that begin at each position."""
    if len(data) < k:
        return np.empty(0, dtype=np.uint64)
    levels, size = {1: _BYTES[data]}, 1
    while 2 * size <= k:
        h = levels[size]
        h = h[:-size] * _ODD[size.bit_length()] + h[size:]
        levels[2 * size] = h ^ (h >> np.uint64(29))
        size *= 2
    out, done = None, 0
    for part in _powers(k):
        if out is None:
            out = levels[part]
        else:
            n = len(data) - done - part + 1
            out = out[:n] * _ODD[20 + part.bit_length()] + levels[part][done:done + n]
        done += part
    out = (out ^ (out >> np.uint64(32))) * _ODD[39]
    return out ^ (out >> np.uint64(29))


def window_minima(values: np.ndarray, w: int) -> np.ndarray:
    """The least of the ``w`` values that begin at each position."""
    size, m = 1, values
    while 2 * size <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[:len(m) - (w - size)], m[w - size:]) if w > size else m


def window_runs(data: bytes, bounds: np.ndarray, width: int, gram: int) -> list[tuple]:
    """(text, start, windows, key, content hash, gram) of the runs of the texts that ``bounds`` cuts ``data`` into.

    ``gram`` is the minimizer's place in the run.
    """
    out, total = [], len(data)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for base in range(0, total, STEP_BYTES):
        part = np.frombuffer(data, np.uint8, min(total - base, STEP_BYTES + width - 1), base)
        if len(part) < width:
            continue
        h = gram_hashes(part, gram)
        # the leftmost least gram, by 40 bits of its hash; the rest of the word is its place
        least = window_minima((h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64), width - gram + 1)
        text = owner[base:base + len(least)]
        at = np.flatnonzero(np.arange(base + width, base + width + len(least)) <= bounds[text + 1])
        if not len(at):
            continue
        place, text = (least[at] & np.uint64((1 << 24) - 1)).astype(np.int64), text[at]
        new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
        count = np.diff(np.append(new, len(at)))
        first = at[new] + base
        content = [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(first.tolist(), (first + count + width - 1).tolist())]
        out.append((text[new], first - bounds[text[new]], count, h[place[new]], np.array(content, dtype=np.uint64),
                    place[new] + base - first))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, dtype=np.int64)] * 3 + [
        np.empty(0, np.uint64)] * 2 + [np.empty(0, dtype=np.int64)]


def run_rows(docs: DataFrame, text_col: str, width: int, gram: int) -> DataFrame:
    """(row_no, start, windows, key, content, gram) of every run of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data = texts(part)
                text, start, count, key, content, place = window_runs(
                    b"".join(data), np.cumsum([0, *map(len, data)]), width, gram)
                yield pa.RecordBatch.from_arrays([
                    part.column("row_no").take(pa.array(text)), pa.array(start.astype(np.int64)),
                    pa.array(count.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(content.view(np.int64)),
                    pa.array(place.astype(np.int32))], names=["row_no", "start", "windows", "key", "content", "gram"])

    rows = numbered(docs).select("row_no", F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "row_no bigint, start bigint, windows int, key bigint, content bigint, gram int")


def run_contents(docs: DataFrame, contents: DataFrame, text_col: str, width: int) -> DataFrame:
    """(key, content, gram, bytes) of ``contents`` (and windows, row_no, start), cut from one text that holds each."""
    wanted = contents.groupBy("row_no").agg(F.collect_list(F.struct("key", "content", "start", "windows", "gram")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [(r["key"], r["content"], r["gram"], t[r["start"]:r["start"] + r["windows"] + width - 1])
                        for t, runs in zip(texts(part), part.column("runs").to_pylist()) for r in runs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                    names=["key", "content", "gram", "bytes"])

    rows = numbered(docs).select("row_no", F.col(text_col).alias("text")).join(wanted.hint("merge"), "row_no")
    return rows.select("text", "runs").mapInArrow(run, "key bigint, content bigint, gram int, bytes binary")


def words8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes that begin at each position, as one number."""
    v = data.astype(np.uint64)
    for size in (1, 2, 4):
        v = v[:-size] | v[size:] << np.uint64(8 * size)
    return v


def repeated_windows(buckets: list[list[bytes]], width: int) -> list[np.ndarray]:
    """Per run, bucket after bucket: which of its windows begin elsewhere in the bucket too."""
    order = sorted(range(len(buckets)), key=lambda i: -sum(map(len, buckets[i])) - len(buckets[i]))
    lengths = np.array([sum(map(len, buckets[i])) + len(buckets[i]) + 1 for i in order])
    data = np.frombuffer(b"".join(b"\0".join(buckets[i]) + b"\0\0" for i in order) + bytes(8), np.uint8)
    symbols = data[:-8].astype(np.int64) + 2
    end = np.cumsum(lengths)
    sizes = [[len(r) for r in buckets[i]] for i in order]
    run_len = np.array([n for s in sizes for n in s])
    begin = np.concatenate([np.cumsum([e - n, *(x + 1 for x in s[:-1])]) for e, n, s in zip(end.tolist(), lengths.tolist(), sizes)])
    symbols[begin + run_len], symbols[end - 1] = 1, 0  # the end of a run; the end of the text
    alone = longest_alone(lengths)
    cut = int(end[alone - 1]) if alone else 0
    sa = [np.array(single(symbols[e - n:e].tolist())) + (e - n) for e, n in zip(end[:alone].tolist(), lengths[:alone].tolist())]
    if alone < len(order):
        sa.append(lockstep(symbols[cut:], lengths[alone:]).astype(np.int64) + cut)
    sa = np.concatenate(sa)
    valid = np.zeros(len(symbols), dtype=bool)
    whole = np.repeat(begin, run_len - width + 1)
    at = whole + np.arange(len(whole)) - np.repeat(np.cumsum(run_len - width + 1) - (run_len - width + 1), run_len - width + 1)
    valid[at] = True
    near = np.flatnonzero(valid[sa[:-1]] & valid[sa[1:]])
    a, b, eight = sa[near], sa[near + 1], words8(data)
    text = np.searchsorted(end, a, side="right") == np.searchsorted(end, b, side="right")
    a, b = a[text], b[text]
    for off in [*range(0, width - 7, 8), width - 8]:
        same = eight[a + off] == eight[b + off]
        a, b = a[same], b[same]
    again = np.zeros(len(symbols), dtype=bool)
    again[a] = again[b] = True
    found = [again[p:p + n - width + 1] for p, n in zip(begin.tolist(), run_len.tolist())]
    back, k = [None] * len(buckets), 0
    for i in order:
        back[i] = found[k:k + len(buckets[i])]
        k += len(buckets[i])
    return [f for fs in back for f in fs]


def longest_alone(lengths: np.ndarray) -> int:
    """How many of the texts, longest first, are sorted one by one; the others go in step (measured costs decide)."""
    before = np.concatenate([[0], np.cumsum(lengths)])
    step = np.append(lengths, 0) * STEP_COST
    return int(np.argmin(before * SINGLE_COST + step + (before[-1] - before) * TOGETHER_COST))


def spans(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true values as (first, after last)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


_SPANS = "key bigint, content bigint, spans array<struct<lo:int,hi:int>>"


def with_partners(runs: list[tuple[int, int, bytes]], width: int, gram: int) -> list[tuple[int, int, bytes]]:
    """The runs (content, gram place, bytes) of a bucket that another run can share a window with.

    A window holds either the gram and half of its other bytes before it, or
    the gram and the other half after it; one of the two must occur in another run.
    """
    half = (width - gram + 1) // 2
    after = width - half + 1
    parts = [(d[g - half:g + gram] if g >= half else None, d[g:g + after] if g + after <= len(d) else None) for _, g, d in runs]
    seen = [Counter(p[side] for p in parts if p[side] is not None) for side in (0, 1)]
    return [r for r, p in zip(runs, parts) if any(p[side] is not None and seen[side][p[side]] > 1 for side in (0, 1))]


def sorted_buckets(contents: DataFrame, width: int, gram: int) -> DataFrame:
    """(key, content, spans): repeated windows of the runs (key, content, gram, bytes), bucket by bucket."""
    kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))

    def solve(buckets: list[tuple[int, list]]) -> pa.RecordBatch:
        marks = repeated_windows([[d for _, _, d in runs] for _, runs in buckets], width) if buckets else []
        names = [(key, c) for key, runs in buckets for c, _, _ in runs]
        rows = [(k, c, [{"lo": lo, "hi": hi} for lo, hi in spans(m)]) for (k, c), m in zip(names, marks) if m.any()]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([r[2] for r in rows], kind)], names=["key", "content", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, key, runs = [], 0, None, []

        def close() -> int:
            kept = with_partners(runs, width, gram) if len(runs) > 1 else []
            if kept:
                held.append((key, kept))
            return sum(len(d) for _, _, d in kept)

        for batch in batches:
            for k, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "content", "gram", "bytes"))):
                if k != key:
                    size += close()
                    key, runs = k, []
                    if size > SORT_BYTES:
                        yield solve(held)
                        held, size = [], 0
                runs.append(tuple(row))
        close()
        yield solve(held)

    return contents.repartition("key").sortWithinPartitions("key").mapInArrow(run, _SPANS)


def counted_windows(contents: DataFrame, width: int) -> DataFrame:
    """The same as ``sorted_buckets`` for buckets too large to gather, by counting window hashes."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column("bytes")[i].as_py()
                own = [xxhash.xxh3_128_digest(data[j:j + width]) for j in range(len(data) - width + 1)]
                n = len(own)
                yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array([i] * n)),
                                                  batch.column("content").take(pa.array([i] * n)),
                                                  pa.array(range(n), pa.int32()), pa.array(own, pa.binary())],
                                                 names=["key", "content", "lo", "window"])

    each = store(contents.mapInArrow(hashes, "key bigint, content bigint, lo int, window binary"), "windows")
    twice = store(each.groupBy("key", "window").agg(F.count("*").alias("n")).filter("n > 1").select("key", "window"), "twice")
    return each.join(twice, ["key", "window"]).groupBy("key", "content").agg(F.collect_list(F.struct(
        "lo", (F.col("lo") + 1).alias("hi"))).alias("spans"))


def repeated_spans(docs: DataFrame, text_col: str = "text", width: int = WIDTH, gram: int = GRAM,
                   most_runs: int = MOST_RUNS) -> DataFrame:
    """(row_no, spans): byte ranges covered by strings of ``width`` bytes that begin at two places or more.

    Ranges may overlap. ``docs`` is a table just read; its texts are read
    again where runs are cut from them. Joins with it and with the runs are
    merge joins at every size, as the other side grows with the texts.
    """
    runs = store(run_rows(docs, text_col, width, gram), "all_runs")
    shared = runs.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    runs = store(runs.join(shared.hint("merge"), "key", "left_semi"), "runs")
    contents = store(runs.groupBy("key", "content").agg(
        F.count("*").alias("n"), F.max("windows").alias("windows"), F.max("gram").alias("gram"), F.min(F.struct("row_no", "start")).alias("at")).select(
        "key", "content", "n", "windows", "gram", "at.row_no", "at.start"), "contents")
    sizes = store(contents.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1"), "buckets")
    compared = contents.join(sizes, "key").select("key", "content", "gram", "windows", "row_no", "start")
    data = store(run_contents(docs, compared, text_col, width), "contents")
    large = store(sizes.filter(F.col("members") > most_runs).select("key"), "large")
    found = sorted_buckets(data.join(large, "key", "left_anti"), width, gram)
    if not large.isEmpty():
        found = found.unionByName(counted_windows(data.join(large, "key", "left_semi"), width).select("key", "content", "spans"))
    whole = contents.filter("n > 1").select("key", "content", F.array(F.struct(
        F.lit(0).alias("lo"), F.col("windows").alias("hi"))).alias("spans"))
    found = found.join(whole.select("key", "content"), ["key", "content"], "left_anti").unionByName(whole)
    found = store(found, "repeated")
    marked = runs.select("row_no", "start", "key", "content").join(found, ["key", "content"]).select(
        "row_no", F.transform("spans", lambda s: F.struct((F.col("start") + s.lo).alias("lo"), (
            F.col("start") + s.hi + (width - 1)).alias("hi"))).alias("spans"))
    return marked.groupBy("row_no").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def merged(ranges: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs covered by the ranges."""
    out: list[list[int]] = []
    for lo, hi in sorted((r["lo"], r["hi"]) for r in ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(r) for r in out]


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM,
                 most_runs: int = MOST_RUNS) -> DataFrame:
    """Per row of ``docs``: row_no, id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed) and kept (bytes)."""
    ranges = store(repeated_spans(docs, text_col, width, gram, most_runs), "spans")
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                for t, ranges in zip(texts(part), part.column("spans").to_pylist()):
                    cut = merged(ranges or [])
                    kept = b"".join(t[a:b] for a, b in zip([0, *(hi for _, hi in cut)], [*(lo for lo, _ in cut), len(t)]))
                    rows.append((len(t), len(t) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(),
                                 [{"lo": lo, "hi": hi} for lo, hi in cut], kept))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_no"), part.column("id"),
                     *(pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(), kind,
                                                                   pa.binary())))],
                    names=["row_no", "id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    rows = numbered(docs).select("row_no", F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.join(ranges.hint("merge"), "row_no", "left").mapInArrow(
        run, "row_no bigint, id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
             "spans array<struct<lo:bigint,hi:bigint>>, kept binary")
