"""Jaccard join of word n-gram sets with PartEnum signatures.

Sets within the similarity differ in at most k elements, and k follows from
their sizes. For each band of sizes the feature domain (hashes) is cut into
``n1`` partitions of ``n2`` cells; a signature is the content of ``n2 - k2``
cells of a partition, for every such subset of its cells. The differing
elements cannot spoil more than ``spoiled = k // (k2 + 1)`` partitions beyond
``k2`` cells each, so similar sets agree in a signature of each of the other
``n1 - spoiled``. Sets with ``k`` up to ``SHORT`` have one partition and all
subsets that leave out ``k`` cells.

Signatures of few or no elements are shared by unrelated sets. ``SLACK`` more
partitions than needed let each set keep back its weakest ones: of its
partitions, all but ``n1 - spoiled - 1`` keep every signature. Two similar sets
still share one: equal signatures have equal counts, so what either keeps back
of those they share is what the one with the higher limit does, and lies in at
most ``n1 - spoiled - 1`` of the ``n1 - spoiled`` partitions.

The same holds for any other order of signatures, so a part of the slack goes
to those of the largest buckets instead (``kept_signatures``).

Equal sets are one class and only classes are joined. Classes that share a
signature are a bucket. Each member is first compared with the one before it
by number; buckets whose members are connected by then make no more pairs.
Pairs are told apart by sketches: two sets differ in at least as many elements
as their sketches differ in bits (``sketch``). In buckets of up to ``SMALL``
members this is done inside the task, and each member is compared with its
closest others (``close_pairs``). Members of buckets that have more, and those
of larger buckets, are compared with one pivot of all connected ones, and those
that do not link with it meet others only where they share what the pivot has
not (``class_links``). No link between components is lost.

Defined results: a text without words has no shingle, links with nothing and
is its own class; a null text likewise; equal rows are one class; a null id is
never a component's id unless all ids there are null; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idweave.operators.components import connected

from .common import numbered, semi_join_rows, slices, store, texts

WORDS, NUM, DEN, N2, K2 = 3, 90, 100, 3, 1
#: Sizes of a band grow by at most this ratio; share of partitions beyond the needed ones.
BAND, SLACK = 1.25, 0.2
#: Share of what is kept back that goes by the elements of a signature; the rest goes by the members of its bucket.
FEW = 0.25
#: Sets that may differ in so many elements have one partition, of three cells more.
SHORT = 5
#: Bits of a signature's content, and of its partition and band, which follow. Contents that clash only make a bucket larger.
BITS, PART_BITS, BAND_BITS = 40, 16, 6
#: Stands for all bands from it on; their large buckets are not kept back.
LAST_BAND = (1 << BAND_BITS) - 1
#: Members of a bucket whose pairs all become rows; members of one whose pairs are looked at by their sketches in its task.
FEW_MEMBERS, SMALL = 4, 2048
#: Closest others of a member of a bucket with which it is compared; the buckets of those with more go to the pivots.
CLOSEST = 1
#: Pairs that a task holds before it sends them.
HELD_PAIRS = 1 << 20
#: Members of a sub-bucket whose pairs are compared at once, in the first round; four times as many in each later one.
PAIRED = 32

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def shingle_set(words: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of a sequence of word hashes (the whole of a shorter one)."""
    if not len(words):
        return words
    n = min(n, len(words))
    h = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[i:len(words) - n + 1 + i])
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def sketch(hashes: np.ndarray) -> bytes:
    """One bit for each of 64 or more cells of the hashes, a power of two no less than the set: is their number odd?

    An element that only one of two sets has changes one bit, so two sets differ in no fewer elements than bits.
    """
    cells = 1 << max(6, (len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ; the longer one is folded, which gives the sketch of fewer cells."""
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        half = len(a) // 2
        a = (int.from_bytes(a[:half]) ^ int.from_bytes(a[half:])).to_bytes(half)
    return (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()


class Signatures:
    """PartEnum signatures of sets of sorted 64-bit hashes at a Jaccard similarity of ``num / den``."""

    def __init__(self, num: int = NUM, den: int = DEN, n2: int = N2, k2: int = K2):
        self.num, self.den, self.n2, self.k2 = num, den, n2, k2
        self.tops = [1]  # largest size of each band
        self.plans: dict[int, tuple] = {}

    def band(self, size: int) -> int:
        """The band of a size."""
        while self.tops[-1] < size:
            self.tops.append(max(self.tops[-1] + 1, int(self.tops[-1] * BAND)))
        return int(np.searchsorted(self.tops, size))

    def partitions(self, band: int) -> tuple[int, int, int, int, int]:
        """Partitions of a band, those kept back at most for few elements and for large buckets, cells of each, those left out."""
        k = 2 * self.tops[band] * (self.den - self.num) // (self.den + self.num)
        n2, k2 = (k + 3, k) if k <= SHORT else (self.n2, self.k2)
        spoiled = k // (k2 + 1)
        back = int(np.ceil(SLACK * (spoiled + 1))) if k > SHORT else 0
        n1 = spoiled + 1 + back if k else 0
        large = back - int(np.ceil(FEW * back)) if band < LAST_BAND and n1 <= 1 << PART_BITS else 0
        return n1, back - large, large, n2, k2

    def spare(self) -> list[int]:
        """Per band that a signature names: partitions that are kept back at most for large buckets."""
        while len(self.tops) <= LAST_BAND:
            self.band(self.tops[-1] + 1)
        return [self.partitions(band)[2] for band in range(LAST_BAND + 1)]

    def plan(self, band: int) -> tuple[int, int, int, np.ndarray, np.ndarray, np.ndarray]:
        """Partitions of a band, those kept back at most for few elements, cells of each; a column of ones and zeros for
        each subset of the cells; where cells begin in the domain; a value for each partition and subset."""
        if band not in self.plans:
            n1, back, _, n2, k2 = self.partitions(band)
            edges = np.array([(i << 64) // max(1, n1 * n2) for i in range(1, n1 * n2)], dtype=np.uint64)
            subsets = np.array([[i in c for i in range(n2)] for c in combinations(range(n2), n2 - k2)], dtype=np.int64).T
            place = np.arange(n1 * subsets.shape[1], dtype=np.uint64) + np.uint64((band + 1) << 32)
            self.plans[band] = n1, back, n2, subsets, edges, mixed(place).reshape(n1, subsets.shape[1])
        return self.plans[band]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The signatures of one set; sets that only an equal set can match have none."""
        size, out = len(hashes), []
        if not size:
            return np.empty(0, dtype=np.uint64)
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
        for band in range(self.band(size), self.band(size * self.den // self.num) + 1):
            n1, back, n2, subsets, edges, place = self.plan(band)
            if not n1:
                continue
            at = np.concatenate([[0], np.searchsorted(hashes, edges), [size]])
            cell, count = (total[at[1:]] - total[at[:-1]]).reshape(n1, n2), np.diff(at).reshape(n1, n2)
            held, sums = count @ subsets, cell @ subsets.astype(np.uint64)
            least = np.sort(held.min(axis=1))[back]  # at most ``back`` partitions have a signature of fewer elements
            keep = held >= least
            home = np.minimum(np.nonzero(keep)[0], (1 << PART_BITS) - 1) << BAND_BITS | min(band, LAST_BAND)
            value = mixed(sums[keep] + place[keep]) >> np.uint64(64 - BITS)
            out.append(value << np.uint64(PART_BITS + BAND_BITS) | home.astype(np.uint64))
        return np.unique(np.concatenate(out)) if out else np.empty(0, dtype=np.uint64)


#: Bytes whose sums are made at once, and the odd base of the sums.
_BLOCK, _BASE = 1 << 18, 0x9E3779B97F4A7C15
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LETTER = mixed(np.arange(256, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(1))
_LETTER[65:91] = _LETTER[97:123]  # A-Z as a-z


@cache
def _powers(base: int) -> np.ndarray:
    """``base`` to the power of 0, 1, ... ``_BLOCK``, modulo 2 ** 64."""
    return np.cumprod(np.array([1] + [base] * _BLOCK, dtype=np.uint64), dtype=np.uint64)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Place and 64-bit hash of each word between ASCII white space, A-Z as a-z.

    A word's hash is the sum of its letters' values times powers of a base, by
    place; with running sums over the bytes it is one difference, whatever the
    word's length, so no word is ever cut out or held.
    """
    inverse, text = pow(_BASE, -1, 1 << 64), np.frombuffer(data, np.uint8)
    total, scale, back, inside = np.uint64(0), 1, 1, False
    places, sums, shifts = [], [], []
    for at in range(0, len(text), _BLOCK):
        part = text[at:at + _BLOCK]
        before = np.empty(len(part) + 1, dtype=np.uint64)
        before[0] = 0
        np.cumsum(_LETTER[part] * _powers(_BASE)[:len(part)], out=before[1:])
        before = before * np.uint64(scale) + total
        letters = ~_SPACE[part]
        edges = np.flatnonzero(letters != np.concatenate([[inside], letters[:-1]]))
        places.append(edges + at)
        sums.append(before[edges])
        shifts.append(_powers(inverse)[edges] * np.uint64(back))
        total, inside = before[-1], bool(letters[-1])
        scale, back = scale * pow(_BASE, len(part), 1 << 64) % (1 << 64), back * pow(inverse, len(part), 1 << 64) % (1 << 64)
    if inside:
        places.append([len(text)])
        sums.append(np.array([total]))
        shifts.append(np.zeros(1, np.uint64))
    if not sums:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    place, run = np.concatenate(places), np.concatenate(sums)
    shift = np.concatenate(shifts)[::2]
    length = (place[1::2] - place[::2]).astype(np.uint64)
    return place[::2], mixed((run[1::2] - run[::2]) * shift + length)


def text_sets(values: list[bytes], n: int) -> list[np.ndarray]:
    """The shingle set of each text."""
    place, hashes = word_hashes(b"\n".join(values))
    ends = np.searchsorted(place, np.cumsum([len(v) + 1 for v in values])).tolist()
    return [shingle_set(hashes[a:b], n) for a, b in zip([0, *ends], ends)]


def shingle_rows(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Per row: row_no, id, n (set size), set_key (128-bit, null for an empty set) and sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = text_sets(texts(part), words)
                yield pa.RecordBatch.from_arrays([
                    part.column("row_no"), part.column("id"), pa.array(map(len, sets), pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array(map(sketch, sets), pa.binary()),
                ], names=["row_no", "id", "n", "set_key", "sketch"])

    rows = numbered(docs).select("row_no", F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "row_no bigint, id bigint, n bigint, set_key binary, sketch binary")


def signature_rows(docs: DataFrame, wanted: DataFrame, text_col: str, words: int, options: dict) -> DataFrame:
    """(rep, sig): the signatures of the rows in ``wanted`` (rep).

    They are made again from the texts, as they are larger than these: storing them would take more disk than the input.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = Signatures(**options)
        for batch in batches:
            for part in slices(batch):
                sigs = list(map(signatures.of, text_sets(texts(part), words)))
                rep = np.repeat(part.column("rep").to_numpy(), list(map(len, sigs)))
                yield pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), pa.array(np.concatenate(sigs).view(np.int64))],
                                                 names=["rep", "sig"])

    rows = numbered(docs, "rep").select("rep", F.col(text_col).alias("text"))
    return semi_join_rows(rows, wanted, "rep").mapInArrow(run, "rep bigint, sig bigint")


def kept_signatures(shared: DataFrame, spare: list[int]) -> DataFrame:
    """(rep, sig) of ``shared`` (rep, sig, members) without those in the largest buckets.

    A set keeps back the signatures of more members than a limit of its own, the least one that leaves those in
    ``spare`` partitions of a band; one with signatures in no more partitions shares too few to link.
    """
    part = F.col("sig").bitwiseAND((1 << PART_BITS + BAND_BITS) - 1)
    rows = shared.repartition("rep").withColumns({"part": part, "band": F.col("sig").bitwiseAND(LAST_BAND).cast("int")})
    own = Window.partitionBy("rep", "band")
    most = F.max("members").over(Window.partitionBy("rep", "band", "part"))
    place = F.dense_rank().over(own.orderBy(F.desc("most"), "part"))
    counted = F.col("place") > F.get(F.array(*map(F.lit, spare)), F.col("band"))
    limit = F.max(F.when(counted, F.col("most"))).over(own)
    ranked = rows.withColumn("most", most).withColumn("place", place).withColumn("limit", limit)
    return ranked.filter("members <= limit").select("rep", "sig")


def bucket_pairs(postings: DataFrame, small: int, least: int = 1) -> DataFrame:
    """(bucket, rep, other) from (rep, sig): the pairs of the buckets of 2 to ``small`` members, once a task, and the
    members of the larger ones, where ``other`` is null.

    With a column ``label``, pairs of one label and buckets of one label only are left out. Pairs less than ``least``
    places apart, by rep, are left out too.
    A bucket's rows come one after another, so a task holds ``small`` rows of one at most.
    """
    def rows(bucket: np.ndarray, rep: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(rep), pa.nulls(len(rep), pa.int64())],
                                          names=["bucket", "rep", "other"])

    def distinct(pairs: list) -> Iterator[pa.RecordBatch]:
        if pairs:
            a, b = (np.concatenate(c) for c in zip(*pairs))
            table = pa.table({"rep": np.minimum(a, b), "other": np.maximum(a, b)}).group_by(["rep", "other"]).aggregate([])
            table = table.add_column(0, "bucket", pa.nulls(len(table), pa.int64())).select(["bucket", "rep", "other"])
            yield from table.to_batches(max_chunksize=1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (sig, rep, label), large, pairs, held = [np.empty(0, np.int64)] * 3, None, [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                sig = np.concatenate([sig, batch.column("sig").to_numpy()])
                rep = np.concatenate([rep, batch.column("rep").to_numpy()])
                label = np.concatenate([label, batch.column("label").to_numpy()])
            if not len(sig):
                continue
            first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            ends = np.append(first[1:], len(sig))
            size = ends - first
            over = (size > small) | (sig[first] == large if large is not None else False)
            done = len(first) if batch is None or over[-1] else len(first) - 1  # the last bucket may go on
            large = int(sig[-1]) if over[-1] else None
            cut = ends[done - 1] if done else 0
            wide = np.repeat(over[:done], size[:done])
            if wide.any():
                yield rows(sig[:cut][wide], rep[:cut][wide])
            left, at = np.repeat(ends[:done], size[:done]) - np.arange(cut), np.flatnonzero(~wide)
            for step in range(least, small):
                at = at[left[at] > step]
                if not len(at):
                    break
                apart = at[label[at] != label[at + step]]
                pairs.append((rep[apart], rep[apart + step]))
                held += len(apart)
            sig, rep, label = sig[cut:], rep[cut:], label[cut:]
            if held > HELD_PAIRS:
                yield from distinct(pairs)
                pairs, held = [], 0
        yield from distinct(pairs)

    bucket = Window.partitionBy("sig")  # one exchange; a group is streamed, with spill
    named = postings if "label" in postings.columns else postings.withColumn("label", F.col("rep"))
    shared = named.withColumns({"low": F.min("label").over(bucket), "high": F.max("label").over(bucket)}).filter("low < high")
    return shared.select("rep", "sig", "label").sortWithinPartitions("sig", "rep").mapInArrow(
        run, "bucket bigint, rep bigint, other bigint")


def near_pairs(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (pivot, rep) whose sizes and sketches do not rule a link out; ``sketches``: rep, n, sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("n").to_pylist(), batch.column("m").to_pylist()
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            keep = [bits_apart(a, b) <= (i + j) * (den - num) // (den + num) for a, b, i, j in zip(x, y, n, m)]
            yield batch.select(["pivot", "rep"]).filter(pa.array(keep, pa.bool_()))

    one = sketches.select("rep", F.col("n").alias("m"), F.col("sketch").alias("y"))
    two = sketches.select(F.col("rep").alias("pivot"), "n", F.col("sketch").alias("x"))
    sized = pairs.join(one, "rep").join(two, "pivot").filter(den * F.least("n", "m") >= num * F.greatest("n", "m"))
    return sized.select("pivot", "rep", "n", "m", "x", "y").mapInArrow(run, "pivot bigint, rep bigint")


def folded(sketches: pa.Array, width: int) -> np.ndarray:
    """Sketches of ``width`` bytes or more as rows of 64-bit words, longer ones folded (``bits_apart``)."""
    length = pc.binary_length(sketches).to_numpy()
    starts = np.frombuffer(sketches.buffers()[1], np.int32)[sketches.offset:sketches.offset + len(sketches)]
    data, out = np.frombuffer(sketches.buffers()[2], np.uint8), np.empty((len(sketches), width // 8), np.uint64)
    for size in np.unique(length).tolist():
        at = np.flatnonzero(length == size)
        part = data[starts[at][:, None] + np.arange(size)]
        while part.shape[1] > width:
            part = part[:, :part.shape[1] // 2] ^ part[:, part.shape[1] // 2:]
        out[at] = np.ascontiguousarray(part).view(np.uint64)
    return out


def closest(pairs: list[tuple[np.ndarray, ...]], most: int) -> tuple[np.ndarray, ...]:
    """Of pairs (one, other, apart) those that are among the ``most`` closest of one of their two ends."""
    one, other, apart = (np.concatenate(c) for c in zip(*pairs))
    ends, twice = np.concatenate([one, other]), np.concatenate([apart, apart])
    order = np.lexsort((twice, ends))
    place = np.arange(len(ends)) - np.searchsorted(ends[order], ends[order])
    keep = np.zeros(len(one), dtype=bool)
    keep[order[place < most] % len(one)] = True
    return one[keep], other[keep], apart[keep]


def close_pairs(members: DataFrame, sketches: DataFrame, small: int, num: int, den: int, most: int) -> DataFrame:
    """(bucket, rep, other) from (bucket, rep): pairs of buckets of up to ``small`` members as in ``near_pairs``, the
    ``most`` closest of each member; a row of the bucket alone, if it has more; and the members of larger buckets, where
    ``other`` is null. ``sketches``: rep, n, sketch, label; pairs and buckets of one label are left out.

    Members bring their sketches, so that only pairs that may link become rows. A task holds one bucket at most beside
    a batch, and a member is told apart from ``small`` others at most in a bucket.
    """
    names = ["bucket", "rep", "other"]

    def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket, rep, label, n = (rows.column(c).to_numpy() for c in ("bucket", "rep", "label", "n"))
        sketch = rows.column("sketch").combine_chunks()
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        size = np.diff(np.append(first, len(bucket)))
        least = np.repeat(np.minimum.reduceat(pc.binary_length(sketch).to_numpy(), first), size)
        left = np.repeat(first + size, size) - np.arange(len(bucket))
        near, held, more = [], 0, []
        for width in np.unique(least).tolist():
            of = np.flatnonzero(least == width)  # whole buckets
            words = folded(sketch.take(pa.array(of)), width)
            at = np.arange(len(of))
            for step in range(1, small):
                at = at[left[of[at]] > step]
                if not len(at):
                    break
                i, j = of[at], of[at] + step
                fits = (label[i] != label[j]) & (den * np.minimum(n[i], n[j]) >= num * np.maximum(n[i], n[j]))
                one, i, j = at[fits], i[fits], j[fits]
                apart = np.bitwise_count(words[one] ^ words[one + step]).sum(axis=1, dtype=np.int64)
                fits = apart <= (n[i] + n[j]) * (den - num) // (den + num)
                near.append((i[fits], j[fits], apart[fits]))
                held += len(near[-1][0])
                if held > HELD_PAIRS:
                    near, held = [chosen(near, bucket, more)], 0
        if near:
            i, j, _ = chosen(near, bucket, more)
            yield pa.RecordBatch.from_arrays([pa.array(bucket[i]), pa.array(np.minimum(rep[i], rep[j])),
                                              pa.array(np.maximum(rep[i], rep[j]))], names=names)
            again = np.unique(np.concatenate(more))
            yield pa.RecordBatch.from_arrays([pa.array(again), *[pa.nulls(len(again), pa.int64())] * 2], names=names)

    def chosen(near: list, bucket: np.ndarray, more: list) -> tuple[np.ndarray, ...]:
        kept = closest(near, most)
        before, after = (np.unique(bucket[i], return_counts=True) for i in (np.concatenate([i for i, _, _ in near]), kept[0]))
        more.append(before[0][before[1] > after[1]])
        return kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in chain(batches, [None]):
            if batch is not None:
                large = batch.filter(pc.greater(batch.column("members"), small))
                if len(large):
                    yield pa.RecordBatch.from_arrays([large.column("bucket"), large.column("rep"), pa.nulls(len(large), pa.int64())],
                                                     names=names)
                few = pa.Table.from_batches([batch.filter(pc.less_equal(batch.column("members"), small))])
                rest = few if rest is None else pa.concat_tables([rest, few])
            if rest is None or not len(rest):
                continue
            bucket = rest.column("bucket").to_numpy()
            cut = len(bucket) if batch is None else int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
            if cut:
                yield from found(rest.slice(0, cut))
                rest = rest.slice(cut).combine_chunks()

    bucket = Window.partitionBy("bucket")
    counted = members.join(sketches, "rep").withColumns({
        "members": F.count("*").over(bucket), "low": F.min("label").over(bucket), "high": F.max("label").over(bucket)})
    rows = counted.filter("low < high").select("bucket", "rep", "label", "n", "sketch", "members").sortWithinPartitions("bucket")
    return rows.mapInArrow(run, "bucket bigint, rep bigint, other bigint")


def shingle_sets(docs: DataFrame, wanted: DataFrame, text_col: str, words: int) -> DataFrame:
    """(rep, grams): the sets of the rows in ``wanted`` (rep), as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(
                    [s.tobytes() for s in text_sets(texts(part), words)], pa.binary())], names=["rep", "grams"])

    rows = numbered(docs, "rep").select("rep", F.col(text_col).alias("text"))
    return semi_join_rows(rows, wanted, "rep").mapInArrow(run, "rep bigint, grams binary")


def compared(pairs: DataFrame, grams: DataFrame, num: int, den: int, listed: bool = True) -> DataFrame:
    """Sets against others: pivot, rep, linked, added, missing, n, elements.

    ``added`` and ``missing`` count the elements of ``rep`` that ``pivot`` has
    not, and the reverse; ``elements`` are the added ones (null unless ``listed``).
    """
    types = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    names = ["linked", "added", "missing", "n", "elements"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                pivot, own = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.minimum(np.searchsorted(pivot, own), len(pivot) - 1)
                more = own[pivot[at] != own]
                shared = len(own) - len(more)
                linked = den * shared >= num * (len(pivot) + len(more))
                rows.append((linked, len(more), len(pivot) - shared, len(own), more.view(np.int64) if listed else None))
            yield pa.RecordBatch.from_arrays(
                [batch.column("pivot"), batch.column("rep"), *(pa.array(c, t) for c, t in zip(zip(*rows), types))],
                names=["pivot", "rep", *names])

    joined = pairs.join(grams.select("rep", F.col("grams").alias("y")), "rep").join(
        grams.select(F.col("rep").alias("pivot"), F.col("grams").alias("x")), "pivot")
    return joined.select("pivot", "rep", "x", "y").mapInArrow(
        run, "pivot bigint, rep bigint, linked boolean, added bigint, missing bigint, n bigint, elements array<bigint>")


def pair_links(near: DataFrame, grams: DataFrame, num: int, den: int) -> DataFrame:
    """Links (pivot, rep) that connect what those among the pairs ``near`` connect: each class with the least of its component.

    Each set is compared with its least partner first, then with four times as many at once; pairs whose ends are in one
    component by then are not compared, so a group of near copies is not expanded into all its links.
    """
    order, least, links = Window.partitionBy("rep").orderBy("pivot"), 1, None
    rest = store(near.withColumn("place", F.row_number().over(order)), "placed_pairs")
    while True:
        first = store(rest.filter(F.col("place") <= least).select("pivot", "rep"), "first_pairs")
        found = store(compared(first, grams, num, den, False).filter("linked").select("pivot", "rep"), "first_links")
        labels = connected(found if links is None else links.unionByName(found), "pivot", "rep")
        links = labels.filter("label != node").select(F.col("label").alias("pivot"), F.col("node").alias("rep"))
        rest = rest.filter(F.col("place") > least)
        for end in ("pivot", "rep"):
            rest = rest.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label")), end, "left")
        apart = ~F.coalesce(F.col("pivot_label") == F.col("rep_label"), F.lit(False))
        rest = store(rest.filter(apart).select("pivot", "rep", "place"), "other_pairs")
        if rest.isEmpty():
            return links
        least *= 4


def close_profiles(profiles: DataFrame, num: int, den: int) -> DataFrame:
    """Profiles (pivot, added, missing, n, members, foreign) that can link without sharing an added element.

    Two members can only if ``added`` of both and the difference of their
    ``missing`` are together at most the elements they may differ in. There is
    one row a profile, so a pivot's rows are bounded by set sizes. Pairs with
    no member outside the pivot's links need no comparison.
    """
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["added", "missing"], ignore_index=True)
        added, missing, n, foreign = (rows[c].to_numpy() for c in ("added", "missing", "n", "foreign"))
        keep = np.zeros(len(rows), dtype=bool)
        for i in np.flatnonzero(foreign):
            near = added[i] + added + np.abs(missing[i] - missing) <= (n[i] + n) * (den - num) // (den + num)
            near[i] &= rows["members"][i] > 1
            keep |= near
            keep[i] |= near.any()
        return rows.loc[keep, ["pivot", "added", "missing"]]

    return profiles.groupBy("pivot").applyInPandas(run, "pivot bigint, added bigint, missing bigint")


def rare_elements(members: DataFrame, num: int, den: int) -> DataFrame:
    """(bucket, rep, linked, n): members by the rare added elements that they share with others of their pivot.

    A member that links with another must share more than ``added`` less
    ``most_apart`` of its added elements, so one of its ``most_apart + 1``
    rarest is among the other's; elements of one member only are counted but
    make no bucket.
    """
    each = members.select("pivot", "rep", "linked", "n", "added", F.explode("elements").alias("element"))
    common = store(each.groupBy("pivot", "element").agg(F.count("*").alias("rows"), F.min("linked").alias("inside")).filter(
        "rows > 1"), "common")
    ranked = each.join(common, ["pivot", "element"])
    own = Window.partitionBy("pivot", "rep")
    apart = F.floor((F.col("n") + F.floor(F.col("n") * den / num)) * (den - num) / (den + num))
    place = F.col("added") - F.count("*").over(own) + F.row_number().over(own.orderBy("rows", "element"))
    first = ranked.withColumn("place", place).filter(F.col("place") <= apart + 1)
    return first.filter("NOT inside").select(
        F.xxhash64("pivot", "element").alias("bucket"), "rep", "linked", "n")


def class_links(buckets: DataFrame, grams: DataFrame, num: int, den: int) -> DataFrame | None:
    """Links (pivot, rep) that connect all classes in ``buckets`` (bucket, rep) that links connect; None without buckets.

    Buckets that share members are a family. All members of a family are
    compared with its pivot, the member in the most and largest buckets. Two
    members that link must share an element that the pivot has not, unless
    their counts of added and missing elements are close; so members not
    linked with the pivot meet others only in sub-buckets of rare shared
    elements and of close counts. Pairs of a sub-bucket of up to ``PAIRED``
    members are compared; larger ones are the buckets of another round, in
    which the pivots are no more and four times as many members are paired,
    so the rounds are few.
    """
    links, paired = None, PAIRED
    while True:
        buckets = store(buckets, "members")
        sizes = store(buckets.groupBy("bucket").agg(F.count("*").alias("members"), F.min("rep").alias("head")).filter(
            "members > 1"), "sizes")
        if sizes.isEmpty():
            break
        rows = store(buckets.join(sizes, "bucket").select("rep", "head", "members"), "rows")
        # a member names its least head, and that one the other heads: near copies share these, so edges are few
        least = rows.withColumn("least", F.min("head").over(Window.partitionBy("rep")))
        edges = least.select("rep", "least").unionByName(least.select(F.col("head").alias("rep"), "least")).distinct()
        family = connected(edges, "rep", "least")
        score = rows.groupBy("rep").agg(F.sum("members").alias("score"))
        scored = store(family.join(score, F.col("node") == F.col("rep")).select("rep", "label", "score"), "families")
        best = F.max(F.struct("score", (-F.col("rep")).alias("least")))
        pivots = store(scored.groupBy("label").agg(best.alias("best")).select("label", (-F.col("best.least")).alias("pivot")), "pivots")
        pairs = store(scored.join(pivots, "label").filter("rep != pivot").select("pivot", "rep"), "pairs")
        found = store(compared(pairs, grams, num, den), "compared")
        new = found.filter("linked").select("pivot", "rep")
        links = new if links is None else links.unionByName(new)
        open_ = store(found.groupBy("pivot").agg(F.count("*").alias("members"), F.min("linked").alias("all")).filter(
            "members > 1 AND NOT all").select("pivot"), "open")
        members = semi_join_rows(found, open_, "pivot")
        profiles = members.groupBy("pivot", "added", "missing", "n").agg(
            F.count("*").alias("members"), F.max(~F.col("linked")).alias("foreign"))
        close = store(close_profiles(profiles, num, den), "close")
        by_counts = members.join(close, ["pivot", "added", "missing"]).select(
            F.xxhash64("pivot").alias("bucket"), "rep", "linked", "n")
        sub = store(rare_elements(members, num, den).unionByName(by_counts), "sub_buckets")
        sizes = store(sub.groupBy("bucket").agg(F.count("*").alias("members"), F.min("linked").alias("all")).filter(
            "members > 1 AND NOT all").select("bucket", "members"), "sub_sizes")
        sub = store(sub.join(sizes, "bucket"), "sub_members")
        few = sub.filter(F.col("members") <= paired)
        other = few.select("bucket", F.col("rep").alias("pivot"), F.col("linked").alias("other_linked"), F.col("n").alias("m"))
        fits = (den * F.least("n", "m") >= num * F.greatest("n", "m")) & ~(F.col("linked") & F.col("other_linked"))
        pairs = store(few.join(other, "bucket").filter((F.col("pivot") < F.col("rep")) & fits).select("pivot", "rep").distinct(),
                      "sub_pairs")
        found = store(compared(pairs, grams, num, den, False).filter("linked").select("pivot", "rep"), "sub_links")
        links = links.unionByName(found)
        buckets = sub.filter(F.col("members") > paired).select("bucket", "rep")
        paired *= 4
    return links


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, num: int = NUM,
               den: int = DEN, n2: int = N2, k2: int = K2) -> DataFrame:
    """Per row of ``docs`` (a table just read): row_no, id, n_shingles, component_id (smallest id reachable), kept.

    Two rows link when ``den * intersection >= num * union`` of their shingle
    sets. ``kept`` marks the row of the smallest id of each component.
    """
    options = {"num": num, "den": den, "n2": n2, "k2": k2}
    rows = store(shingle_rows(docs, id_col, text_col, words), "sets")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row_no")).alias("first")
    classes = store(rows.filter("n > 0").groupBy("set_key").agg(F.min("row_no").alias("rep"), first), "classes")
    sketches = rows.select(F.col("row_no").alias("rep"), "n", "sketch")

    def linked(near: DataFrame) -> DataFrame:
        near = store(near.distinct(), "near")
        reps = near.select("rep").unionByName(near.select(F.col("pivot").alias("rep"))).distinct()
        return pair_links(near, store(shingle_sets(docs, store(reps, "reps"), text_col, words), "grams"), num, den)

    postings, bucket = signature_rows(docs, classes.select("rep"), text_col, words, options), Window.partitionBy("sig")
    members = F.count("*").over(bucket)
    shared = store(postings.withColumn("members", members).filter("members > 1"), "shared")
    kept = kept_signatures(shared, Signatures(**options).spare())
    chained = kept.withColumns({"members": members, "pivot": F.lag("rep").over(bucket.orderBy("rep"))})
    buckets = store(chained.filter("members > 1"), "buckets")
    pairs = store(buckets.filter("pivot IS NOT NULL").select("pivot", "rep").distinct(), "pairs")
    links = linked(near_pairs(pairs, sketches, num, den))
    labels = store(connected(links, "pivot", "rep").withColumnRenamed("node", "rep"), "names")
    label = F.coalesce("label", "rep").alias("label")
    named = buckets.filter("members > 2").join(labels, "rep", "left").select("rep", "sig", label)
    apart = store(bucket_pairs(named, min(FEW_MEMBERS, SMALL), 2), "apart")
    pair = F.col("rep").alias("pivot"), F.col("other").alias("rep")
    pairs = store(apart.filter("other IS NOT NULL").select(*pair).distinct(), "pairs")
    members = apart.filter("other IS NULL").select("bucket", "rep")
    named = sketches.join(labels, "rep", "left").select("rep", "n", "sketch", label)
    close = store(close_pairs(members, named, SMALL, num, den, CLOSEST), "close_pairs")
    closer = store(close.filter("other IS NOT NULL").select(*pair).distinct(), "closer")
    links = links.unionByName(linked(near_pairs(pairs, sketches, num, den).unionByName(closer)))
    # a member with more close others than were compared is in one of the pairs
    ends = store(closer.select("rep").unionByName(closer.select(F.col("pivot").alias("rep"))).distinct(), "ends")
    again = store(close.filter("rep IS NULL").select("bucket").distinct(), "again")
    rest = semi_join_rows(semi_join_rows(members, again, "bucket"), ends, "rep")
    large = store(rest.unionByName(close.filter("rep IS NOT NULL AND other IS NULL").select("bucket", "rep")), "large")
    grams = store(shingle_sets(docs, store(large.select("rep").distinct(), "large_reps"), text_col, words), "large_grams")
    more = class_links(large, grams, num, den)
    labels = connected(links if more is None else links.unionByName(more), "pivot", "rep")
    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    named = store(named, "named")
    heads = store(named.groupBy("label").agg(F.min("first").alias("head")), "heads")
    home = store(named.join(heads, "label").select("set_key", "head"), "homes")
    joined = rows.select("row_no", "id", "n", "set_key").join(home, "set_key", "left")
    return joined.select("row_no", "id", F.col("n").alias("n_shingles"),
                         F.when(F.col("head").isNull(), F.col("id")).otherwise(F.col("head.id")).alias("component_id"),
                         F.coalesce(F.col("row_no") == F.col("head.row_no"), F.lit(True)).alias("kept"))
