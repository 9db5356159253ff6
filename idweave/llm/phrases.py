"""Phrase collocations by Toivonen's sampling.

A sample of the texts proposes phrases (contiguous words of one piece that are
frequent in the sample at a lowered threshold). A full pass then counts them
and their negative border: the phrases that are not proposed though all their
shorter parts are. A border phrase that turns out frequent is a failure; the
failures join the proposed phrases and the next full pass counts what that
adds to the border, until no failure can add anything but phrases of the most
words; these few are left to the last pass. A phrase is no more frequent than
its parts, so nothing frequent is missed, and the result does not depend on the
sample.

The border holds nearly all pairs of frequent words, most of them rare, so
these passes exchange 64-bit phrase hashes and not texts (``bounds``). Two
phrases with one hash only raise the bound. A last pass (``exact_counts``)
counts the phrases whose bounds reach the threshold, or that have none, by
their words, exactly.
Which phrases a pass looks at is decided by ``Marks``, a bitmap of fixed size
over the hashes: a wrong hit only counts a phrase too many. Only bitmaps are
sent to the tasks and come back to the driver.

All passes cut a slice of texts into words by array operations, number the
words by an Arrow dictionary, and longer phrases by the number of their first
words and their last word (``Slice``). Counts are added up a slice, then a
task, then by a shuffle.

Scores compare decimals of 38 digits. A language's ranks are cut in hashed parts
first, so the last sort of a language sees ``RANK_PARTS`` times ``top`` rows at most.

Defined results: a null text is empty, a null language is ``und`` (with the
rows that say so); a text without words adds nothing; repeated rows and null
ids count like others; other columns are not read; a long text is handled in
runs of pieces, so memory is bounded by the slice and the longest piece; of
equal scores and counts the phrase that is smaller in UTF-8 goes first; no
rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store

#: Least count, most words of a phrase, share that a longer phrase must reach to stand for a shorter one, rows a language.
LEAST, MOST_WORDS, ABSORBED, TOP = 10, 3, 50, 2000
#: Share of the rows that propose phrases, and the least count there.
SAMPLE, LEAST_IN_SAMPLE = 0.1, 2
#: Bits of a bitmap of phrases: 16 MiB, whatever the input.
MARK_BITS = 1 << 27
#: Parts of a language whose best rows are found apart.
RANK_PARTS = 32
#: Text bytes that are cut and counted at a time.
SLICE = 4 << 20

#: Fixed value: what ends a piece, ``[.,;:!?\x0A-\x0D]``, and what parts words inside one, ``[\x20\x09]``.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

_KIND = bytes(2 if c in PIECE_ENDS else 1 if c in BLANKS else 0 for c in range(256))  # 0 in a word, 1 blank, 2 end of a piece
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SIGN = np.uint64(1 << 63)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def scrambled(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


class Marks:
    """A set of phrases as a bitmap over their hashes; it may say yes to a phrase too many, never no to one of its own."""

    def __init__(self, bits: int = MARK_BITS, words: np.ndarray | None = None):
        self.bits, self.words = bits, np.zeros(bits >> 6, dtype=np.uint64) if words is None else words

    def add(self, phrases: DataFrame) -> Marks:
        """These marks and those of the column ``hash``; the driver receives at most the bitmap's 64-bit words."""
        bit = F.expr(f"hash & {self.bits - 1}L")
        words = phrases.select(F.shiftright(bit, 6).alias("at"), F.expr("shiftleft(1L, CAST(hash & 63 AS INT))").alias("bit")).groupBy(
            "at").agg(F.bit_or("bit").alias("bit")).toArrow()
        out = self.words.copy()
        out[words.column("at").to_numpy()] |= words.column("bit").to_numpy().view(np.uint64)
        return Marks(self.bits, out)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(self.bits - 1)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def runs_of_pieces(text: bytes, limit: int) -> Iterator[bytes]:
    """A text cut at ends of pieces into runs of about ``limit`` bytes; a longer piece is a run of its own."""
    start = 0
    while len(text) - start > limit:
        cut = max(text.rfind(bytes([c]), start, start + limit) for c in PIECE_ENDS)
        if cut <= start:
            later = [at for c in PIECE_ENDS if (at := text.find(bytes([c]), start + limit)) >= 0]
            if not later:
                break
            cut = min(later)
        yield text[start:cut]
        start = cut
    yield text[start:]


def numbered_rows(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position of each distinct key, and every key's number."""
    number, distinct = pd.factorize(keys)
    first = np.empty(len(distinct), dtype=np.int64)
    first[number[::-1]] = np.arange(len(keys))[::-1]
    return first, number


class Slice:
    """Phrases of a slice of texts, counted size by size up to ``most`` words.

    ``now``: a longer phrase is looked at only where its first and its last words
    (all but one of them) are marked; without it all phrases are. ``langs``
    holds each text's place in ``names``.
    """

    def __init__(self, texts: list[bytes], langs: np.ndarray, names: list[str], now: Marks | None):
        self.now, self.size = now, 1
        joined = b"\n".join([*texts, b""])
        raw, kind = (np.frombuffer(joined.translate(t), dtype=np.uint8) for t in (_LOWER, _KIND))
        inside = np.concatenate(([False], kind == 0))
        step = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = step[::2], step[1::2]
        offsets = np.concatenate(([0], np.cumsum(end - start))).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(start),
                                      [None, pa.py_buffer(offsets), pa.py_buffer(raw[kind == 0])]).dictionary_encode()
        breaks = np.flatnonzero(kind == 2)
        piece = np.searchsorted(breaks, start)
        lang = langs[np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")]
        seeds = np.array([xxhash.xxh64_intdigest(name) for name in names], dtype=np.uint64)
        plain = np.fromiter(map(xxhash.xxh64_intdigest, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
        index = words.indices.to_numpy().astype(np.int64)
        # a language's words are numbered; the arrays by number: language, hash, where the phrase was first seen
        self.dictionary, self.index = words.dictionary, index
        self.first, self.word = numbered_rows(index + lang * len(plain))
        self.lang, self.hash = lang[self.first], scrambled(plain[index[self.first]] ^ seeds[lang[self.first]])
        self.word_hash = self.hash
        self.piece, self.number, self.at = piece, self.word, np.arange(len(start))
        self.total = np.bincount(lang, minlength=len(names))

    def counts(self) -> np.ndarray:
        return np.bincount(self.number, minlength=len(self.hash))

    def marked(self, marks: Marks | None) -> np.ndarray:
        return np.ones(len(self.hash), bool) if marks is None else marks.has(self.hash)

    def phrases(self, which: np.ndarray) -> pa.Array:
        """Texts of the phrases with these numbers."""
        at = self.first[which]
        words = [self.dictionary.take(pa.array(self.index[at + k])) for k in range(self.size)]
        return (words[0] if self.size == 1 else pc.binary_join_element_wise(*words, b" ")).cast(pa.string())

    def longer(self) -> np.ndarray | None:
        """Go on to phrases of one word more: for each its (head, tail), the numbers of its parts; None if there are none."""
        fits, size = self.marked(self.now), self.size
        here = np.full(len(self.word) + 1, -1, dtype=np.int64)
        at = self.at[fits[self.number]]
        here[at] = self.number[fits[self.number]]
        at = at[at + size < len(self.word)]
        at = at[(here[at + 1] >= 0) & (self.piece[at] == self.piece[np.minimum(at + size, len(self.piece) - 1)])]
        if not len(at):
            return None
        first, number = numbered_rows(here[at] * len(self.word_hash) + self.word[at + size])
        first_at = at[first]
        head, tail = here[first_at], here[first_at + 1]
        self.hash = scrambled(self.hash[head] * _ODD + self.word_hash[self.word[first_at + size]])
        self.lang, self.first, self.number, self.at, self.size = self.lang[head], first_at, number, at, size + 1
        return np.stack([head, tail])


def sliced(batches: Iterator[pa.RecordBatch], now: Marks | None) -> Iterator[tuple[Slice, list[str]]]:
    """The texts of ``batches`` (text, lang) in slices of about ``SLICE`` bytes, and the names of their languages."""
    def made(held, langs):
        names = sorted(set(langs))
        place = {name: k for k, name in enumerate(names)}
        return Slice(held, np.array([place[x] for x in langs], dtype=np.int64), names, now), names
    held, langs, total = [], [], 0
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
            for part in runs_of_pieces(text.as_buffer().to_pybytes() if text.is_valid else b"", SLICE):
                if total and total + len(part) > SLICE:
                    yield made(held, langs)
                    held, langs, total = [], [], 0
                held.append(part)
                langs.append(lang)
                total += len(part) + 1
    if held:
        yield made(held, langs)


def bounds(docs: DataFrame, most: int, now: Marks | None = None, before: Marks | None = None) -> DataFrame:
    """(hash, longest, f): how often phrases of up to ``most`` words with this hash occur in ``docs`` (text, lang).

    ``longest``: they have ``most`` words. It is the hash's sign, so one number is the whole key; marks use the low bits.

    With ``now`` only phrases whose shorter parts are all marked in it are
    counted (every single word is), and of these only those that ``before``,
    the marks of the pass before, did not have counted already. Different
    phrases may share a hash, so f bounds the count of each from above.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _ in sliced(batches, now):
            counted = np.full(len(part.hash), before is not None)  # by the pass before
            while True:
                new = ~counted
                key = part.hash[new] & ~_SIGN | (_SIGN if part.size == most else np.uint64(0))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(part.counts()[new])], ["hash", "f"])
                if before is not None:
                    counted &= part.marked(before)
                if part.size == most or (parts := part.longer()) is None:
                    break
                counted = counted[parts[0]] & counted[parts[1]]
    counts = docs.mapInArrow(run, "hash bigint, f bigint").groupBy("hash").agg(F.sum("f").alias("f"))
    return counts.select("hash", (F.col("hash") < 0).alias("longest"), "f")


def exact_counts(docs: DataFrame, most: int, marks: Marks | None, before: Marks | None = None) -> DataFrame:
    """(lang, phrase, words, f) of the phrases that are marked with all their parts; n of a language as f where words = 0.

    With ``before``, the marks of the last pass of ``bounds``, also of those that have marked parts but that no pass has counted.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(names, lang, phrases, size, f):
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()).take(pa.array(lang)), phrases,
                                               pa.array(np.full(len(f), size, dtype=np.int32)), pa.array(f)], ["lang", "phrase", "words", "f"])
        for part, names in sliced(batches, marks):
            yield rows(names, np.arange(len(names)), pa.nulls(len(names), pa.string()), 0, part.total)
            counted = np.ones(len(part.hash), bool)
            while True:
                which = np.flatnonzero(part.marked(marks) | ~counted)
                yield rows(names, part.lang[which], part.phrases(which), part.size, part.counts()[which])
                counted &= part.marked(before)
                if part.size == most or (parts := part.longer()) is None:
                    break
                counted = counted[parts[0]] & counted[parts[1]]
    return docs.mapInArrow(run, "lang string, phrase string, words int, f bigint").groupBy("lang", "phrase", "words").agg(
        F.sum("f").alias("f"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, most: int = MOST_WORDS, sample: float = SAMPLE, seed: int = 12,
                     least_in_sample: int = LEAST_IN_SAMPLE, bits: int = MARK_BITS) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``most`` words found ``least`` times or more, (lang, phrase, words, f), and (lang, n).

    n counts all words of a language. ``docs`` holds text and lang; it is read
    once for the sample, once for every pass (at most ``most - 1`` of them, and
    one at least) and once for the exact counts. What a pass adds to the border
    has a part that failed in the pass before, and so a word more than that
    pass's shortest: after ``most - 1`` passes all that is left has ``most`` words.
    """
    rows = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    proposed, before = Marks(bits).add(bounds(rows.sample(sample, seed), most).filter(F.col("f") >= least_in_sample)), None
    frequent = Marks(bits)
    for _ in range(max(1, most - 1)):
        often = store(bounds(rows, most, proposed, before).filter(F.col("f") >= least), "frequent_hashes")
        frequent, before, proposed = frequent.add(often), proposed, proposed.add(often.filter("NOT longest"))
        if np.array_equal(proposed.words, before.words):  # no border phrase failed
            break
    counts = store(exact_counts(rows, most, frequent, before).filter((F.col("f") >= least) | (F.col("words") == 0)), "frequent_phrases")
    return counts.filter("words > 0"), counts.filter("words = 0 AND f > 0").select("lang", F.col("f").alias("n"))


def cut_scores(frequent: DataFrame, candidates: DataFrame, most: int) -> DataFrame:
    """Candidates (lang, phrase, words, a) with l, r and score of their lowest-scoring cut."""
    parts = F.split("phrase", " ")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "words", "a", "cut", F.array_join(F.slice(parts, F.lit(1), F.col("cut")), " ").alias("head"),
        F.array_join(F.slice(parts, F.col("cut") + 1, F.col("words") - F.col("cut")), " ").alias("tail"))
    counts = frequent.filter(F.col("words") < most).select("lang", "phrase", "f")
    wide = lambda c: F.col(c).cast("decimal(15,0)")  # noqa: E731  squares times a million stay within 38 digits
    scored = (cuts.join(counts.selectExpr("lang", "phrase AS head", "f AS l"), ["lang", "head"])
              .join(counts.selectExpr("lang", "phrase AS tail", "f AS r"), ["lang", "tail"])
              .withColumn("up", F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a"))).withColumn("down", wide("l") * wide("r"))
              .withColumn("score", F.expr("up div down")))
    return scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low")).select(
        "lang", "phrase", "words", "a", "low.l", "low.r", "low.score")


def absorbed(candidates: DataFrame, share: int) -> DataFrame:
    """Candidates (lang, phrase) inside a longer one that has at least ``share`` per cent of their count."""
    parts = F.split("phrase", " ")
    spans = candidates.filter("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1))).withColumn(
        "at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    longer = spans.select("lang", F.array_join(F.slice(parts, F.col("at"), F.col("size")), " ").alias("phrase"),
                          F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return candidates.join(longer, ["lang", "phrase"]).filter(
        F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * share).select("lang", "phrase")


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST_WORDS, share: int = ABSORBED, top: int = TOP,
                 sample: float = SAMPLE, seed: int = 12, bits: int = MARK_BITS) -> DataFrame:
    """Each language's best collocations: lang, rank, phrase, a, l, r, n, score."""
    frequent, totals = frequent_phrases(docs, least, most, sample, seed, bits=bits)
    candidates = frequent.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    kept = cut_scores(frequent, candidates, most).join(absorbed(candidates, share), ["lang", "phrase"], "left_anti")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("part", F.pmod(F.hash("phrase"), F.lit(RANK_PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).filter(F.col("rank") <= top)
    return kept.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
