"""Best-two-fit packing of token sequences.

A bin is filled greedily with the longest piece that fits. Then its smallest
piece is replaced by the two unpacked pieces whose sum fills the bin most
tightly, if they fill it better. Only lengths matter, so available lengths are
one bit each in an integer and a best fit is one mask and one bit length.

Pieces are dealt to packing groups of about ``GROUP_PIECES`` by a hash of
their row; the number of groups grows with the input, a group's size does not,
and each group wastes at most its last bins.

Defined results: a null or empty text is the end id alone; a null id stays
null; repeated rows are packed as separate documents; no rows give no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, slices, store, texts
from .tokens import word_ids

CAPACITY, END_ID, GROUP_PIECES = 4096, 1, 8192
#: Text bytes whose distinct words and pieces are found at once.
ENCODED_BYTES = 1 << 23


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID, id_type: str = "") -> DataFrame:
    """Pieces of at most ``capacity`` tokens: row_no, id, piece, start, length, ids_crc32.

    With ``id_type`` (``<u2`` or ``<u4``) also ids, in that type, which the checksum then covers.
    """
    size = 2 if id_type == "<u2" else 4
    end = end_id.to_bytes(size, "little")
    names = ["row_no", "id", "piece", "start", "length", "ids_crc32"] + ["ids"] * bool(id_type)
    schema = "row_no bigint, id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + \
        ", ids binary" * bool(id_type)
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, step = word_ids(tokenizer, "H" if size == 2 else "I"), size * capacity
        for batch in batches:
            for part in slices(batch, limit=ENCODED_BYTES):
                rows = []
                for row, doc, ids in zip(part.column("row_no").to_pylist(), part.column("id").to_pylist(),
                                         encoder.encode(texts(part))):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), step)):
                        piece = ids[at:at + step]
                        rows.append((row, doc, k, at // size, len(piece) // size, zlib.crc32(piece), piece)[:len(names)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return numbered(docs).select("row_no", F.col(id_col).cast("bigint").alias("id"),
                                 F.col(text_col).alias("text")).mapInArrow(run, schema)


class Lengths:
    """A multiset of piece lengths that answers 'the longest of at most n' by a bit mask."""

    def __init__(self, lengths: list[int]):
        self.held: dict[int, list[int]] = defaultdict(list)
        for i in range(len(lengths) - 1, -1, -1):
            self.held[lengths[i]].append(i)
        self.mask = sum(1 << n for n in self.held)

    def longest(self, most: int) -> int:
        """The longest length held of at most ``most``; 0 if none."""
        return (self.mask & ((1 << most + 1) - 1)).bit_length() - 1 if most > 0 and self.mask & ((1 << most + 1) - 1) else 0

    def take(self, n: int) -> int:
        """The index of a piece of length ``n``, which is held no more."""
        i = self.held[n].pop()
        if not self.held[n]:
            self.mask ^= 1 << n
        return i

    def give(self, n: int, i: int) -> None:
        """Hold a piece again."""
        self.held[n].append(i)
        self.mask |= 1 << n

    def best_two(self, least: int, most: int) -> tuple[int, int] | None:
        """Lengths (a, b), a >= b, of two pieces with the largest sum in (least, most]; None if there is none."""
        best, pair = least, None
        a = self.longest(most - 1)
        while a and 2 * a > best:
            if a < most:
                b = self.longest(min(a, most - a))
                if b == a and len(self.held[a]) < 2:
                    b = self.longest(a - 1)
                if b and a + b > best:
                    best, pair = a + b, (a, b)
                    if best == most:
                        break
            a = self.longest(a - 1)
        return pair


def best_two_fit(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of piece indices; every piece is in one bin and no bin is above ``capacity``."""
    left, bins = Lengths(lengths), []
    while left.mask:
        bin_, gap = [], capacity
        while n := left.longest(gap):
            bin_.append(left.take(n))
            gap -= n
        while gap and len(bin_) > 1:
            small = lengths[bin_[-1]]
            pair = left.best_two(small, gap + small)
            if not pair:
                break
            left.give(small, bin_.pop())
            bin_ += [left.take(n) for n in pair]
            gap += small - sum(pair)
            bin_.sort(key=lambda i: -lengths[i])
        bins.append(bin_)
    return bins


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with sequence_id and offset; pieces are packed group by group."""
    stored = store(pieces, "pieces")
    groups = max(1, -(-stored.count() // group_pieces))
    columns = [f.name for f in stored.schema if f.name != "ids"]
    dealt = stored.select(*columns).withColumn("id", F.col("id").cast("string")).withColumn("pack_group", F.pmod(F.xxhash64("row_no", "piece"), F.lit(groups)))
    # ids travel as text: pandas would hold whole numbers beside nulls as inexact floats
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.drop("pack_group").schema) + \
        ", sequence_id bigint, offset bigint"

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="pack_group").sort_values(["length", "row_no", "piece"], ascending=[False, True, True],
                                                           ignore_index=True)
        lengths = rows["length"].tolist()
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        for k, bin_ in enumerate(best_two_fit(lengths, capacity)):
            at = 0
            for i in bin_:
                sequence[i], offset[i] = (int(key[0]) << 32) + k, at
                at += lengths[i]
        return rows.assign(sequence_id=sequence, offset=offset)

    packed = dealt.repartition(groups, "pack_group").groupBy("pack_group").applyInPandas(run, schema)
    return packed.withColumn("id", F.col("id").cast("bigint"))


def packed_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their place: id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id), capacity).drop("row_no")
