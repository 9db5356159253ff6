"""Packed token-id matrices: best-fit-decreasing packing, written as binary rows.

Documents are tokenized once; those above the capacity are cut into pieces
without loss. Within a packing group pieces are placed longest first into the
bin with the least room that holds them, found by a segment tree over
capacities. A written row is one sequence: its ids (little-endian, padded to
the capacity), cumulative segment lengths, the places where positions start
again, and which piece of which document each segment is.

Defined results: a null or empty text is the end id alone; a null id stays
null; repeated rows are separate documents; no rows give an empty table.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .packing import CAPACITY, END_ID, token_pieces

#: Pieces of a packing group: 8 MB of 16-bit ids at most.
GROUP_PIECES, PAD_ID = 1024, 0


class Room:
    """Segment tree over capacities: how many bins have each amount of room."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, change: int) -> None:
        """Count one bin more or less with this room."""
        i = room + self.size
        while i:
            self.count[i] += change
            i >>= 1

    def best(self, need: int) -> int | None:
        """The least room of at least ``need`` that a bin has."""
        i = need + self.size
        while not self.count[i]:
            while i & 1:  # the last child has no right sibling: go up
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of piece indices: longest first, each into the fullest bin that holds it."""
    room, bins, by_room = Room(capacity), [], defaultdict(list)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        left = room.best(lengths[i])
        if left is None:
            bins.append([])
            k, left = len(bins) - 1, capacity
        else:
            k = by_room[left].pop()
            room.add(left, -1)
        bins[k].append(i)
        by_room[left - lengths[i]].append(k)
        room.add(left - lengths[i], 1)
    return bins


def position_ids(cu_seqlens: list[int]) -> np.ndarray:
    """Positions of a row's tokens, starting again at each segment."""
    at = np.asarray(cu_seqlens)
    return np.arange(at[-1]) - np.repeat(at[:-1], np.diff(at))


def packed_matrix(docs: DataFrame, tokenizer: str, vocabulary_size: int, id_col: str = "doc_id", text_col: str = "text",
                  capacity: int = CAPACITY, end_id: int = END_ID, pad_id: int = PAD_ID,
                  group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The written matrix, read back: sequence_id, n_tokens, ids, id_bytes, cu_seqlens, resets, doc_ids, pieces, starts.

    ``ids`` holds 2 bytes an id where the vocabulary fits, else 4. Groups of
    about ``group_pieces`` pieces are packed on their own; their number grows
    with the input.
    """
    kind = np.dtype("<u2" if vocabulary_size <= 1 << 16 else "<u4")
    pieces = store(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, kind.str).drop("ids_crc32"), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row_no", "piece"], ascending=[False, True, True], ignore_index=True)
        lengths, ids, piece, start = (rows[c].tolist() for c in ("length", "ids", "piece", "start"))
        doc = [None if pd.isna(d) else int(d) for d in rows["id"]]
        pad, out = np.array(pad_id, kind).tobytes(), []
        for k, bin_ in enumerate(best_fit_decreasing(lengths, capacity)):
            cu = [0]
            for i in bin_:
                cu.append(cu[-1] + lengths[i])
            row = b"".join([ids[i] for i in bin_]) + pad * (capacity - cu[-1])
            out.append(((int(key[0]) << 32) + k, cu[-1], row, kind.itemsize, cu, cu[:-1], [doc[i] for i in bin_],
                        [piece[i] for i in bin_], [start[i] for i in bin_]))
        return pd.DataFrame(out, columns=["sequence_id", "n_tokens", "ids", "id_bytes", "cu_seqlens", "resets", "doc_ids",
                                          "pieces", "starts"])

    schema = ("sequence_id bigint, n_tokens bigint, ids binary, id_bytes int, cu_seqlens array<int>, resets array<int>, "
              "doc_ids array<bigint>, pieces array<int>, starts array<bigint>")
    dealt = pieces.withColumn("id", F.col("id").cast("string")).withColumn("pack_group", F.pmod(F.xxhash64("row_no", "piece"), F.lit(groups)))
    return store(dealt.repartition(groups, "pack_group").groupBy("pack_group").applyInPandas(run, schema), "matrix")


def matrix_report(matrix: DataFrame) -> DataFrame:
    """Per written row: its segments, and the checksum of the ids without padding as read from the matrix."""
    ids = F.expr("substring(ids, 1, CAST(n_tokens * id_bytes AS INT))")
    return matrix.select("sequence_id", "n_tokens", "doc_ids", "pieces", "starts", "cu_seqlens", "resets",
                         F.crc32(ids).alias("ids_crc32"))
