"""Exact deduplication by content-defined chunk recipes.

Each normalised text is cut where a rolling hash of its last 32 bytes hits a
mask, so equal texts are cut alike. A chunk's identifier is its 128-bit
fingerprint, verified: the distinct (fingerprint, content) pairs of all chunks
are formed once, and a fingerprint found with two contents gets one number per
content. A document is then the ordered list of its identifiers, and documents
are compared by these short lists only; contents move through one shuffle.

Defined results: null and empty texts are the empty list (equal to each
other); a null id sorts after every other; of rows equal in all sort keys the
first read stays; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE_SPACE, numbered, slices, store, texts

MIN_CHUNK, MASK_BITS, MAX_CHUNK = 512, 11, 16_384

_GEAR = np.random.default_rng(20240607).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 32 bytes that end at each position, by doubling the window five times."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h = longer
    return h


def cut_points(data: bytes, candidates: list[int], min_chunk: int = MIN_CHUNK,
               max_chunk: int = MAX_CHUNK) -> list[int]:
    """Ends of the chunks of one text: the next candidate at least ``min_chunk`` on, at most ``max_chunk`` on."""
    ends, start, size = [], 0, len(data)
    for c in [*candidates, size]:
        while c - start > max_chunk:
            start += max_chunk
            ends.append(start)
        if c - start >= min_chunk or c == size and c > start:
            ends.append(c)
            start = c
    return ends


def split_texts(values: list[bytes]) -> list[list[bytes]]:
    """The chunks of each text; a chunk boundary depends on the text's own bytes only."""
    joined = np.frombuffer(b"".join(values), dtype=np.uint8)
    hits = np.flatnonzero(rolling_hash(joined) & np.uint32((1 << MASK_BITS) - 1) == 0) + 1 if len(joined) > 16 else \
        np.empty(0, dtype=np.int64)
    at = np.cumsum([0, *map(len, values)])
    first, last = np.searchsorted(hits, at[:-1] + MIN_CHUNK), np.searchsorted(hits, at[1:], side="right")
    out = []
    for value, base, i, j in zip(values, at.tolist(), first.tolist(), last.tolist()):
        ends = cut_points(value, (hits[i:j] - base).tolist())
        out.append([value[a:b] for a, b in zip([0, *ends], ends)])
    return out


def chunk_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  fingerprint_bytes: int = 16) -> DataFrame:
    """One row per document: row_no, id, n_points, text_sha256, keys (fingerprints) and chunks (contents), in order."""
    schema = ("row_no bigint, id bigint, n_points bigint, text_sha256 string, keys array<binary>, "
              "chunks array<binary>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                clean = [t.translate(None, WHITE_SPACE) for t in texts(part)]
                chunks = split_texts(clean)
                keys = [[xxhash.xxh3_128_digest(c)[:fingerprint_bytes] for c in row] for row in chunks]
                yield pa.RecordBatch.from_arrays([
                    part.column("row_no"), part.column("id"),
                    pc.fill_null(pc.utf8_length(part.column("text")), 0).cast(pa.int64()),
                    pa.array([hashlib.sha256(c).hexdigest() for c in clean], pa.string()),
                    pa.array(keys, pa.list_(pa.binary())), pa.array(chunks, pa.list_(pa.binary())),
                ], names=["row_no", "id", "n_points", "text_sha256", "keys", "chunks"])

    rows = numbered(docs).select("row_no", F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema)


def clashing_chunks(recipes: DataFrame) -> DataFrame:
    """Fingerprints that stand for more than one content: (key, chunk, variant), variants by content order.

    The distinct (key, chunk) pairs are formed by partial aggregation, so a
    chunk that a third of all documents hold leaves each task once.
    """
    pairs = recipes.select(F.explode(F.arrays_zip("keys", "chunks")).alias("c")).select(
        F.col("c.keys").alias("key"), F.col("c.chunks").alias("chunk")).distinct()
    counts = pairs.groupBy("key").agg(F.count("*").alias("contents")).filter("contents > 1").select("key")
    clashing = store(counts, "clashing")
    if clashing.isEmpty():
        return pairs.sparkSession.createDataFrame([], "key binary, chunk binary, variant int")
    from pyspark.sql import Window
    order = Window.partitionBy("key").orderBy("chunk")
    return store(pairs.join(clashing, "key", "left_semi").withColumn("variant", F.row_number().over(order)), "variants")


def verified_lists(recipes: DataFrame) -> DataFrame:
    """Recipes with ``ids``: the ordered identifiers, each a fingerprint and, where it clashes, its content's number."""
    variants = clashing_chunks(recipes)
    if variants.isEmpty():
        return recipes.select("row_no", "id", "n_points", "text_sha256", F.col("keys").alias("ids"))
    each = recipes.select("row_no", F.posexplode(F.arrays_zip("keys", "chunks")).alias("pos", "c")).select(
        "row_no", "pos", F.col("c.keys").alias("key"), F.col("c.chunks").alias("chunk"))
    named = each.join(variants, ["key", "chunk"], "left").select("row_no", F.struct("pos", F.concat(
        "key", F.coalesce(F.encode(F.col("variant").cast("string"), "UTF-8"), F.lit(b""))).alias("ident")).alias("p"))
    lists = named.groupBy("row_no").agg(F.sort_array(F.collect_list("p"))["ident"].alias("ids"))
    return recipes.select("row_no", "id", "n_points", "text_sha256").join(lists, "row_no", "left").withColumn(
        "ids", F.coalesce("ids", F.array().cast("array<binary>")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                fingerprint_bytes: int = 16) -> DataFrame:
    """One row per row of ``docs``: row_no, id, keep_id, group_size, kept, text_sha256.

    Of equal texts (identical without ASCII white space) the one with the most
    code points stays, then the smallest id. Groups are formed by partial
    aggregation; the join back to the rows is left to AQE, which splits the
    rows of a hot group.
    """
    recipes = store(chunk_recipes(docs, id_col, text_col, fingerprint_bytes), "recipes")
    rows = verified_lists(recipes)
    first = F.min(F.struct((-F.col("n_points")).alias("fewer"), F.col("id").isNull().alias("no_id"), "id", "row_no"))
    groups = store(rows.groupBy("ids").agg(F.count("*").alias("group_size"), first.alias("best")).filter(
        "group_size > 1").select("ids", "group_size", F.col("best.id").alias("best_id"),
                                 F.col("best.row_no").alias("best_row")), "groups")
    return rows.join(groups, "ids", "left").select(
        "row_no", "id", F.when(F.col("best_row").isNull(), F.col("id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("row_no") == F.col("best_row"), F.lit(True)).alias("kept"), "text_sha256")
