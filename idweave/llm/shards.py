"""Sharding by a two-pass external shuffle.

First pass: every record goes to a bucket by a seeded hash of its place in the
input (file name and row in the file, so the file splits and the number of
cores change nothing). The number of buckets follows from the counted bytes, so
that a bucket fits in memory. Second pass: the task that holds a bucket puts
its records in the order of their places, runs a seeded Fisher-Yates shuffle
and writes them.

Buckets one after the other are a random order of all records, and a record's
position in it is its bucket's offset plus its place in the bucket. Shard s
holds the s-th of equal ranges of positions, so row counts differ by one at
most (the law ``rows``). Offsets come from a two-level running sum of the
buckets' counts, and reach the tasks as one header row a bucket in the same
exchange as the records: nothing is broadcast and texts are exchanged once.

Defined results: nulls in any column, empty texts, repeated rows and repeated
or null ids are records like others, since a record is known by its place;
copies of a text are scattered like different texts, so a hot group fills no
bucket. A bucket holds at least one whole record, however long its text. Extra
columns are written as they are; where a column has the name of one that is
added, the added one gets underscores in front. Fewer records than shards
leave shards empty; no rows write no shard. A retry or another run over the
same files gives the same shards. Docs that are no scan of files are stored
first.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idweave.operators.prefix import running_sum

from .common import free_name, scratch, store

SHARDS, SEED = 16, 13
#: Bytes of a bucket's rows at most, on average.
BUCKET_BYTES = 48 << 20
#: Bytes that a row takes besides its texts, for the number of buckets.
ROW_BYTES = 64
#: Rows that a task hands on at a time.
STEP = 4096


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column of each row's file and row number there; computed docs are stored first."""
    place = free_name(docs, "shard_place")
    if not docs.inputFiles():
        docs = store(docs, "unsharded")
    if not docs.inputFiles():  # no rows, no files
        return docs.withColumn(place, F.struct(F.lit("").alias("file"), F.lit(0).cast("bigint").alias("row")))
    meta = docs.metadataColumn("_metadata")
    return docs.withColumn(place, F.struct(meta["file_name"].alias("file"), meta["row_index"].alias("row")))


def text_bytes(docs: DataFrame) -> F.Column:
    """Bytes of a row's text and binary columns, and a little more."""
    total = F.lit(ROW_BYTES).cast("bigint")
    for field in docs.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
    return total


def bucket_of(place: str, buckets: int, seed: int) -> F.Column:
    """A record's bucket: a seeded hash of its place."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(place)), F.lit(buckets)).cast("int")


def shuffled(rows: pa.Table, place: str, bucket: int, seed: int) -> pa.Table:
    """The rows in the order of their places, then Fisher-Yates shuffled by the seed and the bucket."""
    at = rows.column(place).combine_chunks()
    order = pa.table({"file": at.field("file"), "row": at.field("row")})
    order = pa.compute.sort_indices(order, sort_keys=[("file", "ascending"), ("row", "ascending")])
    return rows.take(order.take(pa.array(np.random.default_rng([seed, bucket]).permutation(rows.num_rows))))


def shard_starts(n: int, shards: int) -> np.ndarray:
    """First position of each shard, and n at the end."""
    return np.array([-(-s * n // shards) for s in range(shards + 1)], dtype=np.int64)


def shuffled_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, str, str]:
    """``docs`` in shuffled shards, lazily: rows with their shard (0 to ``shards`` - 1) and slot, and the two columns' names.

    Rows come out in the order of their slots; ``write_shards`` writes them.
    """
    shard, slot = free_name(docs, "shard"), free_name(docs, "slot")
    columns = docs.columns
    rows = placed(docs)
    place = rows.columns[-1]
    total = rows.agg(F.count("*").alias("n"), F.sum(text_bytes(docs)).alias("size")).first()
    n = total["n"]
    out = T.StructType([*docs.schema.fields, T.StructField(shard, T.IntegerType()), T.StructField(slot, T.LongType())])
    if not n:
        return docs.sparkSession.createDataFrame([], out), shard, slot
    buckets = max(shards, ceil(total["size"] / bucket_bytes))
    bucket, first = free_name(rows, "shard_bucket"), free_name(rows, "shard_first")
    rows = rows.withColumn(bucket, bucket_of(place, buckets, seed))
    heads = running_sum(rows.groupBy(bucket).agg(F.count("*").alias("rows")), bucket, "rows", first).select(bucket, first)
    both = rows.withColumn(first, F.lit(None).cast("bigint")).unionByName(heads, allowMissingColumns=True)
    starts = shard_starts(n, shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        for k in np.unique(table.column(bucket).to_numpy()):  # one, where the exchange deals by the bucket's number
            own = table.filter(pa.compute.equal(table.column(bucket), int(k)))
            head = pa.compute.is_valid(own.column(first))
            offset = own.filter(head).column(first)[0].as_py()
            own = shuffled(own.filter(pa.compute.invert(head)), place, int(k), seed)
            for begin in range(0, own.num_rows, STEP):
                part = own.slice(begin, STEP)
                at = np.arange(offset + begin, offset + begin + part.num_rows)
                to = np.searchsorted(starts, at, side="right") - 1
                part = part.select(columns).append_column(shard, pa.array(to.astype(np.int32))).append_column(slot, pa.array(at - starts[to]))
                yield from part.combine_chunks().to_batches()
    return both.repartitionById(buckets, bucket).mapInArrow(run, out), shard, slot


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> tuple[str, str]:
    """Write ``docs`` as Parquet, one folder a shard; a bucket is a file, its rows by slot. The names of shard and slot."""
    rows, shard, slot = shuffled_shards(docs, shards, seed, bucket_bytes)
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(shard).parquet(path)
    return shard, slot


def shard_report(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Shards of ``docs`` written to the shared folder and read back: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark: SparkSession = docs.sparkSession
    path = scratch(spark, "shards")
    shard, slot = write_shards(docs, path, shards, seed, bucket_bytes)
    schema = T.StructType([*docs.schema.fields, T.StructField(slot, T.LongType()), T.StructField(shard, T.IntegerType())])
    text = F.coalesce("text", F.lit(""))
    return spark.read.schema(schema).parquet(path).select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), F.col(shard).alias("shard"), F.col(slot).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
