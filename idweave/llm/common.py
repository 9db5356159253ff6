"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from idweave.sources.scratch import scratch, store  # noqa: F401  (for the operators)

#: Fixed value: the white space of every word and line rule, ``[\x20\x09-\x0D]``.
WHITE_SPACE = b" \t\n\x0b\x0c\r"
#: One word, as a regular expression for SQL.
WORD = r"[^\x20\x09-\x0D]+"

#: Text bytes that one vectorised step inside a task handles at a time.
SLICE_BYTES = 1 << 21
#: A side is broadcast only when its rows are counted and fit this many.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pin_splits(spark: SparkSession) -> None:
    """Let all later scans of the session cut a table alike.

    Without ``minPartitionNum`` each scan is cut by the number of cores alive
    when it is planned, which changes as executors come and go.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.files.minPartitionNum", str(cores))


def numbered(docs: DataFrame, name: str = "row_no") -> DataFrame:
    """Add a row number that is equal in every scan of the same table, as the session's splits are pinned.

    ``docs`` is a table just read; anything computed is stored first.
    """
    pin_splits(docs.sparkSession)
    return docs.withColumn(name, F.monotonically_increasing_id())


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores in front until no column of ``df`` has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of ``docs`` (a table just read) that ``decided`` (row_no, kept) keeps, with all their columns."""
    name = free_name(docs, "llm_row_no")
    dropped = store(decided.filter("NOT kept").select(F.col("row_no").alias(name)), "dropped")
    return anti_join_rows(numbered(docs, name), dropped, name).select(*docs.columns)


def anti_join_rows(left: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose ``key`` is not in ``dropped``.

    ``dropped`` is broadcast only after its rows are counted and fit
    ``BROADCAST_ROWS`` 8-byte keys; beyond that the join shuffles.
    """
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    return left.join(dropped, key, "left_anti")


def semi_join_rows(left: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose ``key`` is in ``wanted``; broadcast behind the same check as ``anti_join_rows``."""
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    return left.join(wanted, key, "left_semi")


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes; a longer row is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's values as UTF-8 bytes; null is empty."""
    values = batch.column(column)
    binary = values.cast(pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary())
    return [b"" if v is None else v for v in binary.to_pylist()]


def map_slices(fn: Callable[[pa.RecordBatch], pa.RecordBatch], column: str = "text"):
    """``mapInArrow`` function that applies ``fn`` to text slices of every batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                yield fn(part)
    return run


class Bounded(dict):
    """A cache of ``make(key)`` that is emptied when it holds ``limit`` entries."""

    def __init__(self, make: Callable, limit: int = 300_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        self[key] = value = self.make(key)
        return value


def any_id(name: str = "doc_id") -> Column:
    """An id column as a bigint (null stays null)."""
    return F.col(name).cast("bigint").alias(name)
