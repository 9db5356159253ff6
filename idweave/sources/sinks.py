"""Sinks: partition overwrite (K1-K3), keyed upsert (U1/K5), deletes (K6/K7).

All writers produce a new, complete output in one job. A keyed upsert never
overwrites the path it reads from: it writes a new snapshot path, which the
caller then publishes (atomic at the directory level).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_partitions(df: DataFrame, path: str, partition_cols=("time", "platform"),
                     mode: str = "overwrite") -> None:
    """K1/K2/K3: dynamic partition overwrite.

    Only the (time, platform) partitions present in ``df`` are replaced; other
    partitions of the table survive (``partitionOverwriteMode=dynamic``).
    Rows are clustered by the partition columns (few files per partition),
    through a ``rebalance`` hint rather than a plain repartition: AQE splits a
    partition value that holds a large share of the rows over several tasks
    and merges small ones, so one hot platform-day is not written by one task.
    """
    cols = list(partition_cols)
    (df.hint("rebalance", *cols)
       .write.mode(mode)
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*cols)
       .parquet(path))


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None,
                   mode: str = "overwrite") -> None:
    """Store ``df`` as a table bucketed and sorted by ``keys``.

    Tables that are joined again and again on the same key (messages and
    edges with the link table on the id, profiles on the row key) can be
    stored with the same ``buckets``; Spark then joins them bucket by
    bucket, with no shuffle of either side.
    """
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``incoming`` replace rows of ``existing`` with the same key.

    ``left_anti`` on the key + ``unionByName``: a shuffle on the key only, no
    per-row lookups. Incoming keys are assumed unique (as a primary key).
    """
    kept = existing.join(incoming.select(*keys).distinct(), on=keys, how="left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def upsert_paths(spark, incoming: DataFrame, keys: list[str], targets: list[tuple[str, str]]) -> None:
    """K5: apply one keyed upsert to several stored tables.

    ``targets`` lists (current snapshot path, new snapshot path); each new
    snapshot is written whole, so no path is overwritten while it is read.
    """
    for current, new in targets:
        upsert(spark.read.parquet(current), incoming, keys).write.mode("overwrite").parquet(new)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """K7: drop rows matching ``predicate`` (NULL counts as no match)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def delete_keys(df: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """K6 delete half: drop rows whose key is listed in ``keys_df``."""
    return df.join(keys_df.select(*keys).distinct(), on=keys, how="left_anti")
