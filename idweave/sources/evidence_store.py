"""Stored evidence profiles that a load job adds to without moving them.

The store is a Parquet table bucketed on (rowkey, attr, value). A load job
brings its evidence into the same buckets (the only exchange), drops what is
stored already by a join bucket by bucket, and appends the rest: buckets that
get nothing new get no file, and no stored file is read into an exchange or
written again. Scores are counts inside a bucket. As the value is part of the
bucket key, a profile that gathers a third of all evidence is spread over the
buckets.

Evidence is a set, so adding is safe to repeat: after a job that failed or was
run twice, the next run finds what is there and adds the rest. ``compact``
writes the buckets anew, one file each, into another path.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["rowkey", "attr", "value"]
#: Join buckets on part of the join keys, so that the evidence text need not be a bucket key.
SUBSET_JOIN = "spark.sql.requireAllClusterKeysForCoPartition"


class EvidenceStore:
    """The table at ``path``: (rowkey, attr, value, ev, batch), where ``batch`` is the load that first brought a row.

    The same path is always opened with the same number of buckets; about
    1 GB of evidence a bucket is a good size.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "idweave_evidence_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (rowkey STRING, attr STRING, value STRING, ev STRING, batch STRING) "
                  f"USING parquet CLUSTERED BY ({', '.join(KEYS)}) INTO {buckets} BUCKETS LOCATION '{path}'")

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def unseen(self, evidence: DataFrame) -> DataFrame:
        """Distinct rows (rowkey, attr, value, ev) of ``evidence`` that are not stored; rows without a key are left out.

        The plan exchanges ``evidence`` only, once: it is made distinct in its buckets. Both sides are merged by bucket,
        in an outer join, as an anti join would be moved below that exchange and the stored rows into one of their own.
        """
        self.spark.conf.set(SUBSET_JOIN, "false")
        cols = [*KEYS, "ev"]
        batch = evidence.select(*cols).dropna(subset=KEYS).repartition(self.buckets, *KEYS).distinct()
        stored = self.table().select(*cols, F.lit(True).alias("stored"))
        return batch.hint("merge").join(stored.hint("merge"), cols, "left").filter("stored IS NULL").select(*cols)

    def add(self, evidence: DataFrame, batch: str) -> None:
        """Append the rows of ``evidence`` that are not stored yet."""
        (self.unseen(evidence).withColumn("batch", F.lit(batch)).write.mode("append").format("parquet")
         .bucketBy(self.buckets, *KEYS).option("path", self.path).saveAsTable(self.name))

    def scored(self) -> DataFrame:
        """All rows with their score: the number of evidence entries of the value, counted inside the bucket."""
        t = self.table()
        counts = t.groupBy(*KEYS).agg(F.count(F.lit(1)).cast("int").alias("score"))
        return t.hint("merge").join(counts.hint("merge"), KEYS)

    def compact(self, path: str) -> EvidenceStore:
        """The same rows in a new store at ``path``, one file a bucket."""
        out = EvidenceStore(self.spark, path, self.buckets)
        bucket = F.expr(f"pmod(hash({', '.join(KEYS)}), {self.buckets})")  # as the table's own
        self.table().repartitionById(self.buckets, bucket).write.mode("append").format("parquet").bucketBy(
            self.buckets, *KEYS).option("path", path).saveAsTable(out.name)
        return out
