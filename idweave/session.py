"""Spark session setup shared by jobs, tests and the bench.

Settings that matter at scale:

* AQE on, with skew-join splitting and partition coalescing, so a hot key
  (one canonical id holding a third of all rows) is split at runtime.
* Dynamic partition overwrite, so a day/platform rewrite leaves the other
  partitions of a table in place.
* Session time zone UTC: every epoch conversion in the cleaners is UTC.
* ANSI mode stays on (the 4.x default); operators use ``try_*`` functions
  where bad input must become NULL instead of failing the job.

On a cluster the session is created by the platform; ``configure`` only
fills in settings that are not already set there.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}

#: For the identity jobs, which join long tables with link tables: a link table that adaptive execution has measured to
#: be this small (about a million links) is broadcast, and the long table is not exchanged.
LINK_JOINS = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "96m"}


def configure(spark: SparkSession, more: dict[str, str] | None = None) -> SparkSession:
    """Apply DEFAULTS (and ``more``) where the session has no value of its own."""
    for key, value in {**DEFAULTS, **(more or {})}.items():
        try:
            current = spark.conf.get(key, None)
        except Exception:  # pragma: no cover - conf not readable
            current = None
        if current is None or key == "spark.sql.session.timeZone":
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "idweave") -> SparkSession:
    """Session for tests and the bench: local mode, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("IDWEAVE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # delete checkpoint files once their data is no longer referenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Unset, a local master (tests, the bench) gets a scratch folder of its own;
    any other master raises, since executors could not share such a folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="idweave-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
