"""Tables whose partitions are replaced by a staged commit (K1, K2 with D9, K5).

A run writes its rows into a folder of its own that no reader looks into
(``stage``); one small log file then makes all its partitions current at once
(``commit``). A run that fails before its commit leaves the old state, and one
that is repeated leaves the new state; other partitions stay as they are. The
log also holds the run's name, so a batch is applied to each of several tables
exactly once, whatever failed in between (``apply_to_all``).

The log has one row a replaced partition and run. It and the list of current
partitions are read on the driver, as a table's partition list always is. One
writer commits to a table at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import upsert

LOG = "version bigint, batch string, folder string, part string"


@dataclass(frozen=True)
class Staged:
    """Rows written for ``batch``; ``parts`` are the partitions that they will replace."""

    batch: str
    folder: str
    parts: tuple[tuple[str | None, ...], ...]


class VersionedTable:
    """Rows of ``schema`` at ``path``, replaced by partition (text columns ``partition_cols``; none: as a whole)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition_cols: tuple[str, ...] = ()):
        self.spark, self.path, self.schema, self.cols = spark, path.rstrip("/"), schema, list(partition_cols)

    def log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.path}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG)

    def applied(self, batch: str) -> bool:
        return not self.log().filter(F.col("batch") == batch).isEmpty()

    def stage(self, df: DataFrame, batch: str, empty: tuple[tuple[str | None, ...], ...] = ()) -> Staged:
        """Write ``df`` aside. It replaces the partitions that it has rows in, and those listed in ``empty``.

        All row sets of a partition are gathered in ``df`` first (D9). A hot
        partition is written by several tasks, small ones share a task.
        """
        folder = f"{self.path}/data/{batch}-{uuid.uuid4().hex}"
        rows = df.select([f.name for f in self.schema])
        if not self.cols:
            rows.write.parquet(folder)
            return Staged(batch, folder, ((),))
        rows.hint("rebalance", *self.cols).write.partitionBy(*self.cols).parquet(folder)
        found = self._read(folder).select(*self.cols).distinct().collect()
        return Staged(batch, folder, tuple({*map(tuple, found), *empty}))

    def commit(self, staged: Staged) -> None:
        """Make the staged partitions current: one file, so readers see all of them or none."""
        last = self.log().agg(F.max("version")).first()[0]
        rows = [((last or 0) + 1, staged.batch, staged.folder, json.dumps(p)) for p in staged.parts]
        self.spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def replace(self, df: DataFrame, batch: str, empty: tuple[tuple[str | None, ...], ...] = ()) -> None:
        """Stage and commit."""
        self.commit(self.stage(df, batch, empty))

    def current(self) -> DataFrame:
        """The rows of every partition's last commit, read with partition pruning."""
        latest = self.log().groupBy("part").agg(F.max_by("folder", "version").alias("folder")).collect()
        folders: dict[str, list] = {}
        for r in latest:
            folders.setdefault(r.folder, []).append(json.loads(r.part))
        out = self.spark.createDataFrame([], self.schema)
        for folder in sorted(folders):
            rows = self._read(folder)
            if self.cols:
                wanted = F.lit(False)
                for part in folders[folder]:
                    same = F.lit(True)
                    for c, v in zip(self.cols, part):
                        same = same & F.col(c).eqNullSafe(F.lit(v))
                    wanted = wanted | same
                rows = rows.filter(wanted)
            out = out.unionByName(rows)
        return out

    def _read(self, folder: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(folder).select([f.name for f in self.schema])


def apply_to_all(targets: list[VersionedTable], batch: str, incoming: DataFrame, keys: list[str]) -> int:
    """K5: one change batch upserted (U1) into every target exactly once; the number of targets that still lacked it.

    ``batch`` names the change; a target whose log has it is left as it is, so
    after a failure between two targets the same call finishes the rest.
    """
    waiting = [t for t in targets if not t.applied(batch)]
    for table in waiting:
        table.replace(upsert(table.current(), incoming, keys), batch)
    return len(waiting)
