"""Connected components by label propagation with pointer jumping, to a fixed point."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from idweave.sources.scratch import store


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every end of an edge; the label is the smallest node of its component.

    Each round takes the smallest label among a node's neighbours and the
    label of its label. It ends when a round changes nothing; there is no
    limit on rounds. A round is one job: its labels are stored, so the plan
    stays small and both sides of each join come from a table (AQE splits a
    hot node), and the changed ones are counted while they are written.
    Nulls are left out; self-loops only name their node; no edges, no rows.
    """
    pairs = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).filter("node IS NOT NULL AND other IS NOT NULL")
    both = store(pairs.unionByName(pairs.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(),
                 "edges")
    labels = store(both.groupBy("node").agg(F.min(F.least("node", "other")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(
            F.min("label").alias("near"))
        jump = labels.select(F.col("node").alias("old"), F.col("label").alias("far"))
        seen = Observation()
        moved = labels.select("node", F.col("label").alias("old")).join(near, "node").join(jump, "old").select(
            "node", "old", F.least("old", "near", "far").alias("label"))
        labels = store(moved.observe(seen, F.count_if(F.expr("label != old")).alias("changed")), "labels").select("node", "label")
        if not seen.get["changed"]:
            return labels
