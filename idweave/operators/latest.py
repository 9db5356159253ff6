"""Latest row per key with counts, ties kept.

Two forms:

* ``same_type`` (recommended): count and latest over the same filtered
  rows. ``rank() == 1`` lets Spark insert a map-side partial
  ``WindowGroupLimit`` before the shuffle, so a hot key (one pair holding a
  third of all rows) is cut down to its tied-latest rows on every mapper
  before anything moves. The count is a separate partial aggregate. Both
  sides come out hash-partitioned on the key, so their join adds no shuffle.
* ``join_back`` (faithful to the reference): count and max time over the
  filtered rows, then every row of *any* type at that time is joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_with_count(df: DataFrame, keys: list[str], ts: str, row_filter=None,
                      join_back: bool = False, count_col: str = "count") -> DataFrame:
    """Rows at the greatest ``ts`` per key (all ties), with the row count per key.

    ``row_filter`` selects the rows that are counted (and, in the
    ``same_type`` form, the rows that can be latest).
    """
    counted = df.filter(row_filter) if row_filter is not None else df
    if join_back:
        agg = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col), F.max(ts).alias(ts))
        return df.join(agg, on=[*keys, ts], how="inner")
    counts = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    top = counted.withColumn("_rk", F.rank().over(w)).filter(F.col("_rk") == 1).drop("_rk")
    return top.join(counts, on=keys, how="inner")
