"""Running sums and global positions without a window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Neighbouring places whose values are summed up as one block.
BLOCK = 4096


def running_sum(df: DataFrame, place: str, value: str, out: str, block: int = BLOCK) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows of a smaller ``place``.

    ``place`` is a whole number, unique and without nulls. Rows are summed up by block of ``block`` places,
    the blocks' sums run on in one window (a row a block), and inside a block
    a second window runs on from its block's start.
    """
    at = F.floor(F.col(place) / F.lit(block))
    blocks = df.groupBy(at.alias("__block")).agg(F.sum(value).alias("__sum"))
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("__block", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__block").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("__block", at).join(starts, "__block")
            .withColumn(out, (F.col("__start") + F.coalesce(F.sum(value).over(inside), F.lit(0))).cast("bigint"))
            .drop("__block", "__start"))


def global_positions(df: DataFrame, keys: list[str], order: list[str], out: str = "position") -> DataFrame:
    """Add ``out``: the row's place (from 0) among the rows of its ``keys``, sorted by ``order``.

    The rows are cut into sorted runs by range over keys and order, so a hot
    key spans as many runs as its rows fill, and even one hot value does (ties
    are broken by a row number). Each run's rows are counted, a key's counts run
    on over its runs (a row a run), and rows are numbered inside a run only.
    The runs are stored, since counting and numbering must see the same ones.
    Null keys are a key like others.
    """
    from ..sources.scratch import store
    runs = store(df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*keys, *order, "__tie")
                 .withColumn("__run", F.spark_partition_id()), "runs")
    before = Window.partitionBy(*keys).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    counts = runs.groupBy(*keys, "__run").agg(F.count(F.lit(1)).alias("__n"))
    starts = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__run").alias("__at"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    same = F.col("__run") == F.col("__at")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    inside = Window.partitionBy(*keys, "__run").orderBy(*order, "__tie")
    return runs.join(starts, same).select(*df.columns, (F.col("__start") + F.row_number().over(inside) - 1).alias(out))
