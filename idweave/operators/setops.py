"""Key and bag differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def subtract_by_key(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``."""
    return left.join(right.select(*keys).distinct(), on=keys, how="left_anti")


def subtract_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Remove every row of ``left`` equal to some row of ``right`` (NULLs
    compare equal) and keep the duplicates of the rest. Neither ``EXCEPT``
    (de-duplicates) nor ``EXCEPT ALL`` (subtracts counts)."""
    r = right.distinct()
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(r[c]) for c in left.columns])
    return left.join(r, cond, "left_anti")
