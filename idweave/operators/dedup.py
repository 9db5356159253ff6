"""De-duplication (A3-A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_keep_min(df: DataFrame, id_col: str, by: list[str] | None = None) -> DataFrame:
    """A3: one row per distinct combination of ``by`` (default: every column
    but ``id_col``), keeping the smallest id. Deterministic, unlike
    ``collect_set(id)[0]``. ``min`` combines map-side, so a value shared by a
    third of all rows is reduced before the shuffle."""
    by = by or [c for c in df.columns if c != id_col]
    return df.groupBy(*by).agg(F.min(id_col).alias(id_col)).select(id_col, *by)


def distinct_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """A4/A5: row distinct (``GROUP BY`` used as distinct)."""
    return df.dropDuplicates(subset) if subset else df.distinct()


def spread_distinct(df: DataFrame) -> DataFrame:
    """``distinct`` of rows that hardly repeat: exchanged by their hash first, so that a task holds the distinct rows of
    its own (coalesced by size) partition only. Without it a task's map holds all that it makes, and a small input
    that is read by few tasks and makes many wide rows needs memory in proportion to the input."""
    return df.repartition(*df.columns).distinct()
