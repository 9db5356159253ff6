from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing(null_token: str | None) -> Column:
    """The "missing" value: SQL NULL, or a token such as 'null'."""
    return F.lit(null_token).cast("string")
