"""Explicit salting for joins on hot keys.

AQE splits skewed join partitions at runtime. Where it is off, or a key is
hotter than its thresholds catch, ``salted_join`` spreads one key over
``buckets`` tasks: each row of the large side gets a deterministic salt (a
hash of the row, so a retried task puts every row in the same bucket again)
and the small side — at most a few rows per key, such as a link table — is
replicated once per bucket. The result equals the unsalted join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "__salt"


def salted_join(big: DataFrame, small: DataFrame, condition_keys: list[tuple[str, str]], how: str = "left",
                buckets: int = 16) -> DataFrame:
    """Join ``big`` to ``small`` on ``big[b] == small[s]`` for each (b, s) pair.

    ``how`` is ``inner`` or ``left`` (rows of ``big`` are kept). ``small``
    must not share column names with ``big``.
    """
    salt: Column = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(buckets))
    b = big.withColumn(SALT, salt)
    s = small.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    cond = b[SALT] == s[SALT]
    for bc, sc in condition_keys:
        cond = cond & (b[bc] == s[sc])
    return b.join(s, cond, how).drop(b[SALT]).drop(s[SALT])
