"""A quarantine beside the accepted rows, from one pass.

Every row gets the codes of the rules that it breaks; accepted and rejected
rows are written by the same job into two partitions, and the counts are
observed while they are written, so rows in = accepted + rejected by
construction and can be checked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sorted:
    """``accepted`` has the input's columns, ``rejected`` also ``reasons`` (codes in the rules' order); ``counts``: rows,
    accepted, rejected and every code's rows."""

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def quarantine(df: DataFrame, rules: dict[str, Column], path: str) -> Sorted:
    """Sort ``df`` into accepted and rejected rows at ``path``.

    ``rules``: code -> condition that rejects a row (NULL: it does not). The
    column names ``reasons`` and ``is_accepted`` are taken.
    """
    codes = F.array_compact(F.array(*[F.when(rule, F.lit(code)) for code, rule in rules.items()]))
    flagged = df.withColumn("reasons", codes).withColumn("is_accepted", F.size("reasons") == 0)
    seen = Observation()
    observed = flagged.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("is_accepted").alias("accepted"),
                               F.count_if(~F.col("is_accepted")).alias("rejected"),
                               *[F.count_if(F.array_contains("reasons", code)).alias(f"reason_{code}") for code in rules])
    observed.write.partitionBy("is_accepted").parquet(path)
    counts = {k.removeprefix("reason_"): v for k, v in seen.get.items()}
    back = df.sparkSession.read.schema(flagged.schema).parquet(path)
    return Sorted(back.filter("is_accepted").select(*df.columns), back.filter("NOT is_accepted").select(*df.columns, "reasons"), counts)
