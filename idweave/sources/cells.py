"""Wide rows <-> (rowkey, family, qualifier, value) cells.

The long cell layout is how a wide-column store holds a row. Writing is an
``unpivot``; reading is a keyed ``groupBy(rowkey).pivot(qualifier, fixed
list)``. The pivot list comes from the catalog, never from the data, so no
extra job runs to discover column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codec import decode_value, encode_value
from ..schemas import Catalog

CELL_JSON_SCHEMA = "columnFamily string, qualifier string, value string"


def to_cells(df: DataFrame, catalog: Catalog, legacy_falsy: bool = False) -> DataFrame:
    """K4: wide DataFrame -> cells; NULL values and rows without a row key are not written."""
    cols = [(name, spec) for name, spec in catalog.columns.items() if name in df.columns]
    stack = [
        F.struct(F.lit(spec.family).alias("family"), F.lit(spec.qualifier).alias("qualifier"),
                 encode_value(F.col(name), spec.type, legacy_falsy).alias("value"))
        for name, spec in cols
    ]
    return (df.filter(F.col(catalog.rowkey).isNotNull()).select(F.col(catalog.rowkey).cast("string").alias("rowkey"),
                      F.explode(F.array(*stack)).alias("cell"))
              .select("rowkey", "cell.family", "cell.qualifier", "cell.value")
              .filter(F.col("value").isNotNull()))


def from_cells(cells: DataFrame, catalog: Catalog, seq_col: str | None = None) -> DataFrame:
    """Cells -> typed wide DataFrame; filter by the catalog domain.

    When a (rowkey, family, qualifier) occurs twice, the cell with the
    highest ``seq_col`` wins (the later write; of equal ones and without a
    sequence column the largest value). Key-only domains are applied before the pivot.
    """
    wanted = {(s.family, s.qualifier): n for n, s in catalog.columns.items()}
    fq = F.concat_ws(":", "family", "qualifier")
    keys = [f"{f}:{q}" for (f, q) in wanted]
    picked = cells.withColumn("fq", fq).filter(F.col("fq").isin(keys))
    best = F.max(F.when(F.col("value").isNotNull(), F.struct(*([seq_col] if seq_col else []), "value")))["value"]
    # Cells are exchanged before they are compared: few tasks may make all of them, and each would sort its own.
    one = picked.repartition("rowkey", "fq").groupBy("rowkey", "fq").agg(best.alias("value"))
    wide = one.groupBy("rowkey").pivot("fq", keys).agg(F.max("value"))
    out = wide.select(
        F.col("rowkey").alias(catalog.rowkey),
        *[decode_value(F.col(f"`{f}:{q}`"), catalog.columns[n].type).alias(n)
          for (f, q), n in wanted.items()])
    return out.filter(F.expr(catalog.domain)) if catalog.domain else out


def decode_cell_records(rows: DataFrame, key_col: str = "rowkey", text_col: str = "cells") -> DataFrame:
    """Newline-separated JSON cell records of one row -> cells.

    The position of a record is kept as ``seq`` so that a later record of
    the same cell wins in ``from_cells``.
    """
    recs = rows.select(F.col(key_col).alias("rowkey"),
                       F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("seq", "rec"))
    parsed = recs.select("rowkey", "seq", F.from_json("rec", CELL_JSON_SCHEMA).alias("c"))
    return parsed.select("rowkey", F.col("c.columnFamily").alias("family"),
                         F.col("c.qualifier").alias("qualifier"), F.col("c.value").alias("value"), "seq")


def lines_to_cells(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """``key,family,qualifier,value`` text lines -> cells."""
    parts = F.split(F.col(text_col), ",", 4)
    return lines.select(F.get(parts, 0).alias("rowkey"), F.get(parts, 1).alias("family"),
                        F.get(parts, 2).alias("qualifier"), F.get(parts, 3).alias("value"))


CELLS_SCHEMA = T.StructType([
    T.StructField("rowkey", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("qualifier", T.StringType()),
    T.StructField("value", T.StringType()),
])
