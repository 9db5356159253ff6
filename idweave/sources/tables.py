"""Scans (S1, S2, S10, S11) and partition predicates.

Every reader returns a lazy DataFrame; filters written against it reach the
parquet scan (partition pruning for partition columns, ``PushedFilters`` for
data columns), and only the columns a plan uses are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(base, name))


def read_partition(spark: SparkSession, path: str, partition_col: str, value: str,
                   columns: list[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """One day (or other partition value) of a partitioned table.

    With ``schema`` the partition columns keep their declared types (without
    it, partition discovery would type a day such as 20240101 as a number).
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path).filter(F.col(partition_col) == F.lit(value))
    return df.select(*columns) if columns else df


def day_prefix(c: str | Column, day: str) -> Column:
    """P5: ``col LIKE 'yyyymmdd%'`` (becomes a StartsWith pushed filter)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.startswith(day)


def after(c: str | Column, value) -> Column:
    """Greater-than on text or numeric time columns."""
    c = F.col(c) if isinstance(c, str) else c
    return c > F.lit(value)


def with_domain(df: DataFrame, domain: str | None) -> DataFrame:
    """Apply a user-supplied SQL predicate, if any."""
    return df.filter(F.expr(domain)) if domain else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             corrupt_col: str = "_corrupt_record") -> DataFrame:
    """CSV with header and a fixed schema; bad lines land in ``corrupt_col``."""
    fields = list(schema.fields)
    if corrupt_col not in schema.fieldNames():
        fields.append(T.StructField(corrupt_col, T.StringType(), True))
    return (spark.read.schema(T.StructType(fields))
            .option("header", "true").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt_col).csv(path))


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a fixed schema (no inference pass over the data)."""
    return spark.read.schema(schema).json(path)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, num_partitions: int = 10,
              properties: dict | None = None) -> DataFrame:
    """Relational import split into ``num_partitions`` parallel range reads."""
    return spark.read.jdbc(url=url, table=table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=num_partitions,
                           properties=properties or {})


def import_table(spark: SparkSession, df: DataFrame, database: str, table: str,
                 path: str | None = None) -> None:
    """S2 (sink half): create the database if missing and overwrite the table."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(f"{database}.{table}")
