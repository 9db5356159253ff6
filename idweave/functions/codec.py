"""Typed text encode/decode for cell storage and JSON edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import col_of

# Text formats of the cell encoding.
DATE_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
BOOL_TRUE, BOOL_FALSE = "True", "False"


def encode_value(c, type_name: str, legacy_falsy: bool = False) -> Column:
    """typed value -> cell text.

    ``legacy_falsy=True`` reproduces the old rule where 0, False and '' all
    encode to ''.
    """
    c = col_of(c)
    if type_name == "boolean":
        out = F.when(c, F.lit(BOOL_TRUE)).when(~c, F.lit(BOOL_FALSE))
    elif type_name == "date":
        out = F.date_format(c, DATE_FORMAT)
    elif type_name == "datetime":
        out = F.date_format(c, DATETIME_FORMAT)
    else:
        out = c.cast("string")
    if legacy_falsy:
        falsy = {
            "boolean": ~c,
            "int": c == 0, "long": c == 0, "float": c == 0,
        }.get(type_name, c.cast("string") == F.lit(""))
        out = F.when(falsy, F.lit("")).otherwise(out)
    return out


def decode_value(c, type_name: str, legacy_bool: bool = False) -> Column:
    """cell text -> typed value; empty, NULL or unparsable text -> NULL."""
    c = F.nullif(col_of(c), F.lit(""))
    if type_name == "boolean":
        if legacy_bool:
            return c.isNotNull()
        low = F.lower(c)
        return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))
    if type_name == "date":
        return F.try_to_date(c, DATE_FORMAT) if hasattr(F, "try_to_date") else F.to_date(c, DATE_FORMAT)
    if type_name == "datetime":
        return F.try_to_timestamp(c, F.lit(DATETIME_FORMAT))
    spark_type = {"int": "int", "long": "bigint", "float": "double"}.get(type_name)
    if spark_type:
        return c.try_cast(spark_type)
    return c


def to_json_text(c) -> Column:
    """nested value -> JSON text (only at the storage edge)."""
    return F.to_json(col_of(c))


def from_json_text(c, schema: T.DataType | str) -> Column:
    """JSON text -> nested value with a fixed schema."""
    return F.from_json(col_of(c), schema)
