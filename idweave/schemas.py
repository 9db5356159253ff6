"""Data model: conformed tables, links and the cell catalog."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column order of the conformed user model (22 text columns plus
# is_user), as the reference defines it. password and salt are part of the
# model but are never filled by our conform step (secret columns are dropped).
USER_COLUMNS = [
    "rowkey", "userid", "name", "name_source", "mail", "phone", "platform", "reg_time", "update_time",
    "password", "salt", "gender", "birthday", "address", "area", "profession", "card", "facebookid", "ip",
    "lives", "race", "status", "is_user",
]
SECRET_COLUMNS = ("password", "salt")

# The attributes profiled as "value -> platforms" (generic form).
GENERIC_PROFILE_ATTRS = [
    "mail", "phone", "gender", "birthday", "address", "area", "profession", "card", "facebookid", "ip",
    "lives", "race", "status",
]

USER_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType() if c == "is_user" else T.StringType(), True) for c in USER_COLUMNS]
)

CONTACT_SCHEMA = T.StructType([
    T.StructField("u_uid", T.StringType()),
    T.StructField("c_uid", T.StringType()),
    T.StructField("name", T.StringType()),
])

MESSAGE_COLUMNS = [
    "mid", "content", "platform_msg_id", "partyuid", "useruid", "party", "user", "timesent", "media",
    "direction", "msgtype", "name",
]
GROUP_MESSAGE_COLUMNS = ["mid", "content", "gid", "platform_msg_id", "useruid", "timesent", "media", "msgtype"]

LINK_SCHEMA = T.StructType([
    T.StructField("org_id", T.StringType(), False),
    T.StructField("connect_id", T.StringType(), False),
])

EVIDENCE_ENTRY = T.StructType([
    T.StructField("evidence", T.ArrayType(T.StringType())),
    T.StructField("score", T.IntegerType()),
])

# Type names a catalog may use, mapped to Spark types (float is read as double).
TYPE_NAMES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "float": T.DoubleType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
}


@dataclass(frozen=True)
class CellColumn:
    family: str
    qualifier: str
    type: str = "string"


@dataclass
class Catalog:
    """Describes a wide-column table: key column, filter domain and cells.

    ``columns`` maps a DataFrame column to (family, qualifier, type). The key
    column is stored as the row key, not as a cell.
    """

    table: str
    rowkey: str
    columns: dict[str, CellColumn] = field(default_factory=dict)
    domain: str = ""

    @classmethod
    def for_columns(cls, table: str, rowkey: str, family: str, names: list[str],
                    types: dict[str, str] | None = None) -> "Catalog":
        """Catalog builder: every column but the key in one family, upper-case qualifiers."""
        types = types or {}
        cols = {n: CellColumn(family, n.upper(), types.get(n, "string")) for n in names if n != rowkey}
        return cls(table=table, rowkey=rowkey, columns=cols)

    def schema(self) -> T.StructType:
        fields = [T.StructField(self.rowkey, T.StringType(), True)]
        for name, col in self.columns.items():
            fields.append(T.StructField(name, TYPE_NAMES.get(col.type, T.StringType()), True))
        return T.StructType(fields)
