"""Canonical-id resolution.

Every per-row remote lookup of the reference becomes one join for the whole
batch. The link table grows with the data, so it is not broadcast blindly;
Spark's adaptive execution switches a join to broadcast at runtime when the
link side really is small, and splits skewed partitions when one canonical
or original id is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import join_key, packed_id, unpacked_id
from .skew import salted_join


def latest_links(links: DataFrame, order_col: str | None = None) -> DataFrame:
    """One canonical id per original id: the latest by ``order_col``, else the
    smallest (deterministic). Keeps resolution joins free of fan-out."""
    if order_col:
        agg = F.max_by("connect_id", order_col)
    else:
        agg = F.min("connect_id")
    return links.groupBy("org_id").agg(agg.alias("connect_id"))


def resolve_column(df: DataFrame, links: DataFrame, column: str, out: str | None = None,
                   salt_buckets: int | None = None) -> DataFrame:
    """Replace ``column`` by its canonical id where a link exists
    (``coalesce(connect_id, column)``); unlinked ids stay as they are.

    ``salt_buckets`` spreads each id over that many tasks (``skew.salted_join``)
    for inputs where one id holds a large share of the rows and AQE's skew
    handling is not available.
    """
    out = out or column
    lk = links.select(F.col("org_id").alias("__org"), F.col("connect_id").alias("__cid"))
    if salt_buckets:
        joined = salted_join(df, lk, [(column, "__org")], "left", salt_buckets)
    else:
        joined = df.join(lk, df[column] == lk["__org"], "left")
    cols = [F.coalesce(F.col("__cid"), F.col(column)).alias(out) if c == out else F.col(c)
            for c in df.columns]
    if out not in df.columns:
        cols.append(F.coalesce(F.col("__cid"), F.col(column)).alias(out))
    return joined.select(*cols)


def pack_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Id columns of text as bytes (``ids.packed_id``), half as wide in an exchange; ``unpack_columns`` undoes it."""
    text = [c for c in columns if df.schema[c].dataType == T.StringType()]
    return df.select(*[packed_id(c).alias(c) if c in text else F.col(c) for c in df.columns])


def unpack_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[unpacked_id(c).alias(c) if c in columns and df.schema[c].dataType == T.BinaryType() else F.col(c)
                       for c in df.columns])


def resolve_columns(df: DataFrame, links: DataFrame, columns: list[str], carried: list[str] = ()) -> DataFrame:
    """Resolve several id columns (for example both ends of an edge).

    The ids, and the id columns named in ``carried``, travel as bytes between the joins.
    """
    text = all(x.schema[c].dataType == T.StringType() for x, cs in ((df, columns), (links, ["org_id", "connect_id"])) for c in cs)
    ids = [*columns, *carried] if text else []
    r, lk = pack_columns(df, ids), pack_columns(links, ["org_id", "connect_id"] if text else [])
    for c in columns:
        r = resolve_column(r, lk, c)
    return unpack_columns(r, ids)


def resolve_messages(messages: DataFrame, links: DataFrame) -> DataFrame:
    """Resolve sender (``user``) and receiver (``party``); the message id is
    rebuilt from the resolved sender as ``user-timesent-platform_msg_id``."""
    r = resolve_columns(messages, links, ["user", "party"])
    mid = join_key("user", "timesent", "platform_msg_id", skip_nulls=True)
    return r.withColumn("mid", mid)


def resolve_group_messages(group_messages: DataFrame, links: DataFrame) -> DataFrame:
    """Resolve the sender of group messages."""
    return resolve_column(group_messages, links, "sender")


def remap_in_array(df: DataFrame, links: DataFrame, key: str, array_col: str,
                   element_id: Column | None = None, seq: bool = True) -> DataFrame:
    """Remap ids inside an array column: explode (with position), left-join
    links, ``coalesce``. Returns one row per element (long form) with columns
    ``key, pos, element, new_id``; regroup with ``collect_list`` only at the
    output edge."""
    exploded = df.select(key, F.posexplode(array_col).alias("pos", "element"))
    eid = element_id if element_id is not None else F.col("element")
    exploded = exploded.withColumn("__eid", eid)
    res = resolve_column(exploded, links, "__eid", out="new_id")
    return res.drop("__eid")
