"""Message statistics and counters.

Everything is a combinable aggregate (partial on the map side, final after
the shuffle), so a hot user or day costs no more than its share of rows.
Distinct counts go through Spark's two-level distinct aggregation, which
first de-duplicates on (key, value) — spread over many tasks — and only
then counts per key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaners import signin_filter
from ..functions.ids import day_to_epoch_millis, join_key
from .latest import latest_with_count

def pair_count_latest(messages: DataFrame, msgtype: int = 0, join_back: bool = False,
                      null_token: str = "null") -> DataFrame:
    """T14 part 1 (A1 + J5 + F11 + P9): per (user, party), the number of
    type-``msgtype`` messages and the latest one(s), sign-in text removed."""
    latest = latest_with_count(messages, ["user", "party"], "timesent",
                               row_filter=F.col("msgtype") == msgtype, join_back=join_back)
    out = latest.select(
        join_key("user", "party").alias("uuid"), "user", "count",
        signin_filter("content", null_token).alias("content"),
        "timesent", "platform_msg_id", "partyuid", "party", "platform")
    return out.filter(F.col("content") != F.lit(null_token)).distinct()


def pair_with_party(pair_counts: DataFrame, users: DataFrame) -> DataFrame:
    """T14 part 2 (J7): attach name, phone, mail of the party; a party with
    several user rows fans out (kept, as in the reference)."""
    u = users.select(F.col("rowkey").alias("party"), "name", "phone", "mail")
    return pair_counts.join(u, on="party", how="left")


def total_per_person(messages: DataFrame) -> DataFrame:
    """T14 part 3 (A2 + O1): distinct messages per person, as sender or receiver."""
    # Both legs (sender, receiver) from one pass over the messages: the same
    # rows as UNION ALL of the two projections, without computing the input twice.
    legs = messages.select(F.explode(F.array("user", "party")).alias("user"), "mid")
    return legs.groupBy("user").agg(F.countDistinct("mid").alias("count"))


def group_count_latest(group_messages: DataFrame, msgtype: int = 1, join_back: bool = True) -> DataFrame:
    """T15 part 1 (A8 + J6): per (platform, gid), count of type-``msgtype``
    messages, latest time, and the message(s) at that time with their sender."""
    latest = latest_with_count(group_messages, ["platform", "gid"], "timesent",
                               row_filter=F.col("msgtype") == msgtype, join_back=join_back)
    guid = join_key("platform", "gid")
    return latest.select(
        join_key("sender", guid).alias("uuid"), "sender", "count", "content", "timesent", "media",
        "platform_msg_id", "platform", guid.alias("guid"))


def group_with_name(group_counts: DataFrame, group_info: DataFrame) -> DataFrame:
    """T15 part 2 (J8): attach the group name; groups without info are dropped."""
    gi = group_info.select(F.col("groupuid").alias("guid"), "groupname")
    return group_counts.join(gi, on="guid", how="inner")


def group_totals(group_messages: DataFrame) -> DataFrame:
    """Messages per group, key ``platform-gid``."""
    return (group_messages.groupBy("platform", "gid").agg(F.count(F.lit(1)).alias("count"))
            .select(join_key("platform", "gid").alias("guid"), "count"))


def count_distinct_with_null(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """SQL ``count(1)`` over ``GROUP BY value`` — a NULL value is one group too."""
    return df.select(*by, value).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def daily_counters(user_sources: list[DataFrame], contacts: DataFrame, messages: DataFrame,
                   group_messages: DataFrame, day: str = "day") -> DataFrame:
    """T23 (A12-A14, O2, F20): per day, distinct users over several sources,
    distinct contact rows, distinct message ids and group-message ids.

    Inputs carry a ``day`` column (yyyyMMdd); user sources a ``uid`` column;
    message sources a ``mid`` column. All days are computed in one pass: the
    distinct ids of all kinds together, then one count per day.
    """
    return counters_of(counter_state(user_sources, contacts, messages, group_messages, day), day)


#: Kinds of ids in the counter state and the counters that they feed.
KINDS = {"user": "user_count", "contact": "contact_count", "message": "message_count", "groupmessage": "groupmessage_count"}
STATE_SCHEMA = "kind string, id string, day string"


def counter_state(user_sources: list[DataFrame], contacts: DataFrame, messages: DataFrame, group_messages: DataFrame,
                  day: str = "day") -> DataFrame:
    """The distinct (kind, id, day) behind the daily counters; a NULL id is one id (D8), a contact's id its whole row."""
    def of(kind, df, value):
        return df.select(F.lit(kind).alias("kind"), value.cast("string").alias("id"), F.col(day).cast("string").alias(day))
    row = F.to_json(F.struct(*[c for c in contacts.columns if c != day]), {"ignoreNullFields": "false"})
    parts = [*(of("user", s, F.col("uid")) for s in user_sources), of("contact", contacts, row),
             of("message", messages, F.col("mid")), of("groupmessage", group_messages, F.col("mid"))]
    return reduce(DataFrame.unionByName, parts).distinct()


def counters_of(state: DataFrame, day: str = "day") -> DataFrame:
    """Daily counters from the distinct ids: a partial count in every task, one row a day and task after it."""
    counted = state.groupBy(day).agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(name) for k, name in KINDS.items()])
    return counted.select(day, day_to_epoch_millis(day).alias("time"), *KINDS.values())


def extend_state(table, more: DataFrame, batch: str) -> None:
    """Add a late batch's (kind, id, day) to the state kept in a ``VersionedTable`` partitioned by day.

    Only the days that the batch has rows of are read and written again; a
    batch that was applied before changes nothing.
    """
    if table.applied(batch):
        return
    days = [r.day for r in more.select("day").distinct().collect()]  # a calendar's worth
    mine = F.lit(False)
    for d in days:
        mine = mine | F.col("day").eqNullSafe(F.lit(d))
    table.replace(table.current().filter(mine).unionByName(more.select("kind", "id", "day")).distinct(), batch)


def cumulative_counters(daily: DataFrame, since_millis: str, base_users: int, base_contacts: int,
                        fixed: dict[str, int] | None = None, at_day: str | None = None) -> DataFrame:
    """T24 (A10 + A11): base constants plus the sums of daily increments after
    ``since_millis``; one row. ``fixed`` adds constant columns."""
    recent = daily.filter(F.col("time").cast("long") > F.lit(int(since_millis)))
    out = recent.agg(
        (F.lit(base_users) + F.coalesce(F.sum("user_count"), F.lit(0))).cast("long").alias("user_count"),
        (F.lit(base_contacts) + F.coalesce(F.sum("contact_count"), F.lit(0))).cast("long").alias("contact_count"),
    )
    for name, value in (fixed or {}).items():
        out = out.withColumn(name, F.lit(int(value)).cast("long"))
    if at_day is not None:
        out = out.withColumn("time", day_to_epoch_millis(F.lit(at_day)))
    return out


def running_counters(daily: DataFrame, base: dict[str, int]) -> DataFrame:
    """A11 general form: base + running sum of each counter, ordered by time.

    The input has one row per day (bounded by the calendar, not by data
    volume), so the un-partitioned window over it is small by construction.
    """
    w = Window.orderBy(F.col("time").cast("long")).rowsBetween(Window.unboundedPreceding, 0)
    out = daily
    for name, b in base.items():
        out = out.withColumn(f"total_{name}", (F.lit(int(b)) + F.sum(name).over(w)).cast("long"))
    return out


def detail_count(df: DataFrame, part_col: str, after: str, data_name: str, type_: str,
                 source: str, insert_time: str) -> DataFrame:
    """T25 (A15): rows after a partition value, with descriptive literals."""
    return (df.filter(F.col(part_col) > F.lit(after)).agg(F.count(F.lit(1)).alias("count"))
            .select(F.lit(data_name).alias("data_name"), F.lit(type_).alias("type"), "count",
                    F.lit(source).alias("source"), F.lit(insert_time).alias("insert_time")))


def count_by(df: DataFrame, col: str | Column, name: str = "count") -> DataFrame:
    """Rows per value of one column."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))
