"""Queries whose sources also hold rows that the plain views lack.

The given tables have no repeated message, no linked receiver, no profile that
only the stored state knows, no party with several user rows and no bad line.
These queries derive such rows from whole given tables (copies, links of both
ends, thirds of the customers), so that every branch of an operator has rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaners as C
from ..operators import conform, counts, merge, profiles, resolve
from ..sources.quarantine import Sorted, quarantine
from . import pipelines, views
from .catalog import _flat, _scratch, _two_sides, group_messages, messages, query


@query("msg_dedup_copies")
def q_msg_dedup_copies(spark, base):
    """T8 (A3 + F16): the first message of every order comes twice, with a later id; the smaller id stays."""
    src = views.message_source(spark, base)
    again = src.filter(F.col("messagetoken").endswith(".1")).withColumn("messagetoken", F.concat("messagetoken", F.lit("z")))
    return pipelines.clean_messages_from_source(src.unionByName(again), "cust", "supp", "cust")


@query("gmsg_dedup_copies")
def q_gmsg_dedup_copies(spark, base):
    """T9 (A3 + F16): user turns come twice, with a later id; the smaller id stays."""
    raw = views.raw_group_messages(spark, base)
    return pipelines.clean_group_messages(raw.unionByName(raw.filter("media = 'user'").withColumn("mid", F.concat("mid", F.lit("z")))))


def _half_links(spark, base) -> DataFrame:
    """All suppliers and every second customer -> their nation's id: edges and messages with either, both or no end linked."""
    c = views.read_table(spark, base, "customer").filter("c_custkey % 2 = 0").select(
        F.expr(views.CUST_ROWKEY).alias("org_id"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("connect_id"))
    s = views.read_table(spark, base, "supplier").select(
        F.expr(views.SUPP_ROWKEY).alias("org_id"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("connect_id"))
    return c.unionByName(s)


@query("resolve_edges_both_ends")
def q_resolve_edges_both_ends(spark, base):
    """Edges whose second end is linked, with and without the first."""
    return resolve.resolve_columns(views.contacts(spark, base), _half_links(spark, base), ["u_uid", "c_uid"])


@query("resolve_messages_both_ends")
def q_resolve_messages_both_ends(spark, base):
    """J3 (T19): messages whose receiver is linked, with and without the sender."""
    return resolve.resolve_messages(messages(spark, base), _half_links(spark, base))


@query("rekey_messages_both_ends")
def q_rekey_messages_both_ends(spark, base):
    """The receiver leg (mid kept) and the sender leg (mid rebuilt)."""
    return merge.rekey_messages(messages(spark, base), _half_links(spark, base))


@query("pair_with_user_fanout")
def q_pair_with_user_fanout(spark, base):
    """J7 (J14): a party with a phone row and a mail row appears with each."""
    s = views.read_table(spark, base, "supplier").select("s_suppkey", F.expr(views.SUPP_ROWKEY).alias("rowkey"), F.col("s_name").alias("name"))
    none = F.lit(None).cast("string")
    phone = s.select("rowkey", "name", F.concat(F.lit("9"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("phone"), none.alias("mail"))
    mail = s.filter("s_suppkey % 2 = 0").select("rowkey", "name", none.alias("phone"), F.concat("name", F.lit("@x.org")).alias("mail"))
    return counts.pair_with_party(counts.pair_count_latest(messages(spark, base)), phone.unionByName(mail))


def _thirds(spark, base) -> tuple[DataFrame, DataFrame]:
    """Stored and incoming evidence: a third of the customers only stored, a third only incoming, a third in both
    (there with the media of type 0 stored and those of type 1 incoming)."""
    m = messages(spark, base).select(F.col("user").alias("rowkey"), F.col("useruid").cast("bigint").alias("k"), "msgtype",
                                     F.col("direction").alias("platform"), "media", F.col("partyuid").alias("partner"))
    return _two_sides(m, ["media", "partner"], "k % 3 = 0 OR k % 3 = 1 AND msgtype = 0", "k % 3 = 2 OR k % 3 = 1 AND msgtype = 1")


@query("profile_merge_thirds")
def q_profile_merge_thirds(spark, base):
    """N4 (J12): incoming profiles with what was stored for them; profiles only stored are left out."""
    return _flat(profiles.merge_evidence(*_thirds(spark, base), snapshot=False), ["platform"])


@query("profile_snapshot_thirds")
def q_profile_snapshot_thirds(spark, base):
    """The new stored state, with profiles only stored and only incoming."""
    return _flat(profiles.merge_evidence(*_thirds(spark, base), snapshot=True), ["platform"])


@query("contact_fanout_phone_id_users")
def q_contact_fanout_phone_id_users(spark, base):
    """T7 (P12 + A4): both user row sets of contact rows where the cleaned phone is the id."""
    return conform.contact_fanout(views.fanout_source(spark, base), "pd", phone_ids=True)[1]


@query("resolve_group_info")
def q_resolve_group_info(spark, base):
    """T21 (J1 on T11): the creator of every conversation's group, resolved."""
    conv = views.read_table(spark, base, "conversations").groupBy("conv_id").agg(F.min_by(F.struct("role", "turn"), "turn").alias("first"))
    src = conv.select(F.col("conv_id").alias("groupid"), F.concat(F.lit("group "), F.col("conv_id").cast("string")).alias("groupname"),
                      F.concat("first.role", F.lit("@"), F.col("conv_id").cast("string")).alias("createruid"),
                      F.col("first.turn").alias("created"), F.lit("conv").alias("grouptype"))
    return resolve.resolve_column(conform.group_info(src, "conv"), views.links(spark, base), "createruuid")


@query("resolve_group_statistics")
def q_resolve_group_statistics(spark, base):
    """T21 (J1 on T15): count and latest messages of every group with the sender resolved."""
    return resolve.resolve_column(counts.group_count_latest(group_messages(spark, base)), views.links(spark, base), "sender")


@query("csv_bad_lines")
def q_csv_bad_lines(spark, base):
    """Every seventh line has a word where a number belongs; it comes back whole in the corrupt column."""
    from pyspark.sql import types as T

    from ..sources.tables import read_csv
    u = views.read_table(spark, base, "customer")
    path = _scratch(spark, "bad_csv")
    u.select(F.col("c_custkey").cast("string").alias("id"), F.when(F.col("c_custkey") % 7 == 0, F.lit("many")).otherwise(
        F.col("c_nationkey").cast("string")).alias("n")).write.option("header", "true").csv(path)
    return read_csv(spark, path, T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType())]))


def _quarantined(spark, base) -> dict[str, Sorted]:
    """Rows of two sources sorted by their rules: people whose cleaned phone is their id, and messages with both ends.

    Every eleventh customer's messages come without a sender, every thirteenth supplier's without a receiver.
    """
    people = views.dirty(spark, base).select(F.col("c_custkey").cast("string").alias("id"), "raw_phone", "raw_name")
    phone, raw = C.clean_phone("raw_phone"), F.coalesce("raw_phone", F.lit(""))
    src = views.message_source(spark, base).select(
        F.col("messagetoken").alias("id"), F.when(F.col("useruid").cast("bigint") % 11 != 0, F.col("useruid")).alias("useruid"),
        F.when(F.col("partyuid").cast("bigint") % 13 != 0, F.col("partyuid")).alias("partyuid"))
    return {
        "people": quarantine(people, {"no_phone": raw == "", "bad_phone": (raw != "") & phone.isNull(),
                                      "no_name": C.clean_name("raw_name").isNull()}, _scratch(spark, "people")),
        "messages": quarantine(src, {"no_sender": F.col("useruid").isNull(), "no_receiver": F.col("partyuid").isNull()},
                               _scratch(spark, "messages")),
    }


@query("rejected_rows")
def q_rejected_rows(spark, base):
    """D2, D3 (F2, T4, T8): the quarantine of both sources, with the codes of the broken rules."""
    parts = [q.rejected.select(F.lit(n).alias("source"), "id", F.array_join("reasons", ",").alias("reasons"))
             for n, q in _quarantined(spark, base).items()]
    return parts[0].unionByName(parts[1])


@query("reject_accounting")
def q_reject_accounting(spark, base):
    """The counts observed while the rows were sorted, beside the rows that were written."""
    parts = []
    for name, q in _quarantined(spark, base).items():
        n = {k: F.lit(v).cast("bigint").alias(k) for k, v in q.counts.items() if k in ("rows", "accepted", "rejected")}
        parts.append(q.accepted.agg(F.count(F.lit(1)).alias("written")).select(F.lit(name).alias("source"), *n.values(), "written"))
    return parts[0].unionByName(parts[1])
