"""Query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (through ``views``), runs over whole
tables, and aliases every computed column to the name the DuckDB oracle in
``oracle.py`` uses. Nested outputs are flattened to rows so that results can
be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaners as C
from ..functions import ids as I
from ..functions.codec import decode_value, encode_value
from ..operators import conform, counts, dedup, enrich, forest, match, merge, profiles, resolve, setops
from ..operators.lists import ordered_cells
from ..schemas import Catalog, CellColumn
from ..sources import cells as cellio
from . import pipelines, views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
NULL = "null"


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


# ======================================================================= shared
def messages(spark: SparkSession, base: str) -> DataFrame:
    return pipelines.clean_messages_from_source(views.message_source(spark, base), "cust", "supp", "cust")


def group_messages(spark: SparkSession, base: str) -> DataFrame:
    return pipelines.clean_group_messages(views.raw_group_messages(spark, base))


def conformed_users(spark: SparkSession, base: str) -> DataFrame:
    """T1 + T2 + T3 + T4 specs applied to the dirty customer view."""
    return conformed(views.dirty(spark, base))


def conformed(d: DataFrame) -> DataFrame:
    """T1 + T2 + T3 + T4 specs applied to rows of the dirty customer view."""
    a = conform.conform_users(d, conform.spec_basic("pa", "c_custkey", "raw_name", "raw_phone", "raw_mail"))
    c = conform.conform_users(d, conform.spec_profile(
        "pc", "c_custkey", "raw_name", "raw_phone", "raw_mail", "raw_gender", "raw_birth",
        reg_time="c_mktsegment"))
    v = conform.conform_users(d, conform.spec_phone_id("pd", "raw_phone"))
    b = conform.conform_users(d.withColumn("reg", F.col("c_nationkey").cast("string"))
                              .withColumn("acct", F.when(F.col("c_acctbal") >= 0, "active").otherwise("negative")),
                              conform.spec_profile("pb", "c_custkey", "raw_name", "raw_phone", "raw_mail", "raw_gender",
                                                   "raw_birth", reg_time="reg", parse_birth=False,
                                                   extra={"lives": "c_mktsegment", "status": "acct"}))
    return a.unionByName(c).unionByName(v).unionByName(b)


def resolved_users(spark: SparkSession, base: str) -> DataFrame:
    return resolve.resolve_column(conformed_users(spark, base), views.links(spark, base), "rowkey")


def match_tokens(spark: SparkSession, base: str) -> DataFrame:
    """Set attributes of customers: phone = nation code, names = {name,
    segment}, mail = cleaned mail, contacts = suppliers ordered from."""
    d = views.dirty(spark, base).select(
        "rowkey", F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("phone"),
        F.col("c_name").alias("name1"), F.col("c_mktsegment").alias("name2"),
        C.clean_mail("raw_mail").alias("mail"))
    t = match.tokens_from_columns(d, "rowkey", {"phone": "phone", "name": "name1"}, None) \
        .unionByName(match.tokens_from_columns(d, "rowkey", {"name": "name2", "mail": "mail"}, None))
    e = views.contacts(spark, base).select(F.col("u_uid").alias("rowkey"), F.lit("contacts").alias("attr"),
                                           F.col("c_uid").alias("value"))
    return t.unionByName(e).distinct()


# ===================================================================== cleaners
@query("clean_phone")
def q_clean_phone(spark, base):
    """F3 on every customer's raw phone text."""
    d = views.dirty(spark, base)
    return d.select("c_custkey", "raw_phone", C.clean_phone("raw_phone", NULL).alias("phone"))


@query("clean_name")
def q_clean_name(spark, base):
    """F4."""
    d = views.dirty(spark, base)
    return d.select("c_custkey", "raw_name", C.clean_name("raw_name", NULL).alias("name"))


@query("clean_mail")
def q_clean_mail(spark, base):
    """F5."""
    d = views.dirty(spark, base)
    return d.select("c_custkey", "raw_mail", C.clean_mail("raw_mail", NULL).alias("mail"))


@query("clean_birth")
def q_clean_birth(spark, base):
    """F6 (UTC epoch seconds as text)."""
    d = views.dirty(spark, base)
    return d.select("c_custkey", "raw_birth", C.clean_birth("raw_birth", NULL).alias("birthday"))


@query("clean_gender")
def q_clean_gender(spark, base):
    """F8."""
    d = views.dirty(spark, base)
    return d.select("c_custkey", "raw_gender", C.clean_gender("raw_gender").alias("gender"))


@query("clean_platforms")
def q_clean_platforms(spark, base):
    """F7."""
    d = views.dirty(spark, base)
    return d.select("c_custkey", C.clean_platforms("raw_platforms", NULL).alias("platforms"))


@query("pad_millis")
def q_pad_millis(spark, base):
    """F9 on message times given in seconds (type 0) or milliseconds (type 1)."""
    m = views.raw_messages(spark, base)
    t = F.when(F.col("msgtype") == 0, F.col("timesent")).otherwise(F.col("timesent") * 1000)
    return m.select("mid", C.pad_millis(t).alias("millis"))


@query("mail_from_documents")
def q_mail_from_documents(spark, base):
    """F5 on every mail-like token found anywhere in the whole document texts."""
    docs = views.read_table(spark, base, "documents").select("doc_id", "text")
    found = docs.select("doc_id", F.explode(F.regexp_extract_all(
        "text", F.lit("[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+"), F.lit(0))).alias("raw_mail"))
    return found.select("doc_id", "raw_mail", C.clean_mail("raw_mail", NULL).alias("mail"))


@query("signin_name")
def q_signin_name(spark, base):
    """F10 + F11 on conversation text with planted sign-in phrases."""
    t = views.signin_texts(spark, base)
    return t.select("conv_id", "turn", C.signin_name("msg", NULL).alias("name"),
                    C.signin_filter("msg", NULL).alias("content"))


@query("rowkey_md5")
def q_rowkey_md5(spark, base):
    """F1 + F2."""
    u = views.users(spark, base)
    return u.select("userid", "platform", I.rowkey("userid", F.col("platform")).alias("rowkey"))


@query("msg_id_parts")
def q_msg_id_parts(spark, base):
    """F15 + F16: parts of the dash-joined message id."""
    m = views.raw_messages(spark, base)
    return m.select("mid", *[I.key_part("mid", i).alias(f"part{i}") for i in range(4)])


@query("day_millis")
def q_day_millis(spark, base):
    """yyyyMMdd -> epoch milliseconds text."""
    e = views.events_by_day(spark, base).select("day").distinct()
    return e.select("day", I.day_to_epoch_millis("day").alias("millis"))


@query("typed_codec")
def q_typed_codec(spark, base):
    """F17 + F18: typed values -> cell text -> typed values again."""
    e = views.read_table(spark, base, "events").select("event_id", "ts", "value", "user_id")
    enc = e.select("event_id",
                   encode_value(F.col("ts").cast("timestamp"), "datetime").alias("ts_text"),
                   encode_value(F.to_date("ts"), "date").alias("day_text"),
                   encode_value(F.col("value"), "float").alias("value_text"),
                   encode_value(F.col("value") > 50, "boolean").alias("big_text"),
                   encode_value(F.col("user_id"), "long").alias("user_text"))
    return enc.select("event_id", "ts_text", "day_text", "big_text",
                      F.date_format(decode_value("ts_text", "datetime"), "yyyy-MM-dd HH:mm:ss").alias("ts_back"),
                      decode_value("value_text", "float").alias("value_back"),
                      decode_value("big_text", "boolean").cast("int").alias("big_back"),
                      decode_value("user_text", "long").alias("user_back"))


# ===================================================================== conform
@query("conform_users")
def q_conform_users(spark, base):
    """T1 + T3 + T4 (P2): three platform specs over the dirty customers."""
    return conformed_users(spark, base)


def _fanout(spark, base):
    return conform.contact_fanout(views.fanout_source(spark, base), "pc")


@query("contact_fanout_edges")
def q_contact_fanout_edges(spark, base):
    """T6 (P10): ids or cleaned phones -> hashed contact edges."""
    return _fanout(spark, base)[0]


@query("contact_fanout_users")
def q_contact_fanout_users(spark, base):
    """T6 (P12 + A4): owner and contact user rows, de-duplicated."""
    return _fanout(spark, base)[1]


@query("contact_edges_named")
def q_contact_edges_named(spark, base):
    """T5: hashed edges with a cleaned contact name."""
    src = views.fanout_source(spark, base)
    return conform.contact_edges(src, "pa", "u_uid", "c_uid", "c_name")


# ==================================================================== messages
@query("msg_dedup")
def q_msg_dedup(spark, base):
    """T8 (A3 + F16): de-duplicated messages."""
    return messages(spark, base)


@query("gmsg_dedup")
def q_gmsg_dedup(spark, base):
    """T9 (A3 + F16): de-duplicated group messages."""
    return group_messages(spark, base)


@query("msg_contacts")
def q_msg_contacts(spark, base):
    """T8 (A5): edges implied by messages."""
    return pipelines.message_contacts(messages(spark, base))


@query("msg_named_users")
def q_msg_named_users(spark, base):
    """T8 (P4 + A4): user rows named by sign-in messages."""
    return pipelines.message_named_users(messages(spark, base))


@query("pair_count_latest")
def q_pair_count_latest(spark, base):
    """Flagship: count + latest type-0 message per pair, ties kept."""
    return counts.pair_count_latest(messages(spark, base))


@query("pair_count_latest_any_type")
def q_pair_count_latest_any_type(spark, base):
    """Faithful join-back form (D20): latest time of type 0, rows of any type."""
    return counts.pair_count_latest(messages(spark, base), join_back=True)


@query("pair_with_user")
def q_pair_with_user(spark, base):
    """T14 part 2 (J7): party attributes attached by a left join."""
    u = views.users(spark, base).select("rowkey", "name", F.lit(None).cast("string").alias("phone"),
                                        F.lit(None).cast("string").alias("mail"))
    named = pipelines.message_named_users(messages(spark, base)).select("rowkey", "name", "phone", "mail")
    return counts.pair_with_party(counts.pair_count_latest(messages(spark, base)), u.unionByName(named))


@query("total_msgs_per_user")
def q_total_msgs_per_user(spark, base):
    """T14 part 3 (A2 + O1)."""
    return counts.total_per_person(messages(spark, base))


@query("group_count_latest")
def q_group_count_latest(spark, base):
    """T15 part 1 (A8 + J6)."""
    return counts.group_count_latest(group_messages(spark, base))


@query("group_with_name")
def q_group_with_name(spark, base):
    """T15 part 2 (J8): inner join with group info."""
    return counts.group_with_name(counts.group_count_latest(group_messages(spark, base)),
                                  views.group_info(spark, base))


@query("group_total")
def q_group_total(spark, base):
    """A9."""
    return counts.group_totals(group_messages(spark, base))


# ================================================================= resolution
@query("resolve_ids")
def q_resolve_ids(spark, base):
    """Canonical ids of the user table."""
    u = views.users(spark, base)
    return resolve.resolve_column(u, views.links(spark, base), "rowkey")


@query("resolve_edges")
def q_resolve_edges(spark, base):
    """Both ends of every contact edge."""
    return resolve.resolve_columns(views.contacts(spark, base), views.links(spark, base), ["u_uid", "c_uid"])


@query("resolve_messages")
def q_resolve_messages(spark, base):
    """Sender and receiver resolved, mid rebuilt from the resolved sender."""
    return resolve.resolve_messages(messages(spark, base), views.links(spark, base))


@query("resolve_group_messages")
def q_resolve_group_messages(spark, base):
    """J4."""
    return resolve.resolve_group_messages(group_messages(spark, base), views.links(spark, base))


@query("region_lookup")
def q_region_lookup(spark, base):
    """T12 (J11 + F21): longest phone prefix -> region; 'Unknown' otherwise."""
    return enrich.region_lookup(conformed_users(spark, base), views.prefixes(spark, base))


# ==================================================================== profiles
def _flat(ev: DataFrame, fields: list[str]) -> DataFrame:
    s = profiles.score(ev)
    return s.select("rowkey", "attr", "value", *[F.col(f"ev.{f}").alias(f) for f in fields], "score")


@query("profile_generic")
def q_profile_generic(spark, base):
    """T16 (J1 + A17): value -> platforms for every generic attribute."""
    return _flat(profiles.generic_evidence(resolved_users(spark, base)), ["platform"])


@query("profile_name")
def q_profile_name(spark, base):
    """Name -> (source_id, platform)."""
    return _flat(profiles.name_evidence(resolved_users(spark, base)), ["source_id", "platform"])


@query("profile_accounts")
def q_profile_accounts(spark, base):
    """Platform -> (userid, reg_time)."""
    return _flat(profiles.account_evidence(resolved_users(spark, base)), ["userid", "reg_time"])


@query("profile_region")
def q_profile_region(spark, base):
    """T17 (J1 + A20)."""
    reg = enrich.region_lookup(conformed_users(spark, base), views.prefixes(spark, base))
    reg = resolve.resolve_column(reg, views.links(spark, base), "rowkey")
    return _flat(profiles.region_evidence(reg), ["country", "province", "city", "code", "platform"])


def _resolved_edges(spark, base):
    return resolve.resolve_columns(views.contacts(spark, base), views.links(spark, base), ["u_uid", "c_uid"])


@query("profile_contacts")
def q_profile_contacts(spark, base):
    """T18 (J2 + A21)."""
    return _flat(profiles.contact_evidence(_resolved_edges(spark, base)), ["name", "platform"])


@query("profile_be_contacts")
def q_profile_be_contacts(spark, base):
    """T18 (J2 + A22)."""
    return _flat(profiles.contact_evidence(_resolved_edges(spark, base), reverse=True), ["name", "platform"])


@query("contact_counts")
def q_contact_counts(spark, base):
    """contact_count / be_contact_count per profile (map sizes)."""
    e = _resolved_edges(spark, base)
    ev = profiles.contact_evidence(e).unionByName(profiles.contact_evidence(e, reverse=True))
    a = profiles.value_counts(ev, "contacts", "contact_count")
    b = profiles.value_counts(ev, "be_contacts", "be_contact_count")
    return a.join(b, "rowkey", "full_outer").select(
        "rowkey", F.coalesce("contact_count", F.lit(0)).alias("contact_count"),
        F.coalesce("be_contact_count", F.lit(0)).alias("be_contact_count"))


# Stored vs incoming profile evidence: messages before / after a date, overlapping.
STORED_BEFORE = 883612800    # 1998-01-01 UTC, epoch seconds
INCOMING_FROM = 852076800    # 1997-01-01 UTC


def _two_sides(src: DataFrame, attrs: list[str], stored: str, incoming: str) -> tuple[DataFrame, DataFrame]:
    """The distinct evidence, one row an attribute of ``src`` (rowkey, platform, ...), that meets each condition.

    Both sides are filters of one aggregate, and their conditions are one column of it: so neither reads other columns
    than the other, both read the same exchange, and what is keyed by its columns later needs none of its own. Row keys
    are bytes (``packed_id``) up to the score.
    """
    # Not ``unpivot``: one side's filters go through its rows, the other's do not, and the exchanges differ.
    ev = src.withColumn("a", F.explode(F.array(*[F.struct(F.lit(a).alias("attr"), F.col(a).alias("value")) for a in attrs])))
    ev = ev.select(*[c for c in src.columns if c not in attrs], "a.attr", "a.value")
    side = F.when(F.expr(stored), 1).otherwise(0) + F.when(F.expr(incoming), 2).otherwise(0)
    flagged = (ev.filter(C.is_present("value") & F.col("rowkey").isNotNull())
               .select(I.packed_id("rowkey").alias("rowkey"), "attr", "value", F.struct("platform").alias("ev"), side.alias("side"))
               .filter("side > 0 AND rowkey IS NOT NULL AND attr IS NOT NULL AND value IS NOT NULL")  # else a join adds some to one side
               .groupBy("rowkey", "attr", "value", "ev").agg(F.bit_or("side").alias("side")))
    return tuple(flagged.filter(F.col("side").bitwiseAND(F.lit(bit)) != 0).drop("side") for bit in (1, 2))


def _stored_incoming(spark, base) -> tuple[DataFrame, DataFrame]:
    """Stored and incoming evidence from one pass over the messages: each
    evidence row is flagged by the message times behind it."""
    m = messages(spark, base)
    src = m.select(F.col("user").alias("rowkey"), F.col("direction").alias("platform"), "media",
                   F.col("partyuid").alias("partner"), "timesent")
    return _two_sides(src, ["media", "partner"], f"timesent < {STORED_BEFORE}", f"timesent >= {INCOMING_FROM}")


@query("profile_merge")
def q_profile_merge(spark, base):
    """N4 (J12): incoming profiles merged with what was stored for them."""
    stored, incoming = _stored_incoming(spark, base)
    return _flat(profiles.merge_evidence(stored, incoming, snapshot=False), ["platform"])


@query("profile_snapshot")
def q_profile_snapshot(spark, base):
    """The new stored state (stored-only profiles persist)."""
    stored, incoming = _stored_incoming(spark, base)
    return _flat(profiles.merge_evidence(stored, incoming, snapshot=True), ["platform"])


#: Buckets of the stored evidence in ``load_job_snapshot``.
EVIDENCE_BUCKETS = 16


@query("load_job_snapshot")
def q_load_job_snapshot(spark, base):
    """Two load jobs into one evidence store, with the batch that first brought a row.

    A third of the customers (and the evidence of their contacts) comes with
    the first job only, a third with the second only, a third with both.
    """
    from ..sources.evidence_store import EvidenceStore
    from ..sources.scratch import store as stored
    store = EvidenceStore(spark, _scratch(spark, "evidence"), EVIDENCE_BUCKETS)
    contacts = stored(views.contacts(spark, base), "contacts")
    for batch, absent in (("day1", 2), ("day2", 0)):
        d = views.dirty(spark, base).filter(F.col("c_custkey") % 3 != absent)
        u = conformed(d)
        e = contacts.join(d.select(F.col("rowkey").alias("u_uid")), "u_uid", "left_semi")
        out = pipelines.load_job(store, u, e, enrich.region_lookup(u, views.prefixes(spark, base)), views.links(spark, base), batch)
    return out


@query("profile_merge_maps")
def q_profile_merge_maps(spark, base):
    """N2 + N3 + N4 on the map form, flattened back to rows for comparison.

    Stored and incoming maps (one per profile and attribute) are merged with
    ``map_zip_with``; the output lists value, sorted evidence text and score.
    """
    stored, incoming = _stored_incoming(spark, base)
    st, inc = profiles.to_nested(stored), profiles.to_nested(incoming)
    st = st.select("rowkey", "attr", F.col("profile").alias("stored"))
    j = inc.join(st, ["rowkey", "attr"], "left")
    vt = inc.schema["profile"].dataType.valueType
    merged = j.select("rowkey", "attr", profiles.merge_maps(profiles.coalesce_map(F.col("stored"), vt),
                                                             profiles.coalesce_map(F.col("profile"), vt)).alias("m"))
    ex = resolve.unpack_columns(merged.select("rowkey", "attr", F.explode("m").alias("value", "e")), ["rowkey"])
    return ex.select("rowkey", "attr", "value",
                     F.array_join(F.array_sort(F.transform("e.evidence", lambda x: x["platform"])), ",")
                     .alias("evidence"), F.col("e.score").alias("score"))


@query("profile_json_roundtrip")
def q_profile_json_roundtrip(spark, base):
    """nested profile -> JSON cell text -> nested again, flattened."""
    nested = profiles.to_nested(profiles.generic_evidence(resolved_users(spark, base)))
    schema = nested.schema["profile"].dataType
    back = nested.select("rowkey", "attr", F.from_json(F.to_json("profile"), schema).alias("p"))
    ex = back.select("rowkey", "attr", F.explode("p").alias("value", "e"))
    return ex.select("rowkey", "attr", "value",
                     F.array_join(F.transform("e.evidence", lambda x: x["platform"]), ",").alias("evidence"),
                     F.col("e.score").alias("score"))


# ==================================================================== matching
@query("block_keys")
def q_block_keys(spark, base):
    """I1 (A7 + N1): ids grouped by a shared phone."""
    return match.block_keys(match_tokens(spark, base))


@query("comparison_records")
def q_comparison_records(spark, base):
    """I2 (A6 + J9), long form: the set values of every blocked id."""
    t = match_tokens(spark, base)
    return match.comparison_records(t, match.block_keys(t))


@query("pair_scores")
def q_pair_scores(spark, base):
    """I3 + I4: weighted-Jaccard pairs sharing a phone, score >= 50."""
    return match.pair_scores(match_tokens(spark, base), threshold=50.0)


# ======================================================================= merge
@query("merge_profiles")
def q_merge_profiles(spark, base):
    """I6 (A24 + A25 + J15): policy merge of packed profiles into nation ids."""
    return merge.merge_profiles(views.packed_profiles(spark, base), views.links_nation(spark, base))


@query("packed_profile_cells")
def q_packed_profile_cells(spark, base):
    """The merged profiles of every nation id as packed cells, entries in the order of original id and position."""
    return merge.pack_entries(merge.merge_profiles(views.packed_profiles(spark, base), views.links_nation(spark, base)))


@query("rekey_messages")
def q_rekey_messages(spark, base):
    """Messages of linked senders / receivers re-keyed."""
    return merge.rekey_messages(messages(spark, base), views.links(spark, base))


@query("rekey_store_after_delete")
def q_rekey_store_after_delete(spark, base):
    """K6: the message store after the re-keying's puts and deletes are merged on read."""
    from ..sources.changes import merged
    from ..sources.scratch import store
    m = store(messages(spark, base), "messages")
    return merged(m, merge.rekey_changes(m, views.links(spark, base), 1), ["mid"], ["replaces"])


@query("rekey_edges")
def q_rekey_edges(spark, base):
    """I10 + I11: both edge directions re-keyed at once."""
    return merge.rekey_edges(views.contacts(spark, base), views.links_nation(spark, base))


@query("link_flatten")
def q_link_flatten(spark, base):
    """Stored links + second generation, chains followed to the end."""
    out, _ = merge.flatten_links(views.links(spark, base), views.links_next(spark, base))
    return out


@query("split_identity")
def q_split_identity(spark, base):
    """Split every canonical id of the BUILDING segment back into its
    archived originals."""
    links = views.links(spark, base)
    archive = merge.archive_originals(views.packed_profiles(spark, base), links)
    targets = (views.read_table(spark, base, "customer").filter(F.col("c_mktsegment") == "BUILDING")
               .select(F.expr(views.LINK_CONNECT).alias("connect_id")))
    restored, _ = merge.split_identity(archive, links, targets)
    return restored


@query("split_identity_links")
def q_split_identity_links(spark, base):
    """The links that remain after the split."""
    links = views.links(spark, base)
    targets = (views.read_table(spark, base, "customer").filter(F.col("c_mktsegment") == "BUILDING")
               .select(F.expr(views.LINK_CONNECT).alias("connect_id")))
    return merge.split_identity(links.select(F.col("org_id").alias("rowkey")), links, targets)[1]


@query("split_second_generation")
def q_split_second_generation(spark, base):
    """I14 over generations: the nation ids of even nations are split back to the first generation of merges."""
    log = forest.grown(forest.grown(spark.createDataFrame([], "generation bigint, org_id string, connect_id string"),
                                    views.links(spark, base), 1), views.links_next(spark, base), 2)
    targets = views.read_table(spark, base, "nation").filter("n_nationkey % 2 = 0").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("connect_id"))
    return forest.split_to(log, targets, 1, 2)


@query("merge_id_groups")
def q_merge_id_groups(spark, base):
    """Customers in debt of one nation and segment merged under a new id a group."""
    c = views.read_table(spark, base, "customer").filter("c_acctbal < 0")
    return forest.merge_groups(c.select(F.concat_ws("/", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("group"),
                                        F.expr(views.CUST_ROWKEY).alias("id")))


@query("id_list_concat")
def q_id_list_concat(spark, base):
    """Canonical id -> its original ids, sorted and tab-joined."""
    return merge.connect_to_orgs(views.links(spark, base))


@query("phone_platform_lists")
def q_phone_platform_lists(spark, base):
    """Per id, the sorted list of (phone, platform) entries as text."""
    u = conformed_users(spark, base).filter(C.is_present("phone"))
    return ordered_cells(u, ["userid"], F.concat_ws(":", "phone", "platform"), ",", out="phones")


# ==================================================================== counters
def _counter_inputs(e: DataFrame):
    users_a = e.filter(F.col("event_type") == "signup").select("day", F.col("user_id").alias("uid"))
    users_b = e.filter(F.col("event_type") == "purchase").select("day", F.col("user_id").alias("uid"))
    contacts_ = e.select("day", "user_id", "event_type")
    msgs = e.filter(F.col("event_type") == "click").select("day", F.col("event_id").alias("mid"))
    gmsgs = e.filter(F.col("event_type") == "view").select("day", F.col("event_id").alias("mid"))
    return [users_a, users_b], contacts_, msgs, gmsgs


def _daily(e: DataFrame) -> DataFrame:
    u, c, m, g = _counter_inputs(e)
    return counts.daily_counters(u, c, m, g)


@query("daily_counters")
def q_daily_counters(spark, base):
    """T23 (A12-A14 + F20): per-day distinct users, contacts, messages."""
    return _daily(views.events_by_day(spark, base))


# Cumulative bases and constant counters of the weekly report.
BASE_USERS = 2055131992
BASE_CONTACTS = 12140402832
WEEKLY_CONSTANTS = {"txt_count": 2657456 + 591828, "pic_count": 1754450 + 232048,
                    "video_count": 71146 + 8816, "wav_count": 388313 + 75634}


@query("cumulative_counters")
def q_cumulative_counters(spark, base):
    """T24 (A10 + A11): base + increments after 2024-01-15."""
    return counts.cumulative_counters(_daily(views.events_by_day(spark, base)), "1705276800000",
                                      BASE_USERS, BASE_CONTACTS, WEEKLY_CONSTANTS, at_day="20240131")


@query("running_counters")
def q_running_counters(spark, base):
    """A11 general form: running totals over days."""
    return counts.running_counters(_daily(views.events_by_day(spark, base)),
                                   {"user_count": BASE_USERS, "contact_count": BASE_CONTACTS})


@query("detail_count")
def q_detail_count(spark, base):
    """T25 (A15): rows after a partition value."""
    return counts.detail_count(views.events_by_day(spark, base), "day", "20240120", "events", "click",
                               "events", "20240131")


@query("count_by_type")
def q_count_by_type(spark, base):
    """A16."""
    return counts.count_by(views.read_table(spark, base, "events"), "event_type")


@query("counter_upsert")
def q_counter_upsert(spark, base):
    """U1 + K5: stored daily counters replaced by a newer overlapping batch."""
    e = views.events_by_day(spark, base)
    stored = _daily(e.filter(F.col("day") < "20240116"))
    incoming = _daily(e.filter(F.col("day") >= "20240110"))
    from ..sources.sinks import upsert
    return upsert(stored, incoming, ["time"])


@query("counter_targets")
def q_counter_targets(spark, base):
    """K5: one batch of counters upserted into three targets, each exactly once though the first run stops after one."""
    from ..sources.versioned import VersionedTable, apply_to_all
    e = views.events_by_day(spark, base)
    stored, incoming = _daily(e.filter(F.col("day") < "20240116")), _daily(e.filter(F.col("day") >= "20240110"))
    targets = {n: VersionedTable(spark, _scratch(spark, n), stored.schema) for n in ("main", "dev", "test")}
    for t in targets.values():
        t.replace(stored, "stored")
    apply_to_all([targets["main"]], "batch", incoming, ["time"])
    apply_to_all(list(targets.values()), "batch", incoming, ["time"])
    parts = [t.current().withColumn("target", F.lit(n)) for n, t in targets.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _state(e: DataFrame) -> DataFrame:
    return counts.counter_state(*_counter_inputs(e))


@query("daily_counters_late_batch")
def q_daily_counters_late_batch(spark, base):
    """T23 with late data: a fifth of the events of the first days comes late and extends the state of those days only.

    Users whose id is a multiple of 97 have none: NULL is one user a day.
    """
    from ..sources.versioned import VersionedTable
    e = views.events_by_day(spark, base).withColumn("user_id", F.when(F.col("user_id") % 97 != 0, F.col("user_id")))
    late = (F.col("event_id") % 5 == 0) & (F.col("day") < "20240112")
    table = VersionedTable(spark, _scratch(spark, "counter_state"), spark.createDataFrame([], counts.STATE_SCHEMA).schema, ("day",))
    counts.extend_state(table, _state(e.filter(~late)), "first")
    counts.extend_state(table, _state(e.filter(late)), "late")
    counts.extend_state(table, _state(e.filter(late)), "late")  # a repeated run changes nothing
    return counts.counters_of(table.current())


# ==================================================================== sources
CELL_CATALOG = Catalog.for_columns("USER", "rowkey", "INFO",
                                   ["rowkey", "userid", "name", "mail", "phone", "gender", "birthday", "is_user"],
                                   {"is_user": "int"})


@query("to_cells")
def q_to_cells(spark, base):
    """K4 (N8 + F17): wide user rows of all platforms -> (rowkey, family, qualifier, value) cells."""
    return cellio.to_cells(conformed_users(spark, base), CELL_CATALOG)


@query("from_cells")
def q_from_cells(spark, base):
    """S3 (N8 + N9 + F18 + P7): cells of all platforms -> typed wide rows, domain filter applied.

    Customers with one phone share a row of platform pd; of their cells the largest value stays.
    """
    u = conformed_users(spark, base)
    cat = Catalog(CELL_CATALOG.table, "rowkey", dict(CELL_CATALOG.columns), domain="is_user = 1")
    return cellio.from_cells(cellio.to_cells(u, cat), cat)


@query("cell_records")
def q_cell_records(spark, base):
    """Newline-separated JSON cell records per row -> cells (last write wins)."""
    u = views.users(spark, base)
    recs = u.select("rowkey", F.concat_ws("\n",
                    F.to_json(F.struct(F.lit("INFO").alias("columnFamily"), F.lit("NAME").alias("qualifier"),
                                       F.col("name").alias("value"))),
                    F.to_json(F.struct(F.lit("INFO").alias("columnFamily"), F.lit("NATION").alias("qualifier"),
                                       F.col("nation").alias("value"))),
                    F.to_json(F.struct(F.lit("INFO").alias("columnFamily"), F.lit("NAME").alias("qualifier"),
                                       F.upper("name").alias("value")))).alias("cells"))
    cells = cellio.decode_cell_records(recs)
    cat = Catalog("USER", "rowkey", {"name": CellColumn("INFO", "NAME"), "nation": CellColumn("INFO", "NATION", "int")})
    return cellio.from_cells(cells, cat, seq_col="seq")


@query("lines_to_cells")
def q_lines_to_cells(spark, base):
    """Comma text lines -> cells."""
    u = views.users(spark, base)
    lines = u.select(F.concat_ws(",", "rowkey", F.lit("INFO"), F.lit("name"), "name").alias("value"))
    return cellio.lines_to_cells(lines)


@query("subtract_by_key")
def q_subtract_by_key(spark, base):
    """Users without a link."""
    u = views.users(spark, base)
    lk = views.links(spark, base).select(F.col("org_id").alias("rowkey"))
    return setops.subtract_by_key(u, lk, ["rowkey"])


@query("subtract_rows")
def q_subtract_rows(spark, base):
    """Bag difference keeping left duplicates."""
    m = views.raw_messages(spark, base)
    left = m.select("user", "party", "media")
    right = m.filter(F.col("msgtype") == 1).select("user", "party", "media")
    return setops.subtract_rows(left, right)


@query("distinct_users")
def q_distinct_users(spark, base):
    """A4 + A5: row distinct over the conformed model rows."""
    return dedup.distinct_rows(conformed_users(spark, base).select("rowkey", "userid", "phone", "platform"))


# ============================================================ write / read back
def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    import uuid

    from ..session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/idweave-io/{name}-{uuid.uuid4().hex}"


@query("partition_roundtrip")
def q_partition_roundtrip(spark, base):
    """K1 + K3 + S1: write the user model partitioned by (time, platform) with
    dynamic overwrite, then scan one partition back (pruned at the scan)."""
    from pyspark.sql import types as T

    from ..schemas import USER_SCHEMA
    from ..sources.sinks import write_partitions
    from ..sources.tables import read_partition
    path = _scratch(spark, "users")
    write_partitions(conformed_users(spark, base).withColumn("time", F.lit("20240101")), path)
    schema = T.StructType(USER_SCHEMA.fields + [T.StructField("time", T.StringType())])
    return read_partition(spark, path, "platform", "pc", schema=schema).filter(F.col("time") == "20240101")


@query("partition_commit")
def q_partition_commit(spark, base):
    """K1 + K2 + D9: two days of four platforms through staged commits, read back.

    The first day gathers conformed users and contact fan-out users, then one
    of its platforms is replaced; the others survive. A run that stops before
    its commit leaves nothing.
    """
    from pyspark.sql import types as T

    from ..schemas import USER_SCHEMA
    from ..sources.versioned import VersionedTable
    schema = T.StructType(USER_SCHEMA.fields + [T.StructField("time", T.StringType())])
    table = VersionedTable(spark, _scratch(spark, "users"), schema, ("time", "platform"))
    users = conformed_users(spark, base)
    fan = conform.contact_fanout(views.fanout_source(spark, base), "pc")[1]
    table.replace(users.unionByName(fan).withColumn("time", F.lit("20240101")), "day1")
    table.replace(users.withColumn("time", F.lit("20240102")), "day2")
    table.stage(users.filter("platform = 'pb'").limit(0).withColumn("time", F.lit("20240102")), "stopped", (("20240102", "pb"),))
    again = users.filter((F.col("platform") == "pa") & C.is_present("mail"))
    table.replace(again.withColumn("time", F.lit("20240101")), "day1-pa-again")
    return table.current()


@query("csv_roundtrip")
def q_csv_roundtrip(spark, base):
    """CSV with header read back with a fixed schema (bad lines kept aside)."""
    from ..sources.tables import read_csv
    u = views.users(spark, base)
    path = _scratch(spark, "users_csv")
    u.write.mode("overwrite").option("header", "true").csv(path)
    return read_csv(spark, path, u.schema).select(*u.columns)


@query("json_roundtrip")
def q_json_roundtrip(spark, base):
    """JSON lines read back with a fixed schema."""
    from ..sources.tables import read_json
    u = views.users(spark, base)
    path = _scratch(spark, "users_json")
    u.write.mode("overwrite").json(path)
    return read_json(spark, path, u.schema).select(*u.columns)


# ======================================================= groups, links, one day
def _members(spark, base):
    conv = views.read_table(spark, base, "conversations").select("conv_id", "role").distinct()
    src = conv.select(F.col("conv_id").alias("groupid"),
                      F.concat(F.col("role"), F.lit("@"), F.col("conv_id").cast("string")).alias("uid"), "role")
    return conform.group_members(src, "conv")


@query("group_members")
def q_group_members(spark, base):
    """Group member rows of every conversation."""
    return _members(spark, base)


@query("group_info_rows")
def q_group_info_rows(spark, base):
    """Group info rows (one per system turn) with the creator's key."""
    sysr = views.read_table(spark, base, "conversations").filter(F.col("role") == "system")
    src = sysr.select(F.col("conv_id").alias("groupid"), F.col("text").alias("groupname"),
                      F.concat(F.lit("system@"), F.col("conv_id").cast("string")).alias("createruid"),
                      F.col("turn").alias("created"), F.lit("conv").alias("grouptype"))
    return conform.group_info(src, "conv")


@query("resolve_group_members")
def q_resolve_group_members(spark, base):
    """T21 (J1 on T10): member keys resolved to canonical ids."""
    lk = views.links(spark, base)
    m = _members(spark, base).withColumn(
        "uuid", F.concat(F.md5(F.col("uid")), F.lit("-conv")))
    return resolve.resolve_column(m, lk, "uuid")


@query("rekey_group_messages")
def q_rekey_group_messages(spark, base):
    """I8: group-message senders re-keyed to canonical ids."""
    return merge.rekey_group_messages(group_messages(spark, base), views.links(spark, base))


@query("contact_fanout_phone_ids")
def q_contact_fanout_phone_ids(spark, base):
    """Contact rows where the cleaned phone is the id (edges)."""
    return conform.contact_fanout(views.fanout_source(spark, base), "pd", phone_ids=True)[0]


def _link_requests(spark, base):
    c = views.read_table(spark, base, "customer")
    return c.select(F.expr(views.CUST_ROWKEY).alias("org_id"), F.expr(views.LINK_CONNECT).alias("connect_id"),
                    F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("status"),
                    F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "20240101")
                    .otherwise("20240102").alias("insert_time"))


@query("pending_links")
def q_pending_links(spark, base):
    """S9 (I5): pending link requests of one insert time."""
    return merge.pending_links(_link_requests(spark, base), "20240101")


@query("clear_pending")
def q_clear_pending(spark, base):
    """K7: link requests left after the processed ones are deleted."""
    return merge.clear_pending(_link_requests(spark, base), "20240101")


@query("event_props")
def q_event_props(spark, base):
    """F19 on stored JSON text: event properties decoded with a fixed schema,
    then summed per event type and property value."""
    from ..functions.codec import from_json_text
    e = views.read_table(spark, base, "events").select(
        "event_type", "value", from_json_text("props", "k int").alias("p"))
    return e.groupBy("event_type", F.col("p.k").alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query("platform_day_users")
def q_platform_day_users(spark, base):
    """All user rows of one platform-day (conformed users, contact fan-out
    users, users named by sign-in messages), ready for the (time, platform) write."""
    spec = conform.spec_basic("pa", "c_custkey", "raw_name", "raw_phone", "raw_mail")
    out = pipelines.platform_day(views.dirty(spark, base), spec, views.fanout_source(spark, base),
                                 views.message_source(spark, base), time="20240101")
    return out["users"]


def _platform_day(spark, base) -> dict[str, DataFrame]:
    spec = conform.spec_basic("pa", "c_custkey", "raw_name", "raw_phone", "raw_mail")
    return pipelines.platform_day(views.dirty(spark, base), spec, views.fanout_source(spark, base),
                                  views.message_source(spark, base), views.prefixes(spark, base), time="20240101")


@query("platform_day_contacts")
def q_platform_day_contacts(spark, base):
    """All contact edges of one platform-day (fan-out rows and message ends)."""
    return _platform_day(spark, base)["contacts"]


@query("platform_day_messages")
def q_platform_day_messages(spark, base):
    """The cleaned messages of one platform-day."""
    return _platform_day(spark, base)["messages"]


@query("platform_day_region")
def q_platform_day_region(spark, base):
    """The regions of all users of one platform-day."""
    return _platform_day(spark, base)["region"]


def _merge_requests(spark, base):
    """Every canonical id of a customer asks to be merged into its nation's id; half of them later."""
    c = views.read_table(spark, base, "customer")
    return c.select(F.expr(views.LINK_CONNECT).alias("org_id"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias(
        "connect_id"), F.lit(1).alias("status"), F.lit("20240101").alias("insert_time")).distinct()


def _canonical_cells(spark, base):
    """Profile cells under canonical ids (a count and a region), and under the originals merged into them earlier."""
    c = views.read_table(spark, base, "customer").select(F.expr(views.CUST_ROWKEY).alias("own"), F.expr(
        views.LINK_CONNECT).alias("canon"), "c_mktsegment")
    return (c.groupBy(F.col("canon").alias("rowkey")).agg(F.count("*").cast("string").alias("value"))
            .select("rowkey", F.lit("MSG_COUNT").alias("field"), "value")
            .unionByName(c.select(F.col("canon").alias("rowkey"), F.lit("REGION").alias("field"),
                                  F.col("c_mktsegment").alias("value")).distinct())
            .unionByName(c.select(F.col("own").alias("rowkey"), F.lit("MSG_COUNT").alias("field"), F.lit("1").alias("value"))))


def _merge_job(spark, base, part, cells=None, second=False):
    """One output of the job; ``second``: messages, groups and edges carry canonical ids of the first generation."""
    links = views.links(spark, base)
    msgs, groups, edges = messages(spark, base), group_messages(spark, base), views.contacts(spark, base)
    if second:
        msgs, groups, edges = merge.rekey_messages(msgs, links), merge.rekey_group_messages(groups, links), \
            merge.rekey_edges(edges, links)
    cells = (lambda: views.packed_profiles(spark, base)) if cells is None else cells
    return pipelines.identity_merge_job(cells, msgs, groups, edges, links, _merge_requests(spark, base), "20240101")[part]


@query("merge_job_links")
def q_merge_job_links(spark, base):
    """Stored links after merging every canonical id into its nation id."""
    return _merge_job(spark, base, "links")


@query("merge_job_messages")
def q_merge_job_messages(spark, base):
    """Messages re-keyed with the closure of the job."""
    return _merge_job(spark, base, "messages")


@query("merge_job_messages_second")
def q_merge_job_messages_second(spark, base):
    """Messages that already carry a first-generation canonical id move on to the second."""
    return _merge_job(spark, base, "messages", second=True)


@query("merge_job_group_messages")
def q_merge_job_group_messages(spark, base):
    """Group messages re-keyed by the job."""
    return _merge_job(spark, base, "group_messages")


@query("merge_job_edges")
def q_merge_job_edges(spark, base):
    """Edges of first-generation canonical ids re-keyed to the second; equal edges collapse."""
    return _merge_job(spark, base, "edges", second=True)


@query("merge_job_profiles")
def q_merge_job_profiles(spark, base):
    """Cells gathered under old canonical ids move on; originals merged earlier are not counted again."""
    return _merge_job(spark, base, "profiles", cells=_canonical_cells(spark, base))


@query("merge_job_drop_sources")
def q_merge_job_drop_sources(spark, base):
    """T26 + I15: the cell store after the job, cells of the ids that moved deleted."""
    from ..sources.changes import merged
    cells = _canonical_cells(spark, base)
    out = pipelines.identity_merge_job(cells, messages(spark, base), group_messages(spark, base), views.contacts(spark, base),
                                       views.links(spark, base), _merge_requests(spark, base), "20240101", drop_sources=True)
    return merged(cells, out["profile_changes"], ["rowkey", "field"])


@query("merge_job_archive")
def q_merge_job_archive(spark, base):
    """Originals named by pending requests are archived (customers into their canonical id, none stored yet)."""
    c = views.read_table(spark, base, "customer")
    requests = c.select(F.expr(views.CUST_ROWKEY).alias("org_id"), F.expr(views.LINK_CONNECT).alias("connect_id"), F.when(
        F.col("c_acctbal") >= 0, 1).otherwise(0).alias("status"), F.lit("20240101").alias("insert_time"))
    cells = _canonical_cells(spark, base)
    links = views.links(spark, base).limit(0)
    msgs, groups, edges = messages(spark, base), group_messages(spark, base), views.contacts(spark, base)
    return pipelines.identity_merge_job(cells, msgs, groups, edges, links, requests, "20240101")["archive"]


@query("merge_job_requests")
def q_merge_job_requests(spark, base):
    """The request table without the processed rows."""
    c = views.read_table(spark, base, "customer")
    more = c.select(F.expr(views.CUST_ROWKEY).alias("org_id"), F.expr(views.LINK_CONNECT).alias("connect_id"),
                    F.lit(0).alias("status"), F.lit("20240101").alias("insert_time"))
    return pipelines.identity_merge_job(
        lambda: views.packed_profiles(spark, base), messages(spark, base), group_messages(spark, base), views.contacts(spark, base),
        views.links(spark, base), _merge_requests(spark, base).unionByName(more), "20240101")["requests"]


def _tangled_links(spark, base):
    """Orders as link requests: per seven neighbouring keys a 3-cycle with a tail and a chain of two hops, and
    every order of two canonical ids of its last digit."""
    k = views.read_table(spark, base, "orders").select(F.col("o_orderkey").alias("k"))
    at, to = F.col("k") % 7, F.when(F.col("k") % 7 == 2, F.col("k") - 2).when(F.col("k") % 7 == 3, F.col("k") - 3).otherwise(
        F.col("k") + 1)
    ring = k.select((F.col("k") - at).alias("g")).distinct().select(F.explode(F.sequence("g", F.col("g") + 5)).alias("k"))
    ring = ring.select(F.concat(F.lit("k"), "k").alias("org_id"), F.concat(F.lit("k"), to.cast("string")).alias("connect_id"))
    both = k.select(F.concat(F.lit("o"), "k").alias("org_id"), F.explode(F.array(
        *(F.concat(F.lit(x), (F.col("k") % 10).cast("string")) for x in "AB"))).alias("connect_id"))
    return ring.unionByName(both)


@query("link_tangles")
def q_link_tangles(spark, base):
    """Chains followed and conflicting requests joined, beside cycles."""
    new = _tangled_links(spark, base)
    return merge.flatten_links(new.limit(0), new)[0]


@query("link_cycles")
def q_link_cycles(spark, base):
    """Every id of a component that ends in a cycle."""
    new = _tangled_links(spark, base)
    return merge.flatten_links(new.limit(0), new)[1]


@query("daily_counters_one_day")
def q_daily_counters_one_day(spark, base):
    """T23 as the reference runs it: one day chosen by ``time LIKE 'yyyymmdd%'`` (P5)."""
    from ..sources.tables import day_prefix
    e = views.events_by_day(spark, base).withColumn("tstext", F.date_format("ts", "yyyyMMddHHmmss"))
    return _daily(e.filter(day_prefix("tstext", "20240105")))


from . import branches  # noqa: E402,F401  registers its queries
