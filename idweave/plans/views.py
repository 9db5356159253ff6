"""Derived views over the driver tables.

The reference reads per-platform source tables that do not exist in the test
data. These views derive stand-ins from the given tables, so every query's
work grows with them:

* ``users``      customer as platform ``cust`` ∪ supplier as platform ``supp``
* ``dirty``      customer with raw phone/mail/name/gender/birth/platform text
                 spelled out from its columns, so every cleaner rule is hit
* ``message_source`` lineitem ⋈ orders as a platform's raw message rows
                 (user = customer, party = supplier); a sign-in phrase is
                 planted on line 4. ``raw_messages``: the same with ids,
                 keys and names derived (before de-duplication)
* ``raw_group_messages`` conversations as group messages
* ``group_info`` one row per system turn of a conversation
* ``signin_texts`` conversation text with planted sign-in phrases
* ``contacts``   distinct (customer, supplier, supplier name, priority)
* ``fanout_source`` platform-C contact rows (ids or phones, registered flags)
* ``links``      customer -> canonical id by (nation, segment), conversation
  senders -> role ids; ``links_next`` a second generation re-pointing the
  canonical ids (and suppliers) to nation ids; ``links_nation`` its closure
* ``packed_profiles`` stored profiles in the packed text-cell form
* ``prefixes``   phone prefix lookup built from nation ⋈ region
* ``events_by_day`` events with a ``yyyyMMdd`` day

Expressions shared with the DuckDB oracle are plain SQL strings that both
engines read the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import epoch_seconds, unpacked_id
from ..sources.scratch import store
from ..sources.tables import read_table

# Raw text columns of the dirty customer view (SQL understood by Spark and DuckDB).
DIRTY_EXPRS = {
    "raw_phone": """CASE c_custkey % 10
        WHEN 0 THEN NULL
        WHEN 1 THEN '+' || CAST(c_nationkey + 10 AS STRING) || ' (202) 010-' || lpad(CAST(c_custkey AS STRING), 4, '0')
        WHEN 2 THEN '0' || CAST(1000000000 + c_custkey * 7 AS STRING)
        WHEN 3 THEN CAST(c_custkey % 1000 AS STRING)
        WHEN 4 THEN '12345678901234567' || CAST(c_custkey AS STRING)
        WHEN 5 THEN '111' || CAST(2020100 + c_custkey AS STRING)
        WHEN 6 THEN '3456' || lpad(CAST(c_custkey AS STRING), 6, '0')
        WHEN 7 THEN '20111' || lpad(CAST(c_custkey AS STRING), 6, '0')
        WHEN 8 THEN ''
        ELSE ' 86 ' || CAST(13800000000 + c_custkey AS STRING) END""",
    "raw_mail": """CASE c_custkey % 12
        WHEN 0 THEN NULL
        WHEN 1 THEN 'abc'
        WHEN 2 THEN 'a@b@c'
        WHEN 3 THEN 'abc@x.org'
        WHEN 4 THEN 'user' || CAST(c_custkey AS STRING) || '@x.org'
        WHEN 5 THEN 'abcde@gmail.com'
        WHEN 6 THEN 'abcdef' || CAST(c_custkey AS STRING) || '@gmail.com'
        WHEN 7 THEN 'ABCDEF@gmail.com'
        WHEN 8 THEN 'abcde@Gmail.com'
        WHEN 9 THEN 'robert@yahoo.com'
        WHEN 10 THEN 'a-zrobert@yahoo.com'
        ELSE 'ab cd' || CAST(c_custkey AS STRING) || '@x.org' END""",
    "raw_name": """CASE c_custkey % 8
        WHEN 0 THEN NULL
        WHEN 1 THEN '  ' || c_name || ' '
        WHEN 2 THEN '.,(*'
        WHEN 3 THEN '！@#'
        WHEN 4 THEN 'a!'
        WHEN 5 THEN '-'
        WHEN 6 THEN chr(9) || c_name || chr(9)
        ELSE c_name END""",
    "raw_gender": """CASE c_custkey % 8
        WHEN 0 THEN 'Male' WHEN 1 THEN 'M' WHEN 2 THEN 'man' WHEN 3 THEN 'FM'
        WHEN 4 THEN 'woman' WHEN 5 THEN 'f' WHEN 6 THEN 'x' ELSE NULL END""",
    "raw_birth": """CASE c_custkey % 9
        WHEN 0 THEN NULL
        WHEN 1 THEN '{"day":' || CAST(1 + c_custkey % 28 AS STRING) || ',"month":' || CAST(1 + c_custkey % 12 AS STRING) || ',"year":' || CAST(1950 + c_custkey % 50 AS STRING) || '}'
        WHEN 2 THEN '{"year":' || CAST(1970 + c_custkey % 40 AS STRING) || '}'
        WHEN 3 THEN '{"day":1,"day":2,"year":2000}'
        WHEN 4 THEN '{"day":1}'
        WHEN 5 THEN 'a'
        WHEN 6 THEN 'null'
        WHEN 7 THEN '{"day":31,"month":2,"year":2001}'
        ELSE '{ "month" : 13 , "year":1999}' END""",
    "raw_platforms": """CASE c_custkey % 5
        WHEN 0 THEN 'x' || chr(9) || 'x' || chr(9) || 'x' || chr(9) || 'x' || chr(9) || c_mktsegment || chr(2) || 'y' || chr(9) || 'y' || chr(9) || 'y' || chr(9) || 'y' || chr(9) || 'N' || CAST(c_nationkey AS STRING)
        WHEN 1 THEN 'x' || chr(9) || 'x' || chr(9) || 'x' || chr(9) || c_mktsegment
        WHEN 2 THEN 'null'
        WHEN 3 THEN NULL
        ELSE 'a' || chr(9) || 'b' || chr(9) || 'c' || chr(9) || 'd' || chr(9) || c_mktsegment || chr(2) || 'a' || chr(9) || 'b' || chr(9) || 'c' || chr(9) || 'd' || chr(9) || c_mktsegment END""",
}

CUST_ROWKEY = "md5(CAST(c_custkey AS STRING)) || '-cust'"
SUPP_ROWKEY = "md5(CAST(s_suppkey AS STRING)) || '-supp'"
# Message content: a sign-in phrase on line 4 (a type-0 message), flags otherwise.
MSG_CONTENT = ("CASE WHEN l_linenumber = 4 THEN 'S' || CAST(l_suppkey AS STRING) || ' is back on Tango, ' "
               "|| l_returnflag ELSE l_returnflag || l_linestatus END")
MSG_TOKEN = "CAST(l_orderkey AS STRING) || '.' || CAST(l_linenumber AS STRING)"
GMSG_SENDER = "md5(role || '@' || CAST(conv_id AS STRING)) || '-conv'"
LINK_CONNECT = "'C' || CAST(c_nationkey AS STRING) || '-' || c_mktsegment"
# Conversation text with planted sign-in phrases in three languages.
CONV_SIGNIN = """CASE role
    WHEN 'system' THEN 'Ann' || CAST(conv_id AS STRING) || '也登入 Tangooo, ' || text
    WHEN 'user' THEN role || CAST(turn AS STRING) || '님이 Tango ' || text
    ELSE text END"""
SENDER_CONNECT = "'R-' || role"
# Contact rows of the platform-C shape (ids or phones, registered flags).
FANOUT_EXPRS = {
    "u_uid": "CAST(c_custkey AS STRING)",
    "u_phone": DIRTY_EXPRS["raw_phone"],
    "u_is": "CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END",
    "c_uid": "CAST(s_suppkey AS STRING)",
    "c_phone": "'9' || lpad(CAST(s_suppkey AS STRING), 9, '0')",
    "c_is": "CASE WHEN s_acctbal >= 0 THEN 1 ELSE 0 END",
    "c_name": "s_name",
}


def users(spark: SparkSession, base: str) -> DataFrame:
    """People of two platforms: customers (``cust``) and suppliers (``supp``)
    with their row keys ``md5(id)-platform``."""
    cust = read_table(spark, base, "customer").select(
        F.col("c_custkey").cast("string").alias("userid"), F.expr(CUST_ROWKEY).alias("rowkey"),
        F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("nation"),
        F.col("c_mktsegment").alias("segment"), F.lit("cust").alias("platform"))
    supp = read_table(spark, base, "supplier").select(
        F.col("s_suppkey").cast("string").alias("userid"), F.expr(SUPP_ROWKEY).alias("rowkey"),
        F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("nation"),
        F.lit(None).cast("string").alias("segment"), F.lit("supp").alias("platform"))
    return cust.unionByName(supp)


def dirty(spark: SparkSession, base: str) -> DataFrame:
    """Customers with raw phone, mail, name, gender, birthday and platform
    text spelled out from their columns (``DIRTY_EXPRS``)."""
    c = read_table(spark, base, "customer")
    return c.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal",
                    F.expr(CUST_ROWKEY).alias("rowkey"),
                    *[F.expr(e).alias(n) for n, e in DIRTY_EXPRS.items()])


def message_source(spark: SparkSession, base: str) -> DataFrame:
    """Direct messages as a platform's source table (raw ids, text, token)."""
    li = read_table(spark, base, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    o = read_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    m = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return m.select(
        F.col("o_custkey").cast("string").alias("useruid"),
        F.col("l_suppkey").cast("string").alias("partyuid"),
        epoch_seconds("l_shipdate").alias("timesent"),
        F.expr(MSG_TOKEN).alias("messagetoken"),
        F.expr(MSG_CONTENT).alias("mtext"),
        F.col("o_orderpriority").alias("media"),
        F.col("o_orderstatus").alias("direction"),
        (F.col("l_linenumber") % 2).cast("int").alias("msgtype"),
    )


def raw_messages(spark: SparkSession, base: str) -> DataFrame:
    """Direct messages before de-duplication, with the reference's columns."""
    from .pipelines import message_rows
    return message_rows(message_source(spark, base), "cust", "supp", "cust")


def raw_group_messages(spark: SparkSession, base: str) -> DataFrame:
    conv = read_table(spark, base, "conversations")
    token = F.concat(F.col("role"), F.col("turn").cast("string"))
    return conv.select(
        F.concat_ws("-", F.lit("conv"), F.col("conv_id").cast("string"), F.col("turn").cast("string"),
                    token).alias("mid"),
        F.col("text").alias("content"),
        F.col("conv_id").cast("string").alias("gid"),
        F.expr(GMSG_SENDER).alias("useruid"),
        F.col("turn").cast("long").alias("timesent"),
        F.col("role").alias("media"),
        (F.col("turn") % 2).cast("int").alias("msgtype"),
        F.lit("conv").alias("platform"),
    )


def group_info(spark: SparkSession, base: str) -> DataFrame:
    conv = read_table(spark, base, "conversations").filter(F.col("role") == "system")
    return conv.select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("groupuid"),
        F.col("conv_id").cast("string").alias("groupid"),
        F.col("text").alias("groupname"))


def contacts(spark: SparkSession, base: str) -> DataFrame:
    """Contact edges: a customer knows the suppliers of its orders.

    Distinct on the raw keys: an edge is a function of them, and they are a
    fifth as wide as its two hashed ids.
    """
    li = read_table(spark, base, "lineitem").select("l_orderkey", "l_suppkey")
    o = read_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    s = read_table(spark, base, "supplier").select("s_suppkey", "s_name").distinct()
    e = li.join(o, li.l_orderkey == o.o_orderkey).select("o_custkey", "l_suppkey", "o_orderpriority").distinct()
    return e.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.md5(F.col("o_custkey").cast("string")), F.lit("-cust")).alias("u_uid"),
        F.concat(F.md5(F.col("l_suppkey").cast("string")), F.lit("-supp")).alias("c_uid"),
        F.col("s_name").alias("name"), F.col("o_orderpriority").alias("platform"))


def links(spark: SparkSession, base: str) -> DataFrame:
    """Customers -> 'C<nation>-<segment>'; conversation senders -> 'R-<role>'."""
    c = read_table(spark, base, "customer")
    cust = c.select(F.expr(CUST_ROWKEY).alias("org_id"), F.expr(LINK_CONNECT).alias("connect_id"))
    conv = read_table(spark, base, "conversations").select(
        F.expr(GMSG_SENDER).alias("org_id"), F.expr(SENDER_CONNECT).alias("connect_id")).distinct()
    return cust.unionByName(conv)


def signin_texts(spark: SparkSession, base: str) -> DataFrame:
    conv = read_table(spark, base, "conversations")
    return conv.select("conv_id", "turn", F.expr(CONV_SIGNIN).alias("msg"))


def fanout_source(spark: SparkSession, base: str) -> DataFrame:
    """Platform-C contact rows: one per distinct (customer, supplier) of an order."""
    li = read_table(spark, base, "lineitem").select("l_orderkey", "l_suppkey")
    o = read_table(spark, base, "orders").select("o_orderkey", "o_custkey")
    pairs = li.join(o, li.l_orderkey == o.o_orderkey).select("o_custkey", "l_suppkey").distinct()
    c = read_table(spark, base, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    s = read_table(spark, base, "supplier").select("s_suppkey", "s_acctbal", "s_name")
    j = pairs.join(c, pairs.o_custkey == c.c_custkey).join(s, pairs.l_suppkey == s.s_suppkey)
    return j.select(*[F.expr(e).alias(n) for n, e in FANOUT_EXPRS.items()])


def links_next(spark: SparkSession, base: str) -> DataFrame:
    """Second generation: every canonical id of ``links`` and every supplier
    is re-pointed to a nation id."""
    c = read_table(spark, base, "customer").select(
        F.expr(LINK_CONNECT).alias("org_id"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("connect_id")).distinct()
    s = read_table(spark, base, "supplier").select(
        F.expr(SUPP_ROWKEY).alias("org_id"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("connect_id"))
    return c.unionByName(s)


def prefixes(spark: SparkSession, base: str) -> DataFrame:
    n = read_table(spark, base, "nation")
    r = read_table(spark, base, "region")
    nr = n.join(r, n.n_regionkey == r.r_regionkey)
    p2 = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    short = nr.select(p2.alias("prefix"), F.col("n_name").alias("country"), F.col("r_name").alias("province"),
                      F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("code"))
    long_ = nr.select(F.concat(p2, F.lit("1")).alias("prefix"), F.col("n_name").alias("country"),
                      F.col("r_name").alias("province"),
                      F.concat(F.lit("CITY_"), F.col("n_nationkey").cast("string")).alias("city"),
                      F.concat(p2, F.lit("1")).alias("code"))
    return short.unionByName(long_)


def events_by_day(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events")
    return e.withColumn("day", F.date_format("ts", "yyyyMMdd"))


def links_nation(spark: SparkSession, base: str) -> DataFrame:
    """Customers and suppliers -> 'N<nation>' (the closure of links + links_next)."""
    c = read_table(spark, base, "customer").select(
        F.expr(CUST_ROWKEY).alias("org_id"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("connect_id"))
    s = read_table(spark, base, "supplier").select(
        F.expr(SUPP_ROWKEY).alias("org_id"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("connect_id"))
    return c.unionByName(s)


def packed_profiles(spark: SparkSession, base: str) -> DataFrame:
    """Stored profiles in the packed-text cell form: (rowkey, field, value).

    Customers: PHONE, MAIL, NAME (own key as source), CONTACT, CONTACT_COUNT,
    MSG_COUNT, RELATION. Suppliers: NAME (the customers that know them as
    sources), BE_CONTACT, BE_CONTACT_COUNT, MSG_COUNT, NOTE.
    """
    from ..functions.cleaners import clean_mail, clean_phone
    from ..operators.merge import packed_contacts, packed_names
    from ..operators.resolve import pack_columns

    d = dirty(spark, base)
    edges = store(contacts(spark, base), "contacts")  # a table of its own where these views come from; read many times below
    msgs = raw_messages(spark, base)
    cust_cells = d.select("rowkey", F.explode(F.array(
        F.struct(F.lit("PHONE").alias("field"), clean_phone("raw_phone").alias("value")),
        F.struct(F.lit("MAIL").alias("field"), clean_mail("raw_mail").alias("value")),
        F.struct(F.lit("NAME").alias("field"),
                 F.concat(F.lit("name:"), F.col("c_name"), F.lit("|platforms:"), F.col("rowkey"),
                          F.lit("-cust|score:1")).alias("value")),
        F.struct(F.lit("RELATION").alias("field"), F.col("c_mktsegment").alias("value")),
    )).alias("c")).select("rowkey", "c.field", "c.value")
    s = read_table(spark, base, "supplier").select(F.expr(SUPP_ROWKEY).alias("rowkey"), "s_name")
    thin = pack_columns(edges.select("u_uid", "c_uid"), ["u_uid", "c_uid"])  # as bytes in the exchanges of names and counts
    knows = thin.distinct().join(pack_columns(s, ["rowkey"]), F.col("c_uid") == F.col("rowkey"))
    supp_names = packed_names(knows.select(unpacked_id("rowkey").alias("rowkey"), F.col("s_name").alias("name"),
                                           F.concat(unpacked_id("u_uid"), F.lit("-cust")).alias("source")))
    notes = s.select("rowkey", F.lit("NOTE").alias("field"), F.col("s_name").alias("value"))
    contact_cells = packed_contacts(edges, reverse=None)
    counts_c = (thin.groupBy("u_uid").agg(F.countDistinct("c_uid").cast("string").alias("value"))
                .select(unpacked_id("u_uid").alias("rowkey"), F.lit("CONTACT_COUNT").alias("field"), "value"))
    counts_b = (thin.groupBy("c_uid").agg(F.countDistinct("u_uid").cast("string").alias("value"))
                .select(unpacked_id("c_uid").alias("rowkey"), F.lit("BE_CONTACT_COUNT").alias("field"), "value"))
    # Messages per person as sender and as receiver, in one pass (the two
    # ends are customer and supplier keys, which never coincide).
    mc = (msgs.select(F.explode(F.array("user", "party")).alias("rowkey")).groupBy("rowkey")
          .agg(F.count(F.lit(1)).cast("string").alias("value"))
          .select("rowkey", F.lit("MSG_COUNT").alias("field"), "value"))
    out = (cust_cells.unionByName(supp_names).unionByName(notes).unionByName(contact_cells)
           .unionByName(counts_c).unionByName(counts_b).unionByName(mc))
    return out.filter(F.col("value").isNotNull())
