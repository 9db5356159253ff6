"""DuckDB oracle SQL for every query in ``catalog`` (same column names).

Written independently in DuckDB's dialect; views are CTEs over the
pre-registered driver tables. Raw dirty-text columns reuse the shared SQL
expressions of ``views`` so both engines clean the very same inputs.
"""

from __future__ import annotations

from ..functions import cleaners as _C
from .catalog import BASE_CONTACTS, BASE_USERS, WEEKLY_CONSTANTS
from .views import CONV_SIGNIN, DIRTY_EXPRS, FANOUT_EXPRS, LINK_CONNECT, MSG_CONTENT, SENDER_CONNECT

SQL: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    SQL[name] = text.strip()


# ---- shared CTE pieces ------------------------------------------------------
# Fixed values (phrases, blacklist, rules) come from ``functions.cleaners``,
# where they are stated once; the SQL below only re-expresses the rules.
SIGNIN_ANY = "|".join(_C.SIGNIN_PHRASES)
SIGNIN_RM = "|".join(_C.SIGNIN_REMOVED)


def signin_name_sql(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, '{SIGNIN_ANY}') THEN "
            f"split_part(regexp_replace({x}, '{SIGNIN_RM}', '', 'g'), ',', 1) ELSE 'null' END")


def signin_filter_sql(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{SIGNIN_RM}') THEN 'null' ELSE {x} END"


CUST_KEY = "md5(CAST(c_custkey AS VARCHAR)) || '-cust'"
SUPP_KEY = "md5(CAST(s_suppkey AS VARCHAR)) || '-supp'"

DIRTY = ("dirty AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal, "
         f"{CUST_KEY} AS rowkey, "
         + ", ".join(f"{e} AS {n}" for n, e in DIRTY_EXPRS.items()) + " FROM customer)")

RAW_MSG = f"""raw_msg AS (
  SELECT md5(CAST(o_custkey AS VARCHAR)) || '-cust' || '-' || CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR)
           || '-' || CAST(l_orderkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) AS mid,
         {MSG_CONTENT} AS content,
         CAST(l_suppkey AS VARCHAR) AS partyuid, CAST(o_custkey AS VARCHAR) AS useruid,
         md5(CAST(l_suppkey AS VARCHAR)) || '-supp' AS party, md5(CAST(o_custkey AS VARCHAR)) || '-cust' AS "user",
         CAST(epoch(l_shipdate) AS BIGINT) AS timesent, o_orderpriority AS media, o_orderstatus AS direction,
         CAST(l_linenumber % 2 AS INTEGER) AS msgtype, 'cust' AS platform
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
raw_msg2 AS (SELECT *, {signin_name_sql('content')} AS name FROM raw_msg),
msg AS (
  SELECT min(mid) AS mid, content, split_part(min(mid), '-', 4) AS platform_msg_id, partyuid, useruid, party,
         "user", timesent, media, direction, msgtype, name, platform
  FROM raw_msg2
  GROUP BY content, platform, partyuid, useruid, "user", party, media, direction, msgtype, name, timesent)"""

RAW_GMSG = """raw_gmsg AS (
  SELECT 'conv-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) || '-' || role || CAST(turn AS VARCHAR) AS mid,
         text AS content, CAST(conv_id AS VARCHAR) AS gid,
         md5(role || '@' || CAST(conv_id AS VARCHAR)) || '-conv' AS useruid,
         CAST(turn AS BIGINT) AS timesent, role AS media, CAST(turn % 2 AS INTEGER) AS msgtype, 'conv' AS platform
  FROM conversations),
gmsg AS (
  SELECT min(mid) AS mid, content, gid, split_part(min(mid), '-', 4) AS platform_msg_id, useruid, timesent,
         media, msgtype, platform, useruid AS sender
  FROM raw_gmsg GROUP BY content, gid, useruid, timesent, media, msgtype, platform)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---- flagship ---------------------------------------------------------------
PAIR_LATEST_BODY = """
SELECT DISTINCT "user" || '-' || party AS uuid, "user", count, {content} AS content, timesent,
       platform_msg_id, partyuid, party, platform
FROM ({inner}) t
WHERE {content} <> 'null'"""

sql("pair_count_latest", with_(RAW_MSG) + PAIR_LATEST_BODY.format(
    content=signin_filter_sql("content"),
    inner="""SELECT m.*, c.count FROM
               (SELECT *, rank() OVER (PARTITION BY "user", party ORDER BY timesent DESC) AS rk
                FROM msg WHERE msgtype = 0) m
               JOIN (SELECT "user", party, count(*) AS count FROM msg WHERE msgtype = 0 GROUP BY 1, 2) c
               USING ("user", party)
             WHERE rk = 1"""))

sql("pair_count_latest_any_type", with_(RAW_MSG) + PAIR_LATEST_BODY.format(
    content=signin_filter_sql("content"),
    inner="""SELECT m.*, a.count FROM msg m
             JOIN (SELECT "user", party, count(*) AS count, max(timesent) AS mx FROM msg WHERE msgtype = 0
                   GROUP BY 1, 2) a
             ON m."user" = a."user" AND m.party = a.party AND m.timesent = a.mx"""))

sql("msg_dedup", with_(RAW_MSG) + "SELECT * FROM msg")

# ---- cleaners -----------------------------------------------------------------
PHONE_BLACK = "|".join(_C.PHONE_BLACKLIST)
WS = r" \t\n\x0B\f\r"


def phone_sql(x: str, missing: str = "'null'") -> str:
    d = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return (f"CASE WHEN {x} IS NULL OR length({d}) < 7 OR length({d}) > 16 "
            f"OR regexp_matches({d}, '^({PHONE_BLACK})') THEN {missing} ELSE {d} END")


def name_sql(x: str, missing: str = "'null'") -> str:
    chars = "".join(dict.fromkeys(_C.NAME_PUNCT_ASCII + _C.NAME_PUNCT_WIDE)).replace("'", "''")
    junk = "^[" + WS + chars + "]*$"
    return (f"CASE WHEN {x} IS NULL OR regexp_matches({x}, '{junk}') THEN {missing} "
            f"ELSE regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g') END")


def mail_sql(x: str, missing: str = "'null'") -> str:
    loc, dom = f"split_part({x}, '@', 1)", f"split_part({x}, '@', 2)"
    return (f"CASE WHEN {x} IS NULL OR len(string_split({x}, '@')) <> 2 OR strlen({loc}) < 4 "
            + "".join(f"OR ({dom} = '{d}' AND NOT regexp_matches({loc}, '^({p})', 'i')) "
                      for d, p in _C.MAIL_DOMAIN_RULES.items())
            + f"THEN {missing} ELSE regexp_replace({x}, '\\s+', '', 'g') END")


def gender_sql(x: str) -> str:
    return (f"CASE lower({x}) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _C.GENDER_WORDS.items())
            + " END")


def birth_cte(src: str, key: str, raw: str, name: str = "birth") -> str:
    kv = (f"list_transform(string_split(regexp_replace({raw}, '[\"{{}}]|\\s+', '', 'g'), ','), "
          f"lambda p: string_split(p, ':'))")
    last = "list_filter(kv, lambda a: a[1] = '{k}')[-1][2]"
    return f"""{name} AS (
  SELECT {key}, CASE WHEN wf AND y IS NOT NULL AND regexp_full_match(y, '[0-9]{{4}}')
              AND regexp_full_match(m, '1[0-2]|0[1-9]|[1-9]') AND regexp_full_match(d, '3[01]|[12][0-9]|0[1-9]|[1-9]')
              AND try_strptime(y || '-' || m || '-' || d, '%Y-%m-%d') IS NOT NULL AND CAST(y AS INTEGER) >= 1900
         THEN CAST(CAST(epoch(try_strptime(y || '-' || m || '-' || d, '%Y-%m-%d')) AS BIGINT) AS VARCHAR)
         ELSE 'null' END AS birthday
  FROM (SELECT {key}, list_bool_and(list_transform(kv, lambda a: len(a) = 2)) AS wf,
               {last.format(k='year')} AS y, coalesce({last.format(k='month')}, '1') AS m,
               coalesce({last.format(k='day')}, '1') AS d
        FROM (SELECT {key}, {kv} AS kv FROM {src})))"""


sql("clean_phone", with_(DIRTY) + f"SELECT c_custkey, raw_phone, {phone_sql('raw_phone')} AS phone FROM dirty")
sql("clean_name", with_(DIRTY) + f"SELECT c_custkey, raw_name, {name_sql('raw_name')} AS name FROM dirty")
sql("clean_mail", with_(DIRTY) + f"SELECT c_custkey, raw_mail, {mail_sql('raw_mail')} AS mail FROM dirty")
sql("clean_birth", with_(DIRTY, birth_cte("dirty", "c_custkey", "raw_birth"))
    + "SELECT c_custkey, raw_birth, birthday FROM dirty JOIN birth USING (c_custkey)")
sql("clean_gender", with_(DIRTY) + f"SELECT c_custkey, raw_gender, {gender_sql('raw_gender')} AS gender FROM dirty")
sql("clean_platforms", with_(DIRTY) + """
SELECT c_custkey, CASE WHEN raw_platforms IS NULL OR raw_platforms = 'null'
   OR NOT list_bool_and(list_transform(string_split(raw_platforms, chr(2)), lambda r: len(string_split(r, chr(9))) >= 5))
   THEN 'null'
   ELSE array_to_string(list_sort(list_distinct(list_transform(string_split(raw_platforms, chr(2)),
                        lambda r: string_split(r, chr(9))[5]))), chr(9)) END AS platforms
FROM dirty""")
sql("pad_millis", with_(RAW_MSG) + """
SELECT mid, CASE WHEN length(CAST(t AS VARCHAR)) < 13 THEN CAST(t AS VARCHAR) || '000' ELSE CAST(t AS VARCHAR) END AS millis
FROM (SELECT mid, CASE WHEN msgtype = 0 THEN timesent ELSE timesent * 1000 END AS t FROM raw_msg)""")
sql("mail_from_documents", f"""
SELECT doc_id, raw_mail, {mail_sql('raw_mail')} AS mail
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+')) AS raw_mail FROM documents)""")
sql("signin_name", f"""
SELECT conv_id, turn, {signin_name_sql('msg')} AS name, {signin_filter_sql('msg')} AS content
FROM (SELECT conv_id, turn, {CONV_SIGNIN} AS msg FROM conversations)""")

USERS = f"""users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS userid, {CUST_KEY} AS rowkey, c_name AS name,
         CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS segment, 'cust' AS platform FROM customer
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR), {SUPP_KEY}, s_name, CAST(s_nationkey AS VARCHAR), CAST(NULL AS VARCHAR), 'supp'
  FROM supplier)"""
sql("rowkey_md5", with_(USERS) + "SELECT userid, platform, md5(userid) || '-' || platform AS rowkey FROM users")
sql("msg_id_parts", with_(RAW_MSG) + """
SELECT mid, split_part(mid, '-', 1) AS part0, split_part(mid, '-', 2) AS part1, split_part(mid, '-', 3) AS part2,
       split_part(mid, '-', 4) AS part3 FROM raw_msg""")
EV = "ev AS (SELECT *, strftime(ts, '%Y%m%d') AS day FROM events)"
MILLIS = "CAST(CAST(epoch(strptime({d}, '%Y%m%d')) AS BIGINT) * 1000 AS VARCHAR)"
sql("day_millis", with_(EV) + f"SELECT day, {MILLIS.format(d='day')} AS millis FROM (SELECT DISTINCT day FROM ev)")
sql("typed_codec", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day_text,
       CASE WHEN value > 50 THEN 'True' ELSE 'False' END AS big_text,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_back, value AS value_back,
       CAST(CASE WHEN value > 50 THEN 1 ELSE 0 END AS INTEGER) AS big_back, user_id AS user_back
FROM events""")

# ---- conform ------------------------------------------------------------------
NULLS = "CAST(NULL AS VARCHAR)"


def user_row(**cols: str) -> str:
    order = ["rowkey", "userid", "name", "name_source", "mail", "phone", "platform", "reg_time", "update_time",
             "password", "salt", "gender", "birthday", "address", "area", "profession", "card", "facebookid", "ip",
             "lives", "race", "status"]
    parts = [f"{cols.get(c, NULLS)} AS {c}" for c in order]
    parts.append(f"CAST({cols.get('is_user', 'NULL')} AS INTEGER) AS is_user")
    return ", ".join(parts)


CONFORMED = f"""conformed AS (
  SELECT {user_row(rowkey="md5(CAST(c_custkey AS VARCHAR)) || '-pa'", userid="CAST(c_custkey AS VARCHAR)",
                   name=name_sql('raw_name'), name_source="'Unknown'", mail=mail_sql('raw_mail'),
                   phone=phone_sql('raw_phone'), platform="'pa'", is_user="1")} FROM dirty
  UNION ALL
  SELECT {user_row(rowkey="md5(CAST(c_custkey AS VARCHAR)) || '-pc'", userid="CAST(c_custkey AS VARCHAR)",
                   name=name_sql('raw_name'), name_source="'Unknown'", mail=mail_sql('raw_mail'),
                   phone=phone_sql('raw_phone'), platform="'pc'", reg_time="c_mktsegment",
                   gender=gender_sql('raw_gender'), birthday="birth.birthday", is_user="1")}
  FROM dirty JOIN birth USING (c_custkey)
  UNION ALL
  SELECT {user_row(rowkey=f"md5({phone_sql('raw_phone', 'NULL')}) || '-pd'", userid=phone_sql('raw_phone', 'NULL'),
                   phone=f"coalesce({phone_sql('raw_phone', 'NULL')}, 'null')", platform="'pd'", is_user="1")}
  FROM dirty
  UNION ALL
  SELECT {user_row(rowkey="md5(CAST(c_custkey AS VARCHAR)) || '-pb'", userid="CAST(c_custkey AS VARCHAR)",
                   name=name_sql('raw_name'), name_source="'Unknown'", mail=mail_sql('raw_mail'),
                   phone=phone_sql('raw_phone'), platform="'pb'", reg_time="CAST(c_nationkey AS VARCHAR)",
                   gender=gender_sql('raw_gender'), birthday="raw_birth", lives="c_mktsegment",
                   status="CASE WHEN c_acctbal >= 0 THEN 'active' ELSE 'negative' END", is_user="1")}
  FROM dirty)"""
CONF_CTES = (DIRTY, birth_cte("dirty", "c_custkey", "raw_birth"), CONFORMED)
sql("conform_users", with_(*CONF_CTES) + "SELECT * FROM conformed")
sql("distinct_users", with_(*CONF_CTES) + "SELECT DISTINCT rowkey, userid, phone, platform FROM conformed")

FAN = ("fan AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in FANOUT_EXPRS.items()) +
       " FROM (SELECT DISTINCT o_custkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey) p "
       "JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)")
FAN_ROWS = f"""fanrows AS (
  SELECT md5(uid) || '-pc' AS u_key, md5(cid) || '-pc' AS c_key, uid AS userid, cid AS contactid, u_is, c_is,
         {name_sql('c_name')} AS name, {phone_sql('u_phone')} AS u_phone_c, {phone_sql('c_phone')} AS c_phone_c
  FROM (SELECT *, CASE WHEN u_is = 1 THEN u_uid ELSE {phone_sql('u_phone', 'NULL')} END AS uid,
               CASE WHEN c_is = 1 THEN c_uid ELSE {phone_sql('c_phone', 'NULL')} END AS cid FROM fan))"""
sql("contact_fanout_edges", with_(FAN, FAN_ROWS) + "SELECT u_key AS u_uid, c_key AS c_uid, name FROM fanrows")
sql("contact_fanout_users", with_(FAN, FAN_ROWS) + f"""
SELECT DISTINCT * FROM (
  SELECT {user_row(rowkey='u_key', userid='userid', phone='u_phone_c', is_user='u_is', platform="'pc'")} FROM fanrows
  UNION ALL
  SELECT {user_row(rowkey='c_key', userid='contactid', phone='c_phone_c', is_user='c_is', name='name',
                   name_source='u_key', platform="'pc'")} FROM fanrows)""")
sql("contact_edges_named", with_(FAN) + f"""
SELECT md5(u_uid) || '-pa' AS u_uid, md5(c_uid) || '-pa' AS c_uid, {name_sql('c_name')} AS name FROM fan""")

# ---- messages -----------------------------------------------------------------
sql("gmsg_dedup", with_(RAW_GMSG) + "SELECT * FROM gmsg")
sql("msg_contacts", with_(RAW_MSG) + 'SELECT DISTINCT party AS u_uid, "user" AS c_uid, name FROM msg')
NAMED = f"""named AS (SELECT DISTINCT {user_row(rowkey='"user"', userid='useruid', name='name', name_source='party',
                                              platform="'pa_message'", is_user='1')}
  FROM msg WHERE name IS NOT NULL AND name <> 'null')"""
sql("msg_named_users", with_(RAW_MSG, NAMED) + "SELECT * FROM named")
PAIR_LATEST = "pl AS (" + PAIR_LATEST_BODY.format(
    content=signin_filter_sql("content"),
    inner="""SELECT m.*, c.count FROM
               (SELECT *, rank() OVER (PARTITION BY "user", party ORDER BY timesent DESC) AS rk
                FROM msg WHERE msgtype = 0) m
               JOIN (SELECT "user", party, count(*) AS count FROM msg WHERE msgtype = 0 GROUP BY 1, 2) c
               USING ("user", party)
             WHERE rk = 1""") + ")"
sql("pair_with_user", with_(RAW_MSG, NAMED, USERS, PAIR_LATEST) + f"""
SELECT pl.*, u.name, u.phone, u.mail FROM pl LEFT JOIN (
  SELECT rowkey, name, {NULLS} AS phone, {NULLS} AS mail FROM users
  UNION ALL SELECT rowkey, name, phone, mail FROM named) u ON u.rowkey = pl.party""")
sql("total_msgs_per_user", with_(RAW_MSG) + """
SELECT "user", count(DISTINCT mid) AS count FROM (SELECT "user", mid FROM msg UNION ALL SELECT party, mid FROM msg)
GROUP BY "user" """)
GROUP_LATEST = """gl AS (
  SELECT g.sender || '-' || (g.platform || '-' || g.gid) AS uuid, g.sender, a.count, g.content, g.timesent, g.media,
         g.platform_msg_id, g.platform, g.platform || '-' || g.gid AS guid
  FROM gmsg g JOIN (SELECT platform, gid, count(*) AS count, max(timesent) AS mx FROM gmsg WHERE msgtype = 1
                    GROUP BY 1, 2) a
  ON g.platform = a.platform AND g.gid = a.gid AND g.timesent = a.mx)"""
sql("group_count_latest", with_(RAW_GMSG, GROUP_LATEST) + "SELECT * FROM gl")
sql("group_with_name", with_(RAW_GMSG, GROUP_LATEST) + """
SELECT gl.*, gi.groupname FROM gl JOIN (SELECT 'conv-' || CAST(conv_id AS VARCHAR) AS groupuid, text AS groupname
                                        FROM conversations WHERE role = 'system') gi ON gi.groupuid = gl.guid""")
sql("group_total", with_(RAW_GMSG) + """
SELECT platform || '-' || gid AS guid, count(*) AS count FROM gmsg GROUP BY platform, gid""")

# ---- resolution -----------------------------------------------------------------
LINKS = f"""links AS (
  SELECT {CUST_KEY} AS org_id, {LINK_CONNECT} AS connect_id FROM customer
  UNION ALL
  SELECT DISTINCT md5(role || '@' || CAST(conv_id AS VARCHAR)) || '-conv', {SENDER_CONNECT} FROM conversations)"""
LINKS_NATION = f"""links_nation AS (
  SELECT {CUST_KEY} AS org_id, 'N' || CAST(c_nationkey AS VARCHAR) AS connect_id FROM customer
  UNION ALL SELECT {SUPP_KEY}, 'N' || CAST(s_nationkey AS VARCHAR) FROM supplier)"""
CONTACTS = """contacts AS (
  SELECT DISTINCT md5(CAST(o_custkey AS VARCHAR)) || '-cust' AS u_uid, md5(CAST(l_suppkey AS VARCHAR)) || '-supp' AS c_uid,
         s_name AS name, o_orderpriority AS platform
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey)"""


def resolved(src: str, col: str, cols: list[str], links: str = "links") -> str:
    sel = ", ".join(f"coalesce(l.connect_id, s.{c}) AS {c}" if c == col else f"s.{c}" for c in cols)
    return f"(SELECT {sel} FROM {src} s LEFT JOIN {links} l ON l.org_id = s.{col})"


USER_COLS = ["userid", "rowkey", "name", "nation", "segment", "platform"]
EDGE_COLS = ["u_uid", "c_uid", "name", "platform"]
MSG_COLS = ["mid", "content", "platform_msg_id", "partyuid", "useruid", "party", '"user"', "timesent", "media",
            "direction", "msgtype", "name", "platform"]
sql("resolve_ids", with_(USERS, LINKS) + "SELECT * FROM " + resolved("users", "rowkey", USER_COLS))
RES_EDGES = "res_edges AS (SELECT * FROM " + resolved(resolved("contacts", "u_uid", EDGE_COLS), "c_uid", EDGE_COLS) + ")"
sql("resolve_edges", with_(CONTACTS, LINKS, RES_EDGES) + "SELECT * FROM res_edges")
sql("resolve_messages", with_(RAW_MSG, LINKS) + """
SELECT concat_ws('-', "user", CAST(timesent AS VARCHAR), platform_msg_id) AS mid, content, platform_msg_id, partyuid,
       useruid, party, "user", timesent, media, direction, msgtype, name, platform
FROM """ + resolved(resolved("msg", '"user"', MSG_COLS).replace('s."user"', 's."user"'), "party", MSG_COLS))
GMSG_COLS = ["mid", "content", "gid", "platform_msg_id", "useruid", "timesent", "media", "msgtype", "platform", "sender"]
sql("resolve_group_messages", with_(RAW_GMSG, LINKS) + "SELECT * FROM " + resolved("gmsg", "sender", GMSG_COLS))

PREFIXES = """prefixes AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS prefix, n_name AS country, r_name AS province,
         CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS code
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '1', n_name, r_name, 'CITY_' || CAST(n_nationkey AS VARCHAR),
         lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '1'
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
REGION = """phones AS (SELECT DISTINCT rowkey, phone, platform FROM conformed WHERE phone IS NOT NULL AND phone <> 'null'),
best AS (SELECT * FROM (SELECT p.rowkey, p.phone, p.platform, x.country, x.province, x.city, x.code,
                               row_number() OVER (PARTITION BY p.rowkey, p.phone, p.platform
                                                  ORDER BY length(x.prefix) DESC) AS rn
                        FROM phones p JOIN prefixes x ON starts_with(p.phone, x.prefix)) WHERE rn = 1),
region AS (SELECT p.rowkey, coalesce(nullif(b.country, ''), 'Unknown') AS country,
                  coalesce(nullif(b.province, ''), 'Unknown') AS province, coalesce(nullif(b.city, ''), 'Unknown') AS city,
                  b.code, p.phone, p.platform
           FROM phones p LEFT JOIN best b ON b.rowkey = p.rowkey AND b.phone = p.phone AND b.platform = p.platform)"""
sql("region_lookup", with_(*CONF_CTES, PREFIXES, REGION) + "SELECT * FROM region")

# ---- profiles -------------------------------------------------------------------
GENERIC = ["mail", "phone", "gender", "birthday", "address", "area", "profession", "card", "facebookid", "ip",
           "lives", "race", "status"]
RUSERS = "rusers AS (SELECT * FROM " + resolved("conformed", "rowkey", [
    "rowkey", "userid", "name", "name_source", "mail", "phone", "platform", "reg_time", "update_time", "password",
    "salt", "gender", "birthday", "address", "area", "profession", "card", "facebookid", "ip", "lives", "race",
    "status", "is_user"]) + ")"
GEN_EV = "gen_ev AS (SELECT DISTINCT * FROM (" + " UNION ALL ".join(
    f"SELECT rowkey, '{a}' AS attr, {a} AS value, platform FROM rusers" for a in GENERIC) + \
    ") WHERE value IS NOT NULL AND value <> 'null' AND rowkey IS NOT NULL)"
SCORE = "CAST(count(*) OVER (PARTITION BY rowkey, attr, value) AS INTEGER) AS score"
PROFILE_CTES = (*CONF_CTES, LINKS, RUSERS)
sql("profile_generic", with_(*PROFILE_CTES, GEN_EV) + f"SELECT *, {SCORE} FROM gen_ev")
sql("profile_name", with_(*PROFILE_CTES) + f"""
SELECT *, {SCORE} FROM (SELECT DISTINCT rowkey, 'name' AS attr, name AS value, name_source AS source_id, platform
                        FROM rusers WHERE name IS NOT NULL AND name <> 'null' AND rowkey IS NOT NULL)""")
sql("profile_accounts", with_(*PROFILE_CTES) + f"""
SELECT *, {SCORE} FROM (SELECT DISTINCT rowkey, 'platform' AS attr, platform AS value, userid, reg_time
                        FROM rusers WHERE platform IS NOT NULL AND platform <> 'null' AND rowkey IS NOT NULL)""")
sql("profile_region", with_(*CONF_CTES, LINKS, PREFIXES, REGION) + f"""
SELECT *, {SCORE} FROM (SELECT DISTINCT rowkey, 'region' AS attr, phone AS value, country, province, city, code, platform
  FROM {resolved('region', 'rowkey', ['rowkey', 'country', 'province', 'city', 'code', 'phone', 'platform'])}
  WHERE phone IS NOT NULL AND phone <> 'null' AND rowkey IS NOT NULL)""")
sql("profile_contacts", with_(CONTACTS, LINKS, RES_EDGES) + f"""
SELECT *, {SCORE} FROM (SELECT DISTINCT u_uid AS rowkey, 'contacts' AS attr, c_uid AS value, name, platform
  FROM res_edges WHERE c_uid IS NOT NULL AND c_uid <> 'null' AND u_uid IS NOT NULL)""")
sql("profile_be_contacts", with_(CONTACTS, LINKS, RES_EDGES) + f"""
SELECT *, {SCORE} FROM (SELECT DISTINCT c_uid AS rowkey, 'be_contacts' AS attr, u_uid AS value, name, platform
  FROM res_edges WHERE u_uid IS NOT NULL AND u_uid <> 'null' AND c_uid IS NOT NULL)""")
sql("contact_counts", with_(CONTACTS, LINKS, RES_EDGES) + """
SELECT rowkey, coalesce(a.contact_count, 0) AS contact_count, coalesce(b.be_contact_count, 0) AS be_contact_count
FROM (SELECT u_uid AS rowkey, count(DISTINCT c_uid) AS contact_count FROM res_edges GROUP BY 1) a
FULL JOIN (SELECT c_uid AS rowkey, count(DISTINCT u_uid) AS be_contact_count FROM res_edges GROUP BY 1) b USING (rowkey)""")



def json_sql(*cols: str) -> str:
    """A struct as JSON text, without the fields that are NULL."""
    parts = ", ".join(f"'\"{c}\":\"' || {c} || '\"'" for c in cols)
    return "'{' || concat_ws(',', " + parts + ") || '}'"


def load_sql(batch: str, absent: int) -> str:
    """Evidence of one load job: the customers that come with it and their contacts."""
    some = DIRTY.replace("FROM customer)", f"FROM customer WHERE c_custkey % 3 <> {absent})")
    known = ("day_contacts AS (SELECT * FROM contacts WHERE u_uid IN (SELECT rowkey FROM dirty))")
    edges = "res_edges AS (SELECT * FROM " + resolved(resolved("day_contacts", "u_uid", EDGE_COLS), "c_uid", EDGE_COLS) + ")"
    ctes = with_(some, *CONF_CTES[1:], LINKS, RUSERS, GEN_EV, PREFIXES, REGION, CONTACTS, known, edges)
    regions = resolved('region', 'rowkey', ['rowkey', 'country', 'province', 'city', 'code', 'phone', 'platform'])
    return f"""SELECT '{batch}' AS batch, rowkey, attr, value, ev FROM ({ctes}
  SELECT rowkey, attr, value, {json_sql('platform')} AS ev FROM gen_ev
  UNION SELECT rowkey, 'name', name, '{{' || concat_ws(',', '"source_id":"' || name_source || '"', '"platform":"' || platform || '"') || '}}'
        FROM rusers WHERE name IS NOT NULL AND name <> 'null'
  UNION SELECT rowkey, 'platform', platform, {json_sql('userid', 'reg_time')} FROM rusers WHERE platform <> 'null'
  UNION SELECT rowkey, 'region', phone, {json_sql('country', 'province', 'city', 'code', 'platform')} FROM {regions}
        WHERE phone <> 'null'
  UNION SELECT u_uid, 'contacts', c_uid, {json_sql('name', 'platform')} FROM res_edges
  UNION SELECT c_uid, 'be_contacts', u_uid, {json_sql('name', 'platform')} FROM res_edges)
WHERE rowkey IS NOT NULL AND value IS NOT NULL"""


sql("load_job_snapshot", f"""
SELECT *, {SCORE} FROM (SELECT rowkey, attr, value, ev, min(batch) AS batch
                        FROM ({load_sql('day1', 2)} UNION ALL {load_sql('day2', 0)}) GROUP BY rowkey, attr, value, ev)""")
MSG_EV = """msg_ev_src AS (SELECT "user" AS rowkey, direction AS platform, media, partyuid AS partner, timesent FROM msg),
stored AS (SELECT DISTINCT * FROM (SELECT rowkey, 'media' AS attr, media AS value, platform FROM msg_ev_src WHERE timesent < 883612800
           UNION ALL SELECT rowkey, 'partner', partner, platform FROM msg_ev_src WHERE timesent < 883612800)
           WHERE value IS NOT NULL AND value <> 'null'),
incoming AS (SELECT DISTINCT * FROM (SELECT rowkey, 'media' AS attr, media AS value, platform FROM msg_ev_src WHERE timesent >= 852076800
           UNION ALL SELECT rowkey, 'partner', partner, platform FROM msg_ev_src WHERE timesent >= 852076800)
           WHERE value IS NOT NULL AND value <> 'null'),
merged AS (SELECT * FROM stored UNION SELECT * FROM incoming)"""
sql("profile_merge", with_(RAW_MSG, MSG_EV) + f"""
SELECT *, {SCORE} FROM merged WHERE rowkey IN (SELECT rowkey FROM incoming)""")
sql("profile_snapshot", with_(RAW_MSG, MSG_EV) + f"SELECT *, {SCORE} FROM merged")
sql("profile_merge_maps", with_(RAW_MSG, MSG_EV) + """
SELECT rowkey, attr, value, string_agg(platform, ',' ORDER BY platform) AS evidence, CAST(count(*) AS INTEGER) AS score
FROM merged WHERE (rowkey, attr) IN (SELECT DISTINCT rowkey, attr FROM incoming) GROUP BY rowkey, attr, value""")
sql("profile_json_roundtrip", with_(*PROFILE_CTES, GEN_EV) + """
SELECT rowkey, attr, value, string_agg(platform, ',' ORDER BY platform) AS evidence, CAST(count(*) AS INTEGER) AS score
FROM gen_ev GROUP BY rowkey, attr, value""")

# ---- matching -------------------------------------------------------------------
TOK = f"""tok AS (SELECT DISTINCT rowkey, attr, value FROM (
  SELECT rowkey, 'phone' AS attr, 'N' || CAST(c_nationkey AS VARCHAR) AS value FROM dirty
  UNION ALL SELECT rowkey, 'name', c_name FROM dirty
  UNION ALL SELECT rowkey, 'name', c_mktsegment FROM dirty
  UNION ALL SELECT rowkey, 'mail', {mail_sql('raw_mail', 'NULL')} FROM dirty
  UNION ALL SELECT u_uid, 'contacts', c_uid FROM contacts) t WHERE value IS NOT NULL AND rowkey IS NOT NULL)"""
BLOCKS = """blocks AS (SELECT DISTINCT value AS gid, rowkey FROM tok WHERE attr = 'phone' AND value IN (
  SELECT value FROM tok WHERE attr = 'phone' GROUP BY value HAVING count(DISTINCT rowkey) > 1))"""
sql("block_keys", with_(DIRTY, CONTACTS, TOK, BLOCKS) + "SELECT gid, rowkey FROM blocks")
sql("comparison_records", with_(DIRTY, CONTACTS, TOK, BLOCKS) + """
SELECT b.gid, t.rowkey, t.attr, t.value FROM blocks b JOIN tok t USING (rowkey)""")


def _part(attr: str, w: int) -> str:
    a, b = f"a_{attr}.vals", f"b_{attr}.vals"
    return (f"coalesce({w} * CAST(len(list_intersect({a}, {b})) AS DOUBLE) "
            f"/ len(list_distinct(list_concat({a}, {b}))), 0)")


WEIGHTS = {"phone": 30, "name": 30, "mail": 20, "contacts": 20}
sql("pair_scores", with_(DIRTY, CONTACTS, TOK) + """,
sets AS (SELECT rowkey, attr, list(value) AS vals FROM tok GROUP BY rowkey, attr),
pairs AS (SELECT DISTINCT a.rowkey AS ra, b.rowkey AS rb FROM tok a JOIN tok b
          ON a.attr = 'phone' AND b.attr = 'phone' AND a.value = b.value AND a.rowkey < b.rowkey),
scored AS (SELECT ra, rb, round(""" + " + ".join(_part(k, w) for k, w in WEIGHTS.items()) + """, 6) AS score
  FROM pairs """ + " ".join(
    f"LEFT JOIN sets a_{k} ON a_{k}.rowkey = ra AND a_{k}.attr = '{k}' "
    f"LEFT JOIN sets b_{k} ON b_{k}.rowkey = rb AND b_{k}.attr = '{k}'" for k in WEIGHTS) + """)
SELECT ra AS rowkey_a, rb AS rowkey_b, score FROM scored WHERE score >= 50""")

# ---- merge ----------------------------------------------------------------------
MERGED_PROFILES = f"""
SELECT 'N' || CAST(c_nationkey AS VARCHAR) AS connect_id, field, rowkey AS org_id, CAST(0 AS INTEGER) AS pos, entry FROM (
  SELECT c_nationkey, rowkey, 'PHONE' AS field, {phone_sql('raw_phone', 'NULL')} AS entry FROM dirty
  UNION ALL SELECT c_nationkey, rowkey, 'MAIL', {mail_sql('raw_mail', 'NULL')} FROM dirty
  UNION ALL SELECT c_nationkey, rowkey, 'NAME', 'name:' || c_name || '|platforms:N' || CAST(c_nationkey AS VARCHAR)
                   || '-cust|score:1' FROM dirty) x WHERE entry IS NOT NULL
UNION ALL
SELECT 'N' || CAST(cn AS VARCHAR), 'CONTACT', u_uid, CAST(row_number() OVER (PARTITION BY u_uid ORDER BY c_uid || '|' || platform) - 1 AS INTEGER),
       'N' || CAST(sn AS VARCHAR) || '|' || platform FROM ce
UNION ALL
SELECT 'N' || CAST(sn AS VARCHAR), 'BE_CONTACT', c_uid, CAST(row_number() OVER (PARTITION BY c_uid ORDER BY u_uid || '|' || platform) - 1 AS INTEGER),
       'N' || CAST(cn AS VARCHAR) || '|' || platform FROM ce
UNION ALL
SELECT 'N' || CAST(sn AS VARCHAR), 'NAME', c_uid, CAST(0 AS INTEGER),
       'name:' || s_name || '|platforms:' || string_agg('N' || CAST(cn AS VARCHAR) || '-cust', ',' ORDER BY u_uid || '-cust')
       || '|score:' || CAST(count(*) AS VARCHAR)
FROM (SELECT DISTINCT c_uid, u_uid, cn, sn, s_name FROM ce) GROUP BY sn, c_uid, s_name
UNION ALL
SELECT connect_id, field, {NULLS}, CAST(0 AS INTEGER), CAST(sum(v) AS VARCHAR) FROM (
  SELECT 'N' || CAST(cn AS VARCHAR) AS connect_id, 'CONTACT_COUNT' AS field, count(DISTINCT c_uid) AS v FROM ce GROUP BY cn, u_uid
  UNION ALL SELECT 'N' || CAST(sn AS VARCHAR), 'BE_CONTACT_COUNT', count(DISTINCT u_uid) FROM ce GROUP BY sn, c_uid
  UNION ALL SELECT 'N' || CAST(c_nationkey AS VARCHAR), 'MSG_COUNT', count(*) FROM raw_msg
            JOIN customer ON "user" = md5(CAST(c_custkey AS VARCHAR)) || '-cust' GROUP BY c_nationkey, "user"
  UNION ALL SELECT 'N' || CAST(s_nationkey AS VARCHAR), 'MSG_COUNT', count(*) FROM raw_msg
            JOIN supplier ON party = md5(CAST(s_suppkey AS VARCHAR)) || '-supp' GROUP BY s_nationkey, party)
GROUP BY connect_id, field"""
CE = f"""ce AS (SELECT e.*, c.c_nationkey AS cn, s.s_nationkey AS sn, s.s_name FROM contacts e
  JOIN customer c ON e.u_uid = {CUST_KEY.replace('c_custkey', 'c.c_custkey')}
  JOIN supplier s ON e.c_uid = {SUPP_KEY.replace('s_suppkey', 's.s_suppkey')})"""
sql("merge_profiles", with_(DIRTY, RAW_MSG, CONTACTS, CE) + MERGED_PROFILES)
sql("rekey_messages", with_(RAW_MSG, LINKS) + """
SELECT CASE WHEN l1.connect_id IS NOT NULL AND l1.connect_id <> m."user"
            THEN l1.connect_id || '-' || CAST(m.timesent AS VARCHAR) || '-' || m.platform_msg_id ELSE m.mid END AS mid,
       m.content, m.platform_msg_id, m.partyuid, m.useruid, coalesce(l2.connect_id, m.party) AS party,
       coalesce(l1.connect_id, m."user") AS "user", m.timesent, m.media, m.direction, m.msgtype, m.name, m.platform
FROM msg m LEFT JOIN links l1 ON l1.org_id = m."user" LEFT JOIN links l2 ON l2.org_id = m.party""")
sql("rekey_edges", with_(CONTACTS, LINKS_NATION) + "SELECT DISTINCT * FROM " +
    resolved(resolved("contacts", "u_uid", EDGE_COLS, "links_nation"), "c_uid", EDGE_COLS, "links_nation"))
sql("link_flatten", f"""
SELECT {CUST_KEY} AS org_id, 'N' || CAST(c_nationkey AS VARCHAR) AS connect_id FROM customer
UNION ALL SELECT {SUPP_KEY}, 'N' || CAST(s_nationkey AS VARCHAR) FROM supplier
UNION SELECT md5(role || '@' || CAST(conv_id AS VARCHAR)) || '-conv', {SENDER_CONNECT} FROM conversations""")
CUST_CELLS = f"""cust_cells AS (
  SELECT * FROM (
    SELECT rowkey, 'PHONE' AS field, {phone_sql('raw_phone', 'NULL')} AS value FROM dirty
    UNION ALL SELECT rowkey, 'MAIL', {mail_sql('raw_mail', 'NULL')} FROM dirty
    UNION ALL SELECT rowkey, 'NAME', 'name:' || c_name || '|platforms:' || rowkey || '-cust|score:1' FROM dirty
    UNION ALL SELECT rowkey, 'RELATION', c_mktsegment FROM dirty
    UNION ALL SELECT u_uid, 'CONTACT', string_agg(c_uid || '|' || platform, chr(2) ORDER BY c_uid || '|' || platform)
              FROM (SELECT DISTINCT u_uid, c_uid, platform FROM contacts) GROUP BY u_uid
    UNION ALL SELECT u_uid, 'CONTACT_COUNT', CAST(count(DISTINCT c_uid) AS VARCHAR) FROM contacts GROUP BY u_uid
    UNION ALL SELECT "user", 'MSG_COUNT', CAST(count(*) AS VARCHAR) FROM raw_msg GROUP BY "user") x
  WHERE value IS NOT NULL)"""
SPLIT_TARGETS = "targets AS (SELECT DISTINCT " + LINK_CONNECT + " AS connect_id FROM customer WHERE c_mktsegment = 'BUILDING')"
sql("split_identity", with_(DIRTY, RAW_MSG, CONTACTS, CUST_CELLS, LINKS, SPLIT_TARGETS) + """
SELECT * FROM cust_cells WHERE rowkey IN (SELECT org_id FROM links WHERE connect_id IN (SELECT connect_id FROM targets))""")
sql("split_identity_links", with_(LINKS, SPLIT_TARGETS) + """
SELECT * FROM links WHERE connect_id NOT IN (SELECT connect_id FROM targets)""")
def cells_sql(rows: str, keys: str, value: str, sep: str, order: str, out: str = "value") -> str:
    """Ordered lists of ``rows`` per ``keys``, 100000 values to a part."""
    return f"""SELECT {keys}, part, string_agg({value}, {sep} ORDER BY rn) AS {out}
FROM (SELECT *, CAST((rn - 1) // 100000 AS INTEGER) AS part
      FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM ({rows})))
GROUP BY {keys}, part"""


sql("id_list_concat", with_(LINKS) + cells_sql("SELECT DISTINCT * FROM links", "connect_id", "org_id", "chr(9)", "org_id", "org_ids"))
sql("phone_platform_lists", with_(*CONF_CTES) + cells_sql(
    "SELECT userid, phone || ':' || platform AS entry FROM conformed WHERE phone IS NOT NULL AND phone <> 'null'",
    "userid", "entry", "','", "entry", "phones"))
sql("packed_profile_cells", "SELECT connect_id, CASE WHEN part = 0 THEN field ELSE field || '#' || CAST(part AS VARCHAR) END AS field, value FROM ("
    + cells_sql(SQL["merge_profiles"], "connect_id, field", "entry", "chr(2)", "org_id, pos, entry") + ")")

# ---- counters -------------------------------------------------------------------
DAILY = """daily_{n} AS (
  SELECT day, {millis} AS time, coalesce(user_count, 0) AS user_count, coalesce(contact_count, 0) AS contact_count,
         coalesce(message_count, 0) AS message_count, coalesce(groupmessage_count, 0) AS groupmessage_count
  FROM (SELECT day, count(*) AS user_count FROM (SELECT DISTINCT day, uid FROM (
          SELECT day, user_id AS uid FROM ev WHERE event_type = 'signup' AND {w}
          UNION ALL SELECT day, user_id FROM ev WHERE event_type = 'purchase' AND {w})) GROUP BY day) u
  FULL JOIN (SELECT day, count(*) AS contact_count FROM (SELECT DISTINCT day, user_id, event_type FROM ev WHERE {w})
             GROUP BY day) c USING (day)
  FULL JOIN (SELECT day, count(*) AS message_count FROM (SELECT DISTINCT day, event_id FROM ev
             WHERE event_type = 'click' AND {w}) GROUP BY day) m USING (day)
  FULL JOIN (SELECT day, count(*) AS groupmessage_count FROM (SELECT DISTINCT day, event_id FROM ev
             WHERE event_type = 'view' AND {w}) GROUP BY day) g USING (day))"""


def daily(n: str, where: str = "TRUE") -> str:
    return DAILY.format(n=n, w=where, millis=MILLIS.format(d="day"))


sql("daily_counters", with_(EV, daily("all")) + "SELECT * FROM daily_all")
sql("cumulative_counters", with_(EV, daily("all")) + f"""
SELECT CAST({BASE_USERS} + coalesce(sum(user_count), 0) AS BIGINT) AS user_count,
       CAST({BASE_CONTACTS} + coalesce(sum(contact_count), 0) AS BIGINT) AS contact_count,
       """ + ", ".join(f"CAST({v} AS BIGINT) AS {k}" for k, v in WEEKLY_CONSTANTS.items()) + f""",
       {MILLIS.format(d="'20240131'")} AS time
FROM daily_all WHERE CAST(time AS BIGINT) > 1705276800000""")
sql("running_counters", with_(EV, daily("all")) + f"""
SELECT *, CAST({BASE_USERS} + sum(user_count) OVER w AS BIGINT) AS total_user_count,
          CAST({BASE_CONTACTS} + sum(contact_count) OVER w AS BIGINT) AS total_contact_count
FROM daily_all WINDOW w AS (ORDER BY CAST(time AS BIGINT) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
sql("detail_count", with_(EV) + """
SELECT 'events' AS data_name, 'click' AS type, count(*) AS count, 'events' AS source, '20240131' AS insert_time
FROM ev WHERE day > '20240120'""")
sql("count_by_type", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
sql("counter_upsert", with_(EV, daily("old", "day < '20240116'"), daily("new", "day >= '20240110'")) + """
SELECT * FROM daily_old WHERE time NOT IN (SELECT time FROM daily_new) UNION ALL SELECT * FROM daily_new""")

# ---- sources --------------------------------------------------------------------
CELL_COLS = ["userid", "name", "mail", "phone", "gender", "birthday", "is_user"]
sql("to_cells", with_(*CONF_CTES) + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT rowkey, 'INFO' AS family, '{c.upper()}' AS qualifier, CAST({c} AS VARCHAR) AS value FROM conformed"
    for c in CELL_COLS) + ") WHERE value IS NOT NULL AND rowkey IS NOT NULL")
sql("from_cells", with_(*CONF_CTES) + "SELECT * FROM (SELECT rowkey, " + ", ".join(f"max({c}) AS {c}" for c in CELL_COLS) +
    " FROM conformed WHERE rowkey IS NOT NULL GROUP BY rowkey) WHERE is_user = 1")
sql("cell_records", with_(USERS) + "SELECT rowkey, upper(name) AS name, CAST(nation AS INTEGER) AS nation FROM users")
sql("lines_to_cells", with_(USERS) + "SELECT rowkey, 'INFO' AS family, 'name' AS qualifier, name AS value FROM users")
sql("subtract_by_key", with_(USERS, LINKS) + "SELECT * FROM users WHERE rowkey NOT IN (SELECT org_id FROM links)")
sql("subtract_rows", with_(RAW_MSG) + """
SELECT l."user", l.party, l.media FROM raw_msg l WHERE NOT EXISTS (
  SELECT 1 FROM raw_msg r WHERE r.msgtype = 1 AND r."user" IS NOT DISTINCT FROM l."user"
    AND r.party IS NOT DISTINCT FROM l.party AND r.media IS NOT DISTINCT FROM l.media)""")

# ---- write / read back ------------------------------------------------------------
sql("partition_roundtrip", with_(*CONF_CTES) + "SELECT *, '20240101' AS time FROM conformed WHERE platform = 'pc'")
sql("csv_roundtrip", with_(USERS) + "SELECT * FROM users")
sql("json_roundtrip", with_(USERS) + "SELECT * FROM users")

# ---- groups, links, one day -----------------------------------------------------
MEMBERS = """members AS (
  SELECT 'conv-' || CAST(conv_id AS VARCHAR) AS groupuid, CAST(conv_id AS VARCHAR) AS groupid,
         role || '@' || CAST(conv_id AS VARCHAR) AS uid, role,
         md5(role || '@' || CAST(conv_id AS VARCHAR)) || '-conv' AS uuid, 'conv' AS platform
  FROM (SELECT DISTINCT conv_id, role FROM conversations))"""
sql("group_members", with_(MEMBERS) + "SELECT * FROM members")
sql("group_info_rows", """
SELECT 'conv-' || CAST(conv_id AS VARCHAR) AS groupuid, CAST(conv_id AS VARCHAR) AS groupid, text AS groupname,
       'system@' || CAST(conv_id AS VARCHAR) AS createruid, CAST(turn AS VARCHAR) AS created, 'conv' AS grouptype,
       md5('system@' || CAST(conv_id AS VARCHAR)) || '-conv' AS createruuid, 'conv' AS platform
FROM conversations WHERE role = 'system'""")
sql("resolve_group_members", with_(MEMBERS, LINKS) + "SELECT * FROM " + resolved(
    "members", "uuid", ["groupuid", "groupid", "uid", "role", "uuid", "platform"]))
sql("rekey_group_messages", with_(RAW_GMSG, LINKS) + "SELECT * FROM " + resolved("gmsg", "sender", GMSG_COLS))
sql("contact_fanout_phone_ids", with_(FAN) + f"""
SELECT md5({phone_sql('u_phone', 'NULL')}) || '-pd' AS u_uid, md5({phone_sql('c_phone', 'NULL')}) || '-pd' AS c_uid,
       {name_sql('c_name')} AS name FROM fan""")
REQUESTS = f"""requests AS (
  SELECT {CUST_KEY} AS org_id, {LINK_CONNECT} AS connect_id, CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS status,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '20240101' ELSE '20240102' END AS insert_time
  FROM customer)"""
sql("pending_links", with_(REQUESTS) + """
SELECT DISTINCT org_id, connect_id FROM requests WHERE status = 1 AND insert_time = '20240101'""")
sql("clear_pending", with_(REQUESTS) + """
SELECT * FROM requests WHERE NOT coalesce(status = 1 AND insert_time = '20240101', false)""")
PA_MSG = RAW_MSG.replace("'-cust'", "'-pa'").replace("'-supp'", "'-pa'").replace("'cust' AS platform",
                                                                                        "'pa' AS platform")
PA_NAMED = NAMED.replace("'pa_message'", "'pa_message'")
PA_FAN = FAN_ROWS.replace("'-pc'", "'-pa'")
sql("platform_day_users", with_(DIRTY, PA_MSG, PA_NAMED, FAN, PA_FAN) + f"""
SELECT DISTINCT *, '20240101' AS time FROM (
  SELECT {user_row(rowkey="md5(CAST(c_custkey AS VARCHAR)) || '-pa'", userid="CAST(c_custkey AS VARCHAR)",
                   name=name_sql('raw_name'), name_source="'Unknown'", mail=mail_sql('raw_mail'),
                   phone=phone_sql('raw_phone'), platform="'pa'", is_user="1")} FROM dirty
  UNION ALL
  SELECT {user_row(rowkey='u_key', userid='userid', phone='u_phone_c', is_user='u_is', platform="'pa'")} FROM fanrows
  UNION ALL
  SELECT {user_row(rowkey='c_key', userid='contactid', phone='c_phone_c', is_user='c_is', name='name',
                   name_source='u_key', platform="'pa'")} FROM fanrows
  UNION ALL SELECT * FROM named)""")
sql("event_props", """
SELECT event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n, round(sum(value), 6) AS total
FROM events GROUP BY 1, 2""")
JOB_LINKS = f"""job_links AS (
  SELECT {CUST_KEY} AS org_id, 'N' || CAST(c_nationkey AS VARCHAR) AS connect_id FROM customer
  UNION SELECT md5(role || '@' || CAST(conv_id AS VARCHAR)) || '-conv', {SENDER_CONNECT} FROM conversations)"""
sql("merge_job_links", with_(JOB_LINKS) + "SELECT * FROM job_links")
sql("merge_job_messages", with_(RAW_MSG, JOB_LINKS) + """
SELECT CASE WHEN l1.connect_id IS NOT NULL AND l1.connect_id <> m."user"
            THEN l1.connect_id || '-' || CAST(m.timesent AS VARCHAR) || '-' || m.platform_msg_id ELSE m.mid END AS mid,
       m.content, m.platform_msg_id, m.partyuid, m.useruid, coalesce(l2.connect_id, m.party) AS party,
       coalesce(l1.connect_id, m."user") AS "user", m.timesent, m.media, m.direction, m.msgtype, m.name, m.platform
FROM msg m LEFT JOIN job_links l1 ON l1.org_id = m."user" LEFT JOIN job_links l2 ON l2.org_id = m.party""")
SECOND_MESSAGES = """
SELECT CASE WHEN l1.connect_id IS NOT NULL THEN l1.connect_id || '-' || CAST(m.timesent AS VARCHAR) || '-' || m.platform_msg_id
            ELSE m.mid END AS mid,
       m.content, m.platform_msg_id, m.partyuid, m.useruid, m.party, coalesce(l1.connect_id, m."user") AS "user", m.timesent,
       m.media, m.direction, m.msgtype, m.name, m.platform
FROM (SELECT msg.* REPLACE (coalesce(f.connect_id, "user") AS "user") FROM msg LEFT JOIN links f ON f.org_id = "user") m
LEFT JOIN (SELECT DISTINCT l.connect_id AS org_id, 'N' || CAST(c_nationkey AS VARCHAR) AS connect_id
           FROM customer JOIN links l ON l.org_id = """ + CUST_KEY + """) l1 ON l1.org_id = m."user\""""
sql("merge_job_messages_second", with_(RAW_MSG, LINKS) + SECOND_MESSAGES)
sql("merge_job_group_messages", with_(RAW_GMSG, JOB_LINKS) + "SELECT * FROM " + resolved("gmsg", "sender", GMSG_COLS, "job_links"))
sql("merge_job_edges", with_(CONTACTS, JOB_LINKS) + "SELECT DISTINCT * FROM " + resolved("contacts", "u_uid", EDGE_COLS, "job_links"))
sql("merge_job_profiles", f"""
SELECT 'N' || CAST(c_nationkey AS VARCHAR) AS connect_id, 'MSG_COUNT' AS field, CAST(NULL AS VARCHAR) AS org_id,
       CAST(0 AS INTEGER) AS pos, CAST(count(*) AS VARCHAR) AS entry FROM customer GROUP BY c_nationkey
UNION ALL
SELECT DISTINCT 'N' || CAST(c_nationkey AS VARCHAR), 'REGION', {LINK_CONNECT}, CAST(0 AS INTEGER), c_mktsegment FROM customer""")
sql("merge_job_archive", f"SELECT {CUST_KEY} AS rowkey, 'MSG_COUNT' AS field, '1' AS value FROM customer WHERE c_acctbal >= 0")
sql("merge_job_requests", f"""SELECT {CUST_KEY} AS org_id, {LINK_CONNECT} AS connect_id, CAST(0 AS INTEGER) AS status,
       '20240101' AS insert_time FROM customer""")
sql("link_tangles", """
SELECT 'k' || CAST(g + x AS VARCHAR) AS org_id, 'k' || CAST(g + 6 AS VARCHAR) AS connect_id
FROM (SELECT DISTINCT o_orderkey - o_orderkey % 7 AS g FROM orders), (VALUES (4), (5)) v(x)
UNION ALL SELECT 'o' || CAST(o_orderkey AS VARCHAR), 'A' || CAST(o_orderkey % 10 AS VARCHAR) FROM orders
UNION ALL SELECT DISTINCT 'B' || CAST(o_orderkey % 10 AS VARCHAR), 'A' || CAST(o_orderkey % 10 AS VARCHAR) FROM orders""")
sql("link_cycles", """
SELECT 'k' || CAST(g + x AS VARCHAR) AS org_id, 'k' || CAST(g + x AS VARCHAR) AS connect_id
FROM (SELECT DISTINCT o_orderkey - o_orderkey % 7 AS g FROM orders), (VALUES (0), (1), (2), (3)) v(x)""")
sql("daily_counters_one_day", with_(
    "ev AS (SELECT *, strftime(ts, '%Y%m%d') AS day FROM events WHERE strftime(ts, '%Y%m%d%H%M%S') LIKE '20240105%')",
    daily("all")) + "SELECT * FROM daily_all")
FAN_USERS = SQL["contact_fanout_users"].split("SELECT DISTINCT * FROM", 1)[1]
sql("partition_commit", with_(*CONF_CTES, FAN, FAN_ROWS) + f"""
SELECT *, '20240101' AS time FROM conformed WHERE platform <> 'pa' OR (mail IS NOT NULL AND mail <> 'null')
UNION ALL SELECT *, '20240101' FROM (SELECT DISTINCT * FROM {FAN_USERS})
UNION ALL SELECT *, '20240102' FROM conformed""")
sql("counter_targets", f"SELECT c.*, target FROM ({SQL['counter_upsert']}) c, (VALUES ('main'), ('dev'), ('test')) t(target)")
sql("daily_counters_late_batch", with_(
    "ev AS (SELECT * REPLACE (CASE WHEN user_id % 97 <> 0 THEN user_id END AS user_id), strftime(ts, '%Y%m%d') AS day FROM events)",
    daily("all")) + "SELECT * FROM daily_all")
sql("split_second_generation", f"""
SELECT {CUST_KEY} AS org_id, 'N' || CAST(c_nationkey AS VARCHAR) AS was, {LINK_CONNECT} AS connect_id FROM customer
WHERE c_nationkey % 2 = 0
UNION ALL SELECT DISTINCT {LINK_CONNECT}, 'N' || CAST(c_nationkey AS VARCHAR), {LINK_CONNECT} FROM customer WHERE c_nationkey % 2 = 0
UNION ALL SELECT {SUPP_KEY}, 'N' || CAST(s_nationkey AS VARCHAR), {SUPP_KEY} FROM supplier WHERE s_nationkey % 2 = 0""")
sql("merge_id_groups", f"""
SELECT org_id, md5(min(org_id) OVER g) || '-group' AS connect_id
FROM (SELECT {CUST_KEY} AS org_id, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0)
WINDOW g AS (PARTITION BY c_nationkey, c_mktsegment) QUALIFY count(*) OVER g > 1""")
sql("rekey_store_after_delete", with_(RAW_MSG, LINKS) + """
SELECT * EXCLUDE (old, is_put) FROM (
  SELECT CASE WHEN l1.connect_id IS NOT NULL AND l1.connect_id <> m."user"
              THEN l1.connect_id || '-' || CAST(m.timesent AS VARCHAR) || '-' || m.platform_msg_id ELSE m.mid END AS mid,
         m.content, m.platform_msg_id, m.partyuid, m.useruid, coalesce(l2.connect_id, m.party) AS party,
         coalesce(l1.connect_id, m."user") AS "user", m.timesent, m.media, m.direction, m.msgtype, m.name, m.platform,
         m.mid AS old, l1.connect_id IS NOT NULL OR l2.connect_id IS NOT NULL AS is_put
  FROM msg m LEFT JOIN links l1 ON l1.org_id = m."user" LEFT JOIN links l2 ON l2.org_id = m.party)
QUALIFY row_number() OVER (PARTITION BY mid ORDER BY is_put DESC, old, content, platform_msg_id, partyuid, useruid, party, "user",
                           timesent, media, direction, msgtype, name, platform) = 1""")
sql("merge_job_drop_sources", f"""
SELECT {CUST_KEY} AS rowkey, 'MSG_COUNT' AS field, '1' AS value FROM customer
UNION ALL SELECT 'N' || CAST(c_nationkey AS VARCHAR), 'MSG_COUNT', CAST(count(*) AS VARCHAR) FROM customer GROUP BY c_nationkey
UNION ALL SELECT 'N' || CAST(c_nationkey AS VARCHAR), 'REGION', string_agg(c_mktsegment, chr(2) ORDER BY org)
FROM (SELECT DISTINCT c_nationkey, c_mktsegment, {LINK_CONNECT} AS org FROM customer) GROUP BY c_nationkey""")
sql("platform_day_contacts", with_(PA_MSG, FAN, PA_FAN) + """
SELECT u_key AS u_uid, c_key AS c_uid, name, '20240101' AS time FROM fanrows
UNION SELECT party, "user", name, '20240101' FROM msg""")
sql("platform_day_messages", with_(PA_MSG) + "SELECT *, '20240101' AS time FROM msg")
sql("platform_day_region", with_("conformed AS (" + SQL["platform_day_users"] + ")", PREFIXES, REGION) + "SELECT *, '20240101' AS time FROM region")

# ---- rows that the plain views lack (``branches``) --------------------------------
sql("msg_dedup_copies", with_(RAW_MSG.replace("AS name FROM raw_msg)", """AS name FROM (
  SELECT * FROM raw_msg UNION ALL SELECT * REPLACE (mid || 'z' AS mid) FROM raw_msg WHERE mid LIKE '%.1'))""")) + "SELECT * FROM msg")
sql("gmsg_dedup_copies", with_(RAW_GMSG.replace("FROM raw_gmsg GROUP BY", """FROM (
  SELECT * FROM raw_gmsg UNION ALL SELECT * REPLACE (mid || 'z' AS mid) FROM raw_gmsg WHERE media = 'user') GROUP BY""")) + "SELECT * FROM gmsg")
HALF_LINKS = f"""links AS (
  SELECT {CUST_KEY} AS org_id, 'N' || CAST(c_nationkey AS VARCHAR) AS connect_id FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT {SUPP_KEY}, 'N' || CAST(s_nationkey AS VARCHAR) FROM supplier)"""
for _name in ("resolve_edges", "resolve_messages", "rekey_messages"):
    sql(f"{_name}_both_ends", SQL[_name].replace(LINKS, HALF_LINKS))
sql("pair_with_user_fanout", with_(RAW_MSG, PAIR_LATEST) + f"""
SELECT pl.*, u.name, u.phone, u.mail FROM pl LEFT JOIN (
  SELECT {SUPP_KEY} AS rowkey, s_name AS name, '9' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS phone, {NULLS} AS mail FROM supplier
  UNION ALL SELECT {SUPP_KEY}, s_name, {NULLS}, s_name || '@x.org' FROM supplier WHERE s_suppkey % 2 = 0) u ON u.rowkey = pl.party""")
THIRDS = """flat AS (
  SELECT "user" AS rowkey, 'media' AS attr, media AS value, direction AS platform, CAST(useruid AS BIGINT) % 3 AS third, msgtype FROM msg
  UNION ALL SELECT "user", 'partner', partyuid, direction, CAST(useruid AS BIGINT) % 3, msgtype FROM msg),
stored AS (SELECT rowkey, attr, value, platform FROM flat WHERE value <> 'null' AND (third = 0 OR third = 1 AND msgtype = 0)),
incoming AS (SELECT rowkey, attr, value, platform FROM flat WHERE value <> 'null' AND (third = 2 OR third = 1 AND msgtype = 1)),
merged AS (SELECT * FROM stored UNION SELECT * FROM incoming)"""
sql("profile_merge_thirds", with_(RAW_MSG, THIRDS) + f"SELECT *, {SCORE} FROM merged WHERE rowkey IN (SELECT rowkey FROM incoming)")
sql("profile_snapshot_thirds", with_(RAW_MSG, THIRDS) + f"SELECT *, {SCORE} FROM merged")
sql("contact_fanout_phone_id_users", with_(FAN) + f"""
SELECT DISTINCT * FROM (
  SELECT {user_row(rowkey=f"md5({phone_sql('u_phone', 'NULL')}) || '-pd'", userid=phone_sql('u_phone', 'NULL'),
                   phone=phone_sql('u_phone'), is_user='1', platform="'pd'")} FROM fan
  UNION ALL
  SELECT {user_row(rowkey=f"md5({phone_sql('c_phone', 'NULL')}) || '-pd'", userid=phone_sql('c_phone', 'NULL'),
                   phone=phone_sql('c_phone'), is_user='0', name=name_sql('c_name'),
                   name_source=f"md5({phone_sql('u_phone', 'NULL')}) || '-pd'", platform="'pd'")} FROM fan)""")
INFO = """info AS (
  SELECT 'conv-' || CAST(conv_id AS VARCHAR) AS groupuid, CAST(conv_id AS VARCHAR) AS groupid,
         'group ' || CAST(conv_id AS VARCHAR) AS groupname, role || '@' || CAST(conv_id AS VARCHAR) AS createruid,
         CAST(turn AS VARCHAR) AS created, 'conv' AS grouptype,
         md5(role || '@' || CAST(conv_id AS VARCHAR)) || '-conv' AS createruuid, 'conv' AS platform
  FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1)"""
sql("resolve_group_info", with_(INFO, LINKS) + "SELECT * FROM " + resolved("info", "createruuid", [
    "groupuid", "groupid", "groupname", "createruid", "created", "grouptype", "createruuid", "platform"]))
sql("resolve_group_statistics", with_(RAW_GMSG, GROUP_LATEST, LINKS) + "SELECT * FROM " + resolved("gl", "sender", [
    "uuid", "sender", "count", "content", "timesent", "media", "platform_msg_id", "platform", "guid"]))
sql("csv_bad_lines", """
SELECT c_custkey AS id, CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_nationkey AS BIGINT) END AS n,
       CASE WHEN c_custkey % 7 = 0 THEN CAST(c_custkey AS VARCHAR) || ',many' END AS _corrupt_record FROM customer""")
REJECTS = f"""people AS (
  SELECT 'people' AS source, CAST(c_custkey AS VARCHAR) AS id, concat_ws(',',
         CASE WHEN coalesce(raw_phone, '') = '' THEN 'no_phone' END,
         CASE WHEN raw_phone <> '' AND {phone_sql('raw_phone', 'NULL')} IS NULL THEN 'bad_phone' END,
         CASE WHEN {name_sql('raw_name', 'NULL')} IS NULL THEN 'no_name' END) AS reasons FROM dirty),
mails AS (
  SELECT 'messages' AS source, CAST(l_orderkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) AS id, concat_ws(',',
         CASE WHEN o_custkey % 11 = 0 THEN 'no_sender' END, CASE WHEN l_suppkey % 13 = 0 THEN 'no_receiver' END) AS reasons
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
flagged AS (SELECT * FROM people UNION ALL SELECT * FROM mails)"""
sql("rejected_rows", with_(DIRTY, REJECTS) + "SELECT * FROM flagged WHERE reasons <> ''")
sql("reject_accounting", with_(DIRTY, REJECTS) + """
SELECT source, count(*) AS rows, count(*) FILTER (reasons = '') AS accepted, count(*) FILTER (reasons <> '') AS rejected,
       count(*) FILTER (reasons = '') AS written FROM flagged GROUP BY source""")
