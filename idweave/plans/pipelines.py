"""Pipelines a user calls (T-series): compositions of operators.

Each returns DataFrames; writing them is the caller's choice (see
``sources.sinks.write_partitions``) so one plan runs from scan to write.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaners import is_present, signin_name
from ..functions.ids import join_key, key_part, rowkey
from ..operators.conform import to_user_model
from ..operators.dedup import dedup_keep_min, distinct_rows, spread_distinct
from ..operators.resolve import pack_columns, unpack_columns
from ..schemas import GROUP_MESSAGE_COLUMNS, MESSAGE_COLUMNS

MSG_DEDUP_BY = ["content", "platform", "partyuid", "useruid", "user", "party", "media", "direction",
                "msgtype", "name", "timesent"]
EDGE_IDS = ["u_uid", "c_uid"]
GMSG_DEDUP_BY = ["content", "gid", "useruid", "timesent", "media", "msgtype", "platform"]


SOURCE_DEDUP_BY = ["useruid", "partyuid", "timesent", "mtext", "media", "direction", "msgtype"]


def message_rows(src: DataFrame, user_platform: str, party_platform: str, platform: str,
                 null_token: str = "null") -> DataFrame:
    """T8 map step: source rows -> message rows with hashed ends, the message
    id ``user-timesent-token`` (NULL where the sender is, never a shifted id)
    and the sign-in name."""
    user = rowkey("useruid", user_platform)
    return src.select(
        join_key(user, "timesent", "messagetoken").alias("mid"),
        F.col("mtext").alias("content"), "partyuid", "useruid",
        rowkey("partyuid", party_platform).alias("party"), user.alias("user"), "timesent", "media",
        "direction", "msgtype", signin_name("mtext", null_token).alias("name"), F.lit(platform).alias("platform"))


def clean_messages(raw: DataFrame) -> DataFrame:
    """T8 (A3 + F16): one message per distinct content/ends/time, smallest
    mid kept; ``platform_msg_id`` is the 4th dash part of the mid."""
    d = dedup_keep_min(raw, "mid", MSG_DEDUP_BY)
    return d.select(*[key_part("mid", 3).alias(c) if c == "platform_msg_id" else F.col(c)
                      for c in MESSAGE_COLUMNS], "platform")


def clean_messages_from_source(src: DataFrame, user_platform: str, party_platform: str, platform: str,
                               null_token: str = "null") -> DataFrame:
    """T8 from the platform's source rows, de-duplicated *before* deriving keys.

    ``user``, ``party``, ``name`` and ``platform`` are functions of the raw
    columns, and within a group ``min(mid) = user-timesent-min(token)``, so
    grouping on the narrow raw columns gives exactly the groups and ids of
    ``clean_messages`` while the shuffle carries short ids instead of two
    hashed keys, a name and a message id per row. Tokens must be non-NULL.
    """
    d = src.groupBy(*SOURCE_DEDUP_BY).agg(F.min("messagetoken").alias("messagetoken"))
    rows_ = message_rows(d, user_platform, party_platform, platform, null_token)
    return rows_.select(*[key_part("mid", 3).alias(c) if c == "platform_msg_id" else F.col(c)
                          for c in MESSAGE_COLUMNS], "platform")


def message_contacts(messages: DataFrame, packed: bool = False) -> DataFrame:
    """T8 (A5): contact edges implied by messages: receiver knows sender; ``packed``: with ids as bytes."""
    edges = messages.select(F.col("party").alias("u_uid"), F.col("user").alias("c_uid"), "name")
    return distinct_rows(pack_columns(edges, EDGE_IDS) if packed else edges)


def message_named_users(messages: DataFrame, platform: str = "pa_message",
                        null_token: str = "null") -> DataFrame:
    """T8 (P4 + A4): a user row for each name seen in a sign-in message."""
    named = messages.filter(is_present("name", null_token)).select(
        F.col("user").alias("rowkey"), F.col("useruid").alias("userid"), "name",
        F.col("party").alias("name_source"))
    return distinct_rows(to_user_model(named, platform=platform, is_user=1))


def platform_day(users_src: DataFrame, spec, contacts_src: DataFrame | None = None,
                 message_src: DataFrame | None = None, prefixes: DataFrame | None = None,
                 time: str | None = None, platform_suffixes: tuple[str, str] = ("", ""),
                 null_token: str = "null") -> dict[str, DataFrame]:
    """Every output of one platform's day, as lazy DataFrames.

    ``users`` gathers all user rows written for the day (conformed users,
    the two fan-out user sets of contact rows, users named by sign-in
    messages); ``contacts`` all edges; ``messages`` the cleaned messages;
    ``region`` the phone enrichment. Each gets ``time`` when given, ready
    for ``sources.sinks.write_partitions``. Nothing runs until written.
    """
    from ..operators.conform import conform_users, contact_fanout
    from ..operators.enrich import region_lookup

    out: dict[str, DataFrame] = {}
    users = conform_users(users_src, spec)
    contacts = None
    if contacts_src is not None:
        edges, fan_users = contact_fanout(contacts_src, spec.platform, null_token)
        users = users.unionByName(fan_users)
        # Distinct as the messages' edges are: both are keyed alike, and their union needs no exchange of its own.
        contacts = distinct_rows(pack_columns(edges, EDGE_IDS))
    if message_src is not None:
        up, pp = platform_suffixes
        msgs = clean_messages_from_source(message_src, up or spec.platform, pp or spec.platform, spec.platform,
                                          null_token)
        out["messages"] = msgs
        users = users.unionByName(message_named_users(msgs, spec.platform + "_message", null_token))
        mc = message_contacts(msgs, packed=True)
        contacts = mc if contacts is None else contacts.unionByName(mc)
    out["users"] = spread_distinct(users)
    if contacts is not None:
        out["contacts"] = unpack_columns(contacts.distinct(), EDGE_IDS)
    if prefixes is not None:
        # Its phones are distinct anyhow, so it reads the rows before they are, and of these three columns only.
        out["region"] = region_lookup(users, prefixes, null_token=null_token)
    if time is not None:
        out = {k: v.withColumn("time", F.lit(time)) for k, v in out.items()}
    return out


def load_evidence(users: DataFrame, edges: DataFrame, regions: DataFrame, links: DataFrame, null_token: str = "null",
                  distinct: bool = True) -> DataFrame:
    """Resolve ids (J1, J2) and build all evidence (A17-A22): distinct long rows (rowkey, attr, value, ev).

    ``ev`` is JSON text, so every attribute shares one schema. ``distinct=False`` leaves it to the caller to make rows
    of several parts distinct (those of one part are).
    """
    from ..operators import profiles as P
    from ..operators.resolve import resolve_column, resolve_columns

    ru = resolve_column(users, links, "rowkey")
    rr = resolve_column(regions, links, "rowkey")
    re_ = resolve_columns(edges, links, ["u_uid", "c_uid"])
    parts = [P.generic_evidence(ru, null_token=null_token), P.name_evidence(ru, null_token),
             P.account_evidence(ru, null_token=null_token), P.region_evidence(rr, null_token),
             P.contact_evidence(re_, null_token=null_token), P.contact_evidence(re_, True, null_token)]
    ev = parts[0].select("rowkey", "attr", "value", F.to_json("ev").alias("ev"))
    for p in parts[1:]:
        ev = ev.unionByName(p.select("rowkey", "attr", "value", F.to_json("ev").alias("ev")))
    return ev.distinct() if distinct else ev


def load_job(store, users: DataFrame, edges: DataFrame, regions: DataFrame, links: DataFrame, batch: str,
             null_token: str = "null") -> DataFrame:
    """Add one batch's evidence to an ``EvidenceStore``; the scored new state."""
    # The store makes rows distinct in its buckets, with the one exchange that brings them there.
    store.add(load_evidence(users, edges, regions, links, null_token, distinct=False), batch)
    return store.scored()


def load_profiles(users: DataFrame, edges: DataFrame, regions: DataFrame, links: DataFrame,
                  stored: DataFrame | None = None, null_token: str = "null") -> DataFrame:
    """T16-T18 and, given the stored evidence, the new stored state (N5) as one snapshot: scored long evidence."""
    from ..operators import profiles as P

    ev = load_evidence(users, edges, regions, links, null_token)
    if stored is not None:
        ev = P.merge_evidence(stored.select("rowkey", "attr", "value", "ev"), ev, snapshot=True)
    return P.score(ev)


class Outputs(Mapping):
    """Outputs by name, each built when it is first asked for."""

    def __init__(self, **build: Callable[[], DataFrame]):
        self._build, self._built = build, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._build)

    def __len__(self) -> int:
        return len(self._build)


def identity_merge_job(profiles_cells: DataFrame | Callable[[], DataFrame], messages: DataFrame, group_messages: DataFrame,
                       edges: DataFrame, stored_links: DataFrame, link_requests: DataFrame,
                       insert_time: str, drop_sources: bool = False) -> Mapping[str, DataFrame]:
    """T26 (I5-I12, K7): process every pending link of ``insert_time`` in one plan.

    Only ids that a pending link names give up their profile: an original its
    own cells, an old canonical id (C1 in C1 -> C2) the cells gathered under it
    since its merge; originals merged earlier are not merged twice. Messages,
    group messages, edges and ids inside entries are re-keyed with the whole
    closure, old canonical ids included. Originals are archived, old canonical
    ids are not. Merged rows stay in the profile table (I15); with
    ``drop_sources`` the output ``profile_changes`` is a change set for it that
    also deletes them.

    Each output is built when it is asked for; ``profiles_cells`` may be a function, called by the outputs that read
    the cells, so that the others do not wait for a derived cell table.
    """
    from ..operators import merge as M

    pending = M.pending_links(link_requests, insert_time)
    closed = M.close_links(stored_links, pending)
    rekey, named = closed["rekey"], pending.select("org_id").distinct()
    moved = rekey.join(named, on="org_id", how="left_semi")
    originals = named.join(stored_links.select(F.col("connect_id").alias("org_id")), on="org_id", how="left_anti")
    @cache
    def cells() -> DataFrame:
        return profiles_cells() if callable(profiles_cells) else profiles_cells

    @cache
    def profiles() -> DataFrame:
        return M.merge_profiles(cells(), moved, rekey=rekey)
    changes = {"profile_changes": lambda: M.profile_changes(cells(), moved, profiles(), 1)} if drop_sources else {}
    return Outputs(
        profiles=profiles, **changes,
        archive=lambda: M.archive_originals(cells(), originals),
        messages=lambda: M.rekey_messages(messages, rekey),
        group_messages=lambda: M.rekey_group_messages(group_messages, rekey),
        edges=lambda: M.rekey_edges(edges, rekey),
        links=lambda: closed["links"],
        link_cycles=lambda: closed["cycles"],
        requests=lambda: M.clear_pending(link_requests, insert_time))


def clean_group_messages(raw: DataFrame) -> DataFrame:
    """T9 (A3 + F16) on group messages; ``sender`` is the resolved sender id."""
    d = dedup_keep_min(raw, "mid", GMSG_DEDUP_BY)
    return d.select(*[key_part("mid", 3).alias(c) if c == "platform_msg_id" else F.col(c)
                      for c in GROUP_MESSAGE_COLUMNS], "platform",
                    F.col("useruid").alias("sender"))
