"""Identity merge: policy merge of profiles, re-keying, link maintenance
(S9, K6, K7, I5-I15, A23-A26, J13, T26).

The reference merges one canonical id at a time with per-row remote reads
and writes. Here every pending link is handled in one plan: profiles,
messages and edges are each one join with the link table plus a
projection, written as a new snapshot. Packed text cells are exploded to
one row per entry (long form) before any join; packing back into one cell
per profile happens only at the output edge (``pack_entries``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import join_key, stable_group_id, unpacked_id
from ..functions.packed import (CELL_ENTRIES, ENTRY_SEP, entries, format_name_entry, list_field, list_position, parse_name_entry,
                                part_field, split_contact_entry)
from ..sources.scratch import store
from .components import connected
from .lists import ordered_cells
from .resolve import pack_columns, resolve_column, resolve_columns, unpack_columns

# Merge policy per packed profile field.
# 0 = concatenate entries, 1 = sum as integers, 2 = entries hold ids to remap.
# RELATION has policy 2 but no handler in the reference, so it is not carried.
MERGE_POLICY = {
    "REGION": 0, "PHONE": 0, "GENDER": 0, "BIRTHDAY": 0, "MAIL": 0, "PLATFORM": 0, "ADDRESS": 0, "WORD_LIST": 0,
    "CONTACT_COUNT": 1, "BE_CONTACT_COUNT": 1, "MSG_COUNT": 1,
    "RELATION": 2, "NAME": 2, "CONTACT": 2, "BE_CONTACT": 2,
}
REMAP_HANDLED = ("NAME", "CONTACT", "BE_CONTACT")


def pending_links(link_requests: DataFrame, insert_time: str) -> DataFrame:
    """Pending (status 1) link rows of one insert time -> (org_id, connect_id)."""
    return (link_requests.filter((F.col("status") == 1) & (F.col("insert_time") == F.lit(insert_time)))
            .select("org_id", "connect_id").distinct())


def clear_pending(link_requests: DataFrame, insert_time: str) -> DataFrame:
    """K7: the link request table without the processed rows (NULL-safe)."""
    done = (F.col("status") == 1) & (F.col("insert_time") == F.lit(insert_time))
    return link_requests.filter(~F.coalesce(done, F.lit(False)))


def explode_cells(profiles: DataFrame) -> DataFrame:
    """Packed cells (rowkey, field, value) -> entries (rowkey, field, pos, entry); ``pos`` runs on over a list's cells."""
    return profiles.select("rowkey", "field", F.posexplode(entries("value")).alias("pos", "entry")).select(
        "rowkey", list_field("field").alias("field"), list_position("field", "pos").alias("pos"), "entry")


def _remap_name_entries(e: DataFrame, links: DataFrame) -> DataFrame:
    """NAME entries (F23): every ``source_id-platform`` source gets its canonical id.

    Sources are split at the last dash, so a dashed row key works as a
    source id; the reference's ids have exactly one dash, where both agree.
    An entry lists at most ``CELL_ENTRIES`` sources (a longer list is several
    entries of the name), so its sources are gathered again by entry.
    """
    at = ["org_id", "connect_id", "field", "pos"]
    parsed = e.select(*at, parse_name_entry("entry").alias("p")).select(*at, "p.name", "p.score", F.posexplode("p.sources").alias("spos", "s"))
    res = resolve_columns(parsed.select(*at, "name", "score", "spos", "s.source_id", "s.platform"), links, ["source_id"], ["org_id"])
    listed = F.array_sort(F.collect_list(F.struct("spos", "source_id", "platform")))
    return res.groupBy(*at, "name", "score").agg(listed.alias("sources")).select(
        *at, format_name_entry("name", "sources", "score").alias("entry"))


def _remap_bar_entries(e: DataFrame, links: DataFrame) -> DataFrame:
    """CONTACT / BE_CONTACT entries ``id|rest`` (F24): the id gets its canonical id."""
    parts = e.select("org_id", "connect_id", "field", "pos", split_contact_entry("entry").alias("p")).select(
        "org_id", "connect_id", "field", "pos", F.col("p.id").alias("eid"), "p.rest")
    res = resolve_columns(parts, links, ["eid"], ["org_id"])
    return res.select("org_id", "connect_id", "field", "pos",
                      F.concat("eid", F.coalesce(F.concat(F.lit("|"), "rest"), F.lit(""))).alias("entry"))


def merge_profiles(profiles: DataFrame, links: DataFrame, policy: dict[str, int] | None = None,
                   rekey: DataFrame | None = None) -> DataFrame:
    """Merge the packed profiles of all linked ids into their canonical id.

    ``rekey`` maps the ids inside entries (default: ``links``).

    ``profiles``: (rowkey, field, value) cells. Returns long rows
    (connect_id, field, org_id, pos, entry): one per concatenated or
    remapped entry, in (org_id, pos) order, and one per summed field with
    ``org_id`` NULL. Fields without a policy are dropped.
    """
    policy, rekey = policy or MERGE_POLICY, links if rekey is None else rekey
    lk = links.select("org_id", "connect_id")
    # Three branches read the cells of the linked ids: written once, not built for each of them.
    members = store(profiles.join(lk, profiles["rowkey"] == lk["org_id"], "inner").drop("rowkey"), "members")
    concat_fields = [f for f, p in policy.items() if p == 0]
    sum_fields = [f for f, p in policy.items() if p == 1]
    cells = members.select("org_id", "connect_id", F.col("field").alias("cell"), list_field("field").alias("field"), "value")
    at = list_position("cell", "pos").alias("pos")

    plain = cells.filter(F.col("field").isin(concat_fields)).select(
        "connect_id", "field", "cell", "org_id", F.posexplode(entries("value")).alias("pos", "entry")).select(
        "connect_id", "field", "org_id", at, "entry")

    exploded = cells.filter(F.col("field").isin(list(REMAP_HANDLED))).select(
        "org_id", "connect_id", "field", "cell", F.posexplode(entries("value")).alias("pos", "entry")).select(
        "org_id", "connect_id", "field", at, "entry")
    names = _remap_name_entries(exploded.filter(F.col("field") == "NAME"), rekey)
    bars = _remap_bar_entries(exploded.filter(F.col("field").isin("CONTACT", "BE_CONTACT")), rekey)
    remapped = names.unionByName(bars).select("connect_id", "field", "org_id", "pos", "entry")

    sums = (cells.filter(F.col("field").isin(sum_fields))
            .groupBy("connect_id", "field")
            .agg(F.sum(F.col("value").try_cast("long")).cast("string").alias("entry"))
            .select("connect_id", "field", F.lit(None).cast("string").alias("org_id"),
                    F.lit(0).alias("pos"), "entry"))
    return plain.unionByName(remapped).unionByName(sums)


def pack_entries(merged: DataFrame, max_entries: int = CELL_ENTRIES) -> DataFrame:
    """A25, output edge: long merged rows -> packed cells (connect_id, field,
    value), entries in (org_id, pos) order joined by \\x02. What a list has
    beyond ``max_entries`` goes on in the fields ``<field>#1``, ``<field>#2``, ..."""
    cells = ordered_cells(merged, ["connect_id", "field"], "entry", ENTRY_SEP, max_entries, order=["org_id", "pos"])
    return cells.select("connect_id", part_field("field", "part").alias("field"), "value")


def _rekeyed(messages: DataFrame, links: DataFrame) -> DataFrame:
    """The messages with both ends resolved, beside ``__moved`` (an end changed) and ``__old`` (the mid before).

    Ids travel as bytes. A mid that is its own columns joined does not travel: it is joined again at the end.
    """
    ids = ["user", "party", "mid"]
    text = all(x.schema[c].dataType == T.StringType() for x, cs in ((messages, ids), (links, ["org_id", "connect_id"])) for c in cs)
    lk = pack_columns(links, ["org_id", "connect_id"] if text else [])
    back = unpacked_id if text else F.col

    def rebuilt(user):
        return join_key(user, "timesent", "platform_msg_id")
    own = F.coalesce(F.col("mid") == rebuilt("user"), F.lit(False))
    r = pack_columns(messages.withColumns({"__own": own, "mid": F.when(~own, F.col("mid"))}), ids if text else [])
    r = resolve_column(r, lk, "user", out="__user")
    sent = F.coalesce(F.col("__user") != F.col("user"), F.lit(False))
    r = r.withColumns({"__sent": sent, "__from": F.when(sent, F.col("user")), "user": F.col("__user")}).drop("__user")
    r = resolve_column(r, lk, "party", out="__party")
    got = F.coalesce(F.col("__party") != F.col("party"), F.lit(False))
    old = F.when(F.col("__own"), rebuilt(F.coalesce(back("__from"), back("user")))).otherwise(back("mid"))
    mid = F.when(F.col("__own") | F.col("__sent"), rebuilt(back("user"))).otherwise(back("mid"))
    cols = {"mid": mid, "user": back("user"), "party": back("__party")}
    return r.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in messages.columns],
                    (F.col("__sent") | got).alias("__moved"), old.alias("__old"))


def rekey_messages(messages: DataFrame, links: DataFrame) -> DataFrame:
    """Sender linked -> ``user`` and ``mid`` change (old row replaced);
    receiver linked -> ``party`` changes, mid kept. Applies to all messages
    of linked ids (D22)."""
    return _rekeyed(messages, links).select(*messages.columns)


def rekey_changes(messages: DataFrame, links: DataFrame, seq: int) -> DataFrame:
    """I7 as a change set for the message store (K6): a message whose sender
    moved is deleted under its old mid and put under the new one, one whose
    receiver moved is put again. Two messages that get one mid leave one row
    (``changes.merged`` with ties by ``replaces``, the old mid). Rows without a
    mid are not in the store."""
    from ..sources.changes import change_set, puts, tombstones
    new = store(_rekeyed(messages.filter("mid IS NOT NULL"), links).filter("__moved").drop("__moved")
                .withColumnRenamed("__old", "replaces"), "rekeyed")  # puts and tombstones read it
    gone = new.filter("mid != replaces").select(F.col("replaces").alias("mid"))
    return change_set(puts(new, seq), tombstones(gone, ["mid"], seq))


def profile_changes(profiles: DataFrame, moved: DataFrame, merged: DataFrame, seq: int) -> DataFrame:
    """I6 with I15's ``drop_sources`` as a change set for the cell store: the
    merged cells are put under their canonical id, the cells of the ids that
    moved are deleted."""
    from ..sources.changes import change_set, puts, tombstones
    cells = pack_entries(merged).withColumnRenamed("connect_id", "rowkey")
    gone = profiles.join(moved.select(F.col("org_id").alias("rowkey")).distinct(), "rowkey", "left_semi")
    return change_set(puts(cells, seq), tombstones(gone, ["rowkey", "field"], seq))


def rekey_group_messages(group_messages: DataFrame, links: DataFrame) -> DataFrame:
    """I8: group-message sender -> canonical id."""
    return resolve_column(group_messages, links, "sender")


def rekey_edges(edges: DataFrame, links: DataFrame, drop_self: bool = False) -> DataFrame:
    """I10/I11 (K6): both ends of every edge -> canonical id; duplicates
    collapse. The contact and be-contact views are projections of the same
    edges, so re-keying the edges re-keys both."""
    r = resolve_columns(edges, links, ["u_uid", "c_uid"]).distinct()
    return r.filter(F.col("u_uid") != F.col("c_uid")) if drop_self else r


def packed_contacts(edges: DataFrame, reverse: bool | None = False, max_entries: int = CELL_ENTRIES) -> DataFrame:
    """Derive CONTACT (``reverse``: BE_CONTACT, None: both) cells from edges: ``id|platform`` entries, in parts as
    ``pack_entries`` writes them."""
    def entry(own, other, field):
        return edges.select(F.col(own).alias("rowkey"), F.lit(field).alias("field"),
                            F.concat(F.col(other), F.lit("|"), F.col("platform")).alias("entry"))
    sides = [entry("c_uid", "u_uid", "BE_CONTACT")] * (reverse is not False) + [entry("u_uid", "c_uid", "CONTACT")] * (not reverse)
    e = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    cells = ordered_cells(e, ["rowkey", "field"], "entry", ENTRY_SEP, max_entries, distinct=True)
    return cells.select("rowkey", part_field("field", "part").alias("field"), "value")


def packed_names(sources: DataFrame, max_entries: int = CELL_ENTRIES) -> DataFrame:
    """NAME cells (rowkey, field, value) from distinct (rowkey, name, source), where a source is ``id-platform`` and the
    score the number of a name's sources. A name with more than ``max_entries`` sources has several entries."""
    key = ["rowkey", "name"]
    sources = store(sources, "sources")  # counted and listed below
    score = sources.groupBy(*key).agg(F.count(F.lit(1)).cast("string").alias("score"))
    lists = ordered_cells(sources, key, "source", ",", max_entries, out="platforms").join(score, key)
    named = lists.select("rowkey", "part", F.col("name"), F.concat(
        F.lit("name:"), "name", F.lit("|platforms:"), "platforms", F.lit("|score:"), "score").alias("entry"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("name", "part", "entry"))), lambda x: x["entry"])
    return named.groupBy("rowkey").agg(F.array_join(listed, ENTRY_SEP).alias("value")).select(
        "rowkey", F.lit("NAME").alias("field"), "value")


def close_links(stored: DataFrame, new: DataFrame) -> dict[str, DataFrame]:
    """``links``, ``cycles`` and ``rekey`` after adding ``new`` links to ``stored`` ones.

    Connected components of all links, to a true fixed point. A stored link
    whose original is linked anew is superseded; several new links of one
    original are all kept, so they join their groups. The canonical id of a
    component is its end (an id that is not linked onward; the smallest of
    several). A component without an end holds a cycle of some length: its
    ids are in ``cycles``, linked to themselves, and nothing else has them.

    ``rekey`` maps every id to its canonical id; ``links`` is the stored form
    of it, without the old canonical ids. A link to itself says nothing and is
    left out.
    """
    cur = (stored.select("org_id", "connect_id").join(new.select("org_id").distinct(), on="org_id", how="left_anti")
           .unionByName(new.select("org_id", "connect_id")).filter("org_id != connect_id").distinct())
    cur = store(cur, "links")
    nodes = connected(cur, "org_id", "connect_id")
    ends = nodes.join(cur.select(F.col("org_id").alias("node")).distinct(), "node", "left_anti")
    canonical = store(ends.groupBy("label").agg(F.min("node").alias("connect_id")), "canonical")
    named = store(nodes.join(canonical, "label", "left").select(F.col("node").alias("org_id"), "connect_id"), "named")
    rekey = named.filter("org_id != connect_id")
    # Old canonical ids that were linked again are no longer originals.
    canon_old = stored.select(F.col("connect_id").alias("org_id")).distinct()
    cycles = named.filter("connect_id IS NULL").select("org_id", F.col("org_id").alias("connect_id"))
    return {"links": rekey.join(canon_old, on="org_id", how="left_anti"), "cycles": cycles, "rekey": rekey}


def flatten_links(stored: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, cycles) of ``close_links``."""
    closed = close_links(stored, new)
    return closed["links"], closed["cycles"]


def connect_to_orgs(links: DataFrame, sep: str = "\t", max_entries: int = CELL_ENTRIES) -> DataFrame:
    """A23 / I12 output edge: canonical id -> its originals as sorted text.

    The long (connect_id, org_id) link table is what every join uses; this
    text form is only the stored cell format, ``max_entries`` originals to a part."""
    return ordered_cells(links.select("connect_id", "org_id").distinct(), ["connect_id"], "org_id", sep,
                          max_entries, out="org_ids")


def merge_ids(spark, ids: list[str]) -> DataFrame:
    """Links for merging a short id list given by hand under a repeatable
    new id; ``forest.merge_groups`` takes the groups as a table."""
    df = spark.createDataFrame([(i,) for i in ids], "org_id string")
    gid = stable_group_id(F.array(*[F.lit(i) for i in ids]))
    return df.select("org_id", gid.alias("connect_id"))


def split_identity(archive: DataFrame, links: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """I14 (our definition): undo the merge of the canonical ids in ``targets``
    (a ``connect_id`` column): their archived original profiles are restored
    and their links dropped. Returns (restored profile rows, remaining links)."""
    t = targets.select("connect_id").distinct()
    mine = links.join(t, on="connect_id", how="left_semi").select(F.col("org_id").alias("rowkey"))
    restored = archive.join(mine, on="rowkey", how="left_semi")
    remaining = links.join(t, on="connect_id", how="left_anti")
    return restored, remaining


def archive_originals(profiles: DataFrame, links: DataFrame) -> DataFrame:
    """I12 archive: profile rows of every id being merged (kept in the profile
    table too, I15)."""
    return profiles.join(links.select(F.col("org_id").alias("rowkey")).distinct(), on="rowkey", how="left_semi")


def sum_fields(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Integer sums of text counters per canonical id."""
    return df.groupBy(key).agg(*[F.sum(F.col(c).try_cast("long")).alias(c) for c in columns])
