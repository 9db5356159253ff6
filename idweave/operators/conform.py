"""Conform source rows to the user / contact model.

A platform is described as data — which source column feeds which model
column and which cleaner applies — and one generic function turns it into a
single projection. No row-level Python runs; the whole conform step is one
``select`` inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaners import clean_birth, clean_gender, clean_mail, clean_name, clean_phone
from ..functions.ids import rowkey as make_rowkey
from ..schemas import SECRET_COLUMNS, USER_COLUMNS, USER_SCHEMA
from .dedup import spread_distinct


def to_user_model(df: DataFrame, platform: str | Column | None = None, is_user: int | Column | None = None,
                  keep_secrets: bool = False) -> DataFrame:
    """Project to the 23 user-model columns; absent columns are typed NULLs.

    Secret columns are always NULL unless ``keep_secrets``.
    """
    types = {f.name: f.dataType for f in USER_SCHEMA.fields}
    given = {"platform": platform, "is_user": is_user}
    cols = []
    for name in USER_COLUMNS:
        if name in SECRET_COLUMNS and not keep_secrets:
            cols.append(F.lit(None).cast(types[name]).alias(name))
        elif name in df.columns:
            cols.append(F.col(name).cast(types[name]).alias(name))
        elif given.get(name) is not None:
            v = given[name]
            cols.append((v if isinstance(v, Column) else F.lit(v)).cast(types[name]).alias(name))
        else:
            cols.append(F.lit(None).cast(types[name]).alias(name))
    return df.select(*cols)


@dataclass
class PlatformSpec:
    """How one platform's user table maps to the model.

    ``columns`` maps a model column to a source column name or Column;
    ``cleaners`` maps a model column to a ``Column -> Column`` cleaner
    applied after the mapping. ``id_column`` feeds both ``userid`` and the
    row key ``md5(id)-platform``.
    """

    platform: str
    id_column: str | Column
    columns: dict[str, str | Column] = field(default_factory=dict)
    cleaners: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    constants: dict[str, object] = field(default_factory=dict)
    is_user: int = 1


def conform_users(src: DataFrame, spec: PlatformSpec) -> DataFrame:
    """One projection from source columns to the user model."""
    def as_col(x):
        return F.col(x) if isinstance(x, str) else x

    mapped: dict[str, Column] = {k: as_col(v) for k, v in spec.columns.items()}
    for k, fn in spec.cleaners.items():
        mapped[k] = fn(mapped[k])
    ident = mapped.pop("userid", None)
    ident = ident if ident is not None else as_col(spec.id_column).cast("string")
    out = [ident.cast("string").alias("userid"), make_rowkey(ident, spec.platform).alias("rowkey")]
    out += [v.alias(k) for k, v in mapped.items()]
    out += [F.lit(v).alias(k) for k, v in spec.constants.items()]
    return to_user_model(src.select(*out), platform=spec.platform, is_user=spec.is_user)


def contact_edges(src: DataFrame, platform: str, owner: str, contact: str,
                  name: str | Column | None = None, null_token: str = "null") -> DataFrame:
    """T5: (u_uid, c_uid, name) edges with hashed ids; a missing name is the token."""
    nm = clean_name(name if isinstance(name, Column) else F.col(name), null_token) if name is not None \
        else F.lit(null_token)
    return src.select(make_rowkey(F.col(owner).cast("string"), platform).alias("u_uid"),
                      make_rowkey(F.col(contact).cast("string"), platform).alias("c_uid"),
                      nm.alias("name"))


def contact_fanout(src: DataFrame, platform: str, null_token: str = "null",
                   phone_ids: bool = False) -> tuple[DataFrame, DataFrame]:
    """T6/T7 (P10 + P12 + A4): contact rows -> edges and two sets of user rows.

    Input columns: ``u_uid, u_phone, u_is, c_uid, c_phone, c_is, c_name``
    (``phone_ids=True``: the phone *is* the id, T7). An id is the platform
    id when the side is a registered user (``*_is == 1``), else its cleaned
    phone. Returns (edges, users); users are de-duplicated.
    """
    u_phone = clean_phone("u_phone", null_token)
    c_phone = clean_phone("c_phone", null_token)
    # Ids use NULL for a missing phone: a bad phone gives a NULL key (a reject),
    # never one key shared by every bad phone.
    u_pid, c_pid = clean_phone("u_phone"), clean_phone("c_phone")
    if phone_ids:
        userid, contactid = u_pid, c_pid
        u_is, c_is = F.lit(1), F.lit(0)
    else:
        userid = F.when(F.col("u_is") == 1, F.col("u_uid")).otherwise(u_pid)
        contactid = F.when(F.col("c_is") == 1, F.col("c_uid")).otherwise(c_pid)
        u_is, c_is = F.col("u_is"), F.col("c_is")
    rows = src.select(
        make_rowkey(userid, platform).alias("u_key"), make_rowkey(contactid, platform).alias("c_key"),
        userid.alias("userid"), contactid.alias("contactid"), u_is.alias("u_is"), c_is.alias("c_is"),
        clean_name("c_name", null_token).alias("name"), u_phone.alias("u_phone"), c_phone.alias("c_phone"))
    edges = rows.select(F.col("u_key").alias("u_uid"), F.col("c_key").alias("c_uid"), "name")
    # Distinct on what a user row is made of, a quarter as wide as the 23 model columns: keys and constants come after.
    # Owners repeat with every contact and are combined first; contact rows hardly do, so they go straight to their
    # exchange instead of filling a map of wide rows in every task.
    parts = rows.select("userid", F.col("u_phone").alias("phone"), F.col("u_is").cast("int").alias("is_user"),
                        F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("__source")).distinct().unionByName(
        rows.select(F.col("contactid").alias("userid"), F.col("c_phone").alias("phone"), F.col("c_is").cast("int").alias("is_user"),
                    "name", F.col("userid").alias("__source")))
    users = to_user_model(spread_distinct(parts).select(
        make_rowkey("userid", platform).alias("rowkey"), "userid", "phone", "is_user", "name",
        make_rowkey("__source", platform).alias("name_source")), platform=platform)
    return edges, users


# Platform specs for the four source shapes of the reference.
def spec_basic(platform: str, id_col: str, name: str, phone: str, mail: str,
               update_time: str | None = None, null_token: str = "null") -> PlatformSpec:
    """Id, name, phone, mail (+ update time)."""
    cols = {"name": name, "phone": phone, "mail": mail}
    if update_time:
        cols["update_time"] = update_time
    return PlatformSpec(platform, id_col, cols, {
        "name": lambda c: clean_name(c, null_token), "phone": lambda c: clean_phone(c, null_token),
        "mail": lambda c: clean_mail(c, null_token)}, {"name_source": "Unknown"})


def spec_profile(platform: str, id_col: str, name: str, phone: str, mail: str, gender: str,
                 birth: str, reg_time: str | None = None, parse_birth: bool = True,
                 extra: dict[str, str] | None = None, null_token: str = "null") -> PlatformSpec:
    """Adds gender, birthday (parsed or raw), registration time, extras."""
    spec = spec_basic(platform, id_col, name, phone, mail, null_token=null_token)
    spec.columns.update({"gender": gender, "birthday": birth, **(extra or {})})
    if reg_time:
        spec.columns["reg_time"] = reg_time
    spec.cleaners["gender"] = clean_gender
    if parse_birth:
        spec.cleaners["birthday"] = lambda c: clean_birth(c, null_token)
    return spec


def spec_phone_id(platform: str, phone: str, update_time: str | None = None,
                  null_token: str = "null") -> PlatformSpec:
    """T4: the cleaned phone is the id. A missing phone gives a NULL id and
    row key (not one shared key for every bad phone)."""
    cleaned = clean_phone(F.col(phone), None)
    cols: dict[str, str | Column] = {"userid": cleaned, "phone": F.coalesce(cleaned, F.lit(null_token))}
    if update_time:
        cols["update_time"] = update_time
    return PlatformSpec(platform, cleaned, cols)


def group_members(src: DataFrame, platform: str, group_col: str = "groupid", uid_col: str = "uid",
                  role_col: str = "role") -> DataFrame:
    """Group member rows: ``groupuid = platform-groupid``, member key
    ``uuid = md5(uid)-platform``."""
    gid = F.col(group_col).cast("string")
    return src.select(F.concat(F.lit(platform + "-"), gid).alias("groupuid"), gid.alias("groupid"),
                      F.col(uid_col).cast("string").alias("uid"), F.col(role_col).alias("role"),
                      make_rowkey(F.col(uid_col).cast("string"), platform).alias("uuid"),
                      F.lit(platform).alias("platform"))


def group_info(src: DataFrame, platform: str) -> DataFrame:
    """Group info rows with ``groupuid`` and the creator's key ``createruuid``.

    Input columns: groupid, groupname, createruid, created, grouptype.
    """
    gid = F.col("groupid").cast("string")
    return src.select(F.concat(F.lit(platform + "-"), gid).alias("groupuid"), gid.alias("groupid"),
                      "groupname", F.col("createruid").cast("string").alias("createruid"),
                      F.col("created").cast("string").alias("created"), "grouptype",
                      make_rowkey(F.col("createruid").cast("string"), platform).alias("createruuid"),
                      F.lit(platform).alias("platform"))


def split_rejects(users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without a row key go to a rejects output instead of sharing one key."""
    return users.filter(F.col("rowkey").isNotNull()), users.filter(F.col("rowkey").isNull())
