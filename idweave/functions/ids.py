"""Key and id expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

KEY_SEP = "-"


def md5_hex(c) -> Column:
    """lower-case hex md5 of the text form."""
    return F.md5(col_of(c).cast("string"))


def rowkey(id_col, platform) -> Column:
    """``md5(id)-platform``; NULL id gives a NULL key (rows go to rejects)."""
    p = F.lit(platform) if isinstance(platform, str) else platform
    return F.concat(md5_hex(id_col), F.lit(KEY_SEP), p)


def join_key(*parts, sep: str = KEY_SEP, skip_nulls: bool = False) -> Column:
    """``a-b-c``. ``concat`` keeps NULL visible; ``concat_ws`` skips it."""
    cols = [col_of(p) if not isinstance(p, Column) else p for p in parts]
    if skip_nulls:
        return F.concat_ws(sep, *cols)
    with_sep = []
    for i, c in enumerate(cols):
        if i:
            with_sep.append(F.lit(sep))
        with_sep.append(c.cast("string"))
    return F.concat(*with_sep)


def key_part(c, index: int, sep: str = KEY_SEP) -> Column:
    """F16: the ``index``-th (0-based) part of a dash-joined id; NULL when absent."""
    return F.get(F.split(col_of(c), "\\" + sep if sep in ".-|" else sep, -1), index)


def packed_id(c) -> Column:
    """An id as bytes for joins and exchanges: the 32 hex digits of a hashed id in front are 16 bytes, any other text
    is as it was (the first byte tells which). ``unpacked_id`` gives the same text back."""
    c = col_of(c)
    head = F.substring(c, 1, 32)
    return (F.when(c.rlike("^[0-9a-f]{32}"), F.concat(F.lit(b"\x01"), F.unhex(head), F.substring(c, 33, 2**31 - 1).cast("binary")))
            .otherwise(F.concat(F.lit(b"\x00"), c.cast("binary"))))


def unpacked_id(b) -> Column:
    """The text of a ``packed_id``."""
    b = col_of(b)
    rest = F.substring(b, 18, 2**31 - 1).cast("string")
    return (F.when(F.substring(b, 1, 1) == F.lit(b"\x01"), F.concat(F.lower(F.hex(F.substring(b, 2, 16))), rest))
            .otherwise(F.substring(b, 2, 2**31 - 1).cast("string")))


def stable_group_id(ids_array) -> Column:
    """a repeatable id for a set of member ids (md5 of the sorted list)."""
    return F.md5(F.array_join(F.array_sort(F.array_distinct(col_of(ids_array))), "\t"))


def day_to_epoch_millis(day) -> Column:
    """``yyyyMMdd`` text -> epoch milliseconds text (session zone, UTC)."""
    ts = F.try_to_timestamp(col_of(day), F.lit("yyyyMMdd"))
    return (F.unix_timestamp(ts) * F.lit(1000)).cast("string")


def epoch_seconds(ts) -> Column:
    """Epoch seconds of a timestamp or timestamp_ntz column (UTC)."""
    return F.unix_timestamp(col_of(ts).cast("timestamp")).cast("long")
