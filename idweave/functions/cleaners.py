"""Text cleaners as pure ``Column -> Column`` expressions.

Every cleaner is built from built-in Spark SQL functions, so it runs inside
whole-stage codegen with no Python worker. Missing values come back as SQL
NULL, or as the text given in ``null_token`` (``'null'`` reproduces the
reference's two-valued "missing").
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of, missing

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's rules for the same results).
# Phone numbers that start with any of these digit strings are rejected.
PHONE_BLACKLIST = [
    "112233", "789456123", "147258369", "987654", "87654", "123456", "654321", "54321",
    "111", "222", "333", "444", "555", "666", "777", "888", "999",
    "147852369", "87654321", "7654321", "1478963", "3456", "45678", "13579",
]
PHONE_MIN_DIGITS = 7
PHONE_MAX_DIGITS = 16
# A name made only of these characters (or of whitespace) is missing.
NAME_PUNCT_ASCII = "+.!/_,$%^*(+\"'"
NAME_PUNCT_WIDE = "+——！，。？、~@#￥%……&*（）"
# Mail: the local part must have at least this many bytes.
MAIL_MIN_LOCAL_BYTES = 4
# Mail: per-domain rule for the local part, tested case-insensitively from the
# start of the local part. The yahoo rule is the reference's own text, whose
# "(a-z)" asks for the literal characters a-z.
MAIL_DOMAIN_RULES = {"gmail.com": "[a-z0-9.]{6,30}", "yahoo.com": "(a-z)[a-z0-9._]{4,32}"}
# Gender words (compared lower-cased) and the text they map to. The
# reference's table also lists "FM", "M" and "F"; the input is lower-cased
# before the lookup, so those upper-case keys can never match.
GENDER_WORDS = {
    "male": "true", "female": "false", "man": "true", "woman": "false", "fm": "false",
    "m": "true", "f": "false",
}
# System "signed in" phrases. A trailing "Tango*" means Tang followed by any
# number of o. All four mark a sign-in; only the first three are removed.
SIGNIN_PHRASES = ["也登入 Tango*", "is back on Tango*", "也登录了 Tango*", "님이 Tango*"]
SIGNIN_REMOVED = SIGNIN_PHRASES[:3]
# Timestamps shorter than this many characters are seconds and get "000".
MILLIS_TEXT_LEN = 13
# Record and field separators of packed platform text.
RECORD_SEP = "\u0002"
FIELD_SEP = "\t"
# ---------------------------------------------------------------------------

# Python's ASCII whitespace (what the reference strips and removes).
_WS = " \\t\\n\\x0B\\f\\r"


def _char_class(chars: str) -> str:
    out = []
    for ch in dict.fromkeys(chars):  # keep first occurrence, natural order
        out.append("\\" + ch if (ch.isascii() and not ch.isalnum()) else ch)
    return "".join(out)


_NAME_JUNK_ONLY = "^[" + _WS + _char_class(NAME_PUNCT_ASCII + NAME_PUNCT_WIDE) + "]*$"
_TRIM_WS = "^[" + _WS + "]+|[" + _WS + "]+$"
_PHONE_BLACK_RE = "^(?:" + "|".join(PHONE_BLACKLIST) + ")"
_SIGNIN_ANY = "|".join(SIGNIN_PHRASES)
_SIGNIN_REMOVED = "|".join(SIGNIN_REMOVED)


def clean_phone(c, null_token: str | None = None) -> Column:
    """keep digits; reject short (<7), long (>16) and blacklisted prefixes."""
    c = col_of(c)
    digits = F.regexp_replace(c, "[^0-9]", "")
    n = F.length(digits)
    bad = (c.isNull() | (n < PHONE_MIN_DIGITS) | (n > PHONE_MAX_DIGITS)
           | digits.rlike(_PHONE_BLACK_RE))
    return F.when(bad, missing(null_token)).otherwise(digits)


def clean_name(c, null_token: str | None = None) -> Column:
    """missing when nothing but punctuation/whitespace; else trimmed original."""
    c = col_of(c)
    junk = c.isNull() | c.rlike(_NAME_JUNK_ONLY)
    return F.when(junk, missing(null_token)).otherwise(F.regexp_replace(c, _TRIM_WS, ""))


def clean_mail(c, null_token: str | None = None,
               domain_rules: dict[str, str] | None = None) -> Column:
    """exactly one '@', local part of 4+ bytes, per-domain local-part rule;
    the kept mail has its whitespace removed."""
    c = col_of(c)
    rules = MAIL_DOMAIN_RULES if domain_rules is None else domain_rules
    parts = F.split(c, "@", -1)
    local = F.get(parts, 0)
    domain = F.get(parts, 1)
    bad = c.isNull() | (F.size(parts) != 2) | (F.octet_length(local) < MAIL_MIN_LOCAL_BYTES)
    for dom, pattern in rules.items():
        bad = bad | ((domain == F.lit(dom)) & ~local.rlike("(?i)^(?:" + pattern + ")"))
    return F.when(bad, missing(null_token)).otherwise(F.regexp_replace(c, "\\s+", ""))


def clean_birth(c, null_token: str | None = None, min_year: int = 1900) -> Column:
    """``{"day":d,"month":m,"year":y}`` text -> epoch seconds (UTC) as text.

    Quotes, braces and whitespace are dropped; pieces are split on ',' and
    each must be ``key:value``; the last duplicate key wins; day and month
    default to 1; a missing year, an impossible date, or a year below
    ``min_year`` gives missing.
    """
    c = col_of(c)
    s = F.regexp_replace(c, '["{}]|\\s+', "")
    kv = F.transform(F.split(s, ",", -1), lambda p: F.split(p, ":", -1))
    well_formed = F.forall(kv, lambda a: F.size(a) == 2)

    def last(key: str) -> Column:
        hits = F.transform(F.filter(kv, lambda a: F.get(a, 0) == F.lit(key)), lambda a: F.get(a, 1))
        return F.try_element_at(hits, F.lit(-1))

    year = last("year")
    month = F.coalesce(last("month"), F.lit("1"))
    day = F.coalesce(last("day"), F.lit("1"))
    shaped = (year.rlike("^[0-9]{4}$") & month.rlike("^(?:1[0-2]|0[1-9]|[1-9])$")
              & day.rlike("^(?:3[01]|[12][0-9]|0[1-9]|[1-9])$"))
    ts = F.try_to_timestamp(F.concat_ws("-", year, month, day), F.lit("yyyy-M-d"))
    ok = well_formed & year.isNotNull() & shaped & ts.isNotNull() & (year.cast("int") >= min_year)
    out = F.unix_timestamp(ts).cast("string")
    return F.when(ok, out).otherwise(missing(null_token))


def clean_platforms(c, null_token: str | None = None) -> Column:
    """5th tab field of each \\x02 record, distinct, sorted, tab-joined."""
    c = col_of(c)
    fields = F.transform(F.split(c, RECORD_SEP, -1), lambda r: F.split(r, FIELD_SEP, -1))
    ok = F.forall(fields, lambda f: F.size(f) >= 5)
    values = F.array_sort(F.array_distinct(F.transform(fields, lambda f: F.get(f, 4))))
    bad = c.isNull() | (c == F.lit("null")) | ~ok
    return F.when(bad, missing(null_token)).otherwise(F.array_join(values, FIELD_SEP))


def clean_gender(c) -> Column:
    """F8: gender words -> 'true'/'false'; anything else NULL."""
    c = col_of(c)
    lookup = F.create_map(*[F.lit(x) for kv in GENDER_WORDS.items() for x in kv])
    return F.try_element_at(lookup, F.lower(c))


def pad_millis(c) -> Column:
    """epoch text shorter than 13 characters gets '000' appended."""
    t = col_of(c).cast("string")
    return F.when(F.length(t) < MILLIS_TEXT_LEN, F.concat(t, F.lit("000"))).otherwise(t)


def signin_name(c, null_token: str | None = None) -> Column:
    """name from a system sign-in message: phrase removed, text before the
    first comma; missing when no sign-in phrase occurs."""
    c = col_of(c)
    name = F.substring_index(F.regexp_replace(c, _SIGNIN_REMOVED, ""), ",", 1)
    return F.when(c.rlike(_SIGNIN_ANY), name).otherwise(missing(null_token))


def signin_filter(c, null_token: str | None = None) -> Column:
    """content of a sign-in message becomes missing; other content is kept."""
    c = col_of(c)
    return F.when(c.rlike(_SIGNIN_REMOVED), missing(null_token)).otherwise(c)


def first_present(*cols) -> Column:
    """first non-NULL argument."""
    return F.coalesce(*[col_of(x) for x in cols])


def default_unknown(c, default: str = "Unknown") -> Column:
    """NULL or empty text -> 'Unknown'."""
    return F.coalesce(F.nullif(col_of(c), F.lit("")), F.lit(default))


def is_present(c, null_token: str | None = "null") -> Column:
    """Value is neither NULL nor the missing token."""
    c = col_of(c)
    return c.isNotNull() & (c != F.lit(null_token)) if null_token is not None else c.isNotNull()
