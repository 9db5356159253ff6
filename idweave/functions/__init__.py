"""Scalar column functions: cleaners, ids, codecs, packed text, similarity."""

from .cleaners import (  # noqa: F401
    clean_birth, clean_gender, clean_mail, clean_name, clean_phone, clean_platforms, default_unknown,
    first_present, is_present, pad_millis, signin_filter, signin_name,
)
from .codec import decode_value, encode_value, from_json_text, to_json_text  # noqa: F401
from .ids import (  # noqa: F401
    day_to_epoch_millis, epoch_seconds, join_key, key_part, md5_hex, rowkey, stable_group_id,
)
from .packed import entries, format_name_entry, pack, parse_name_entry, split_contact_entry  # noqa: F401
from .similarity import jaccard, weighted_jaccard  # noqa: F401
