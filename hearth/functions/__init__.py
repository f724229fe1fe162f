from hearth.functions.payload import field, has_field, keys_matching
from hearth.functions.scalar import (
    any_band,
    band,
    date_text,
    days_between,
    decode,
    money,
    parse_bool,
    safe_ratio,
    split_literal,
    surrogate_key,
    try_date,
    try_decimal,
    try_double,
    try_number,
    try_timestamp,
    utc_instant,
    utc_literal,
    utc_text,
)
from hearth.functions.variant import Variant, map_of, payload_of, unpivot, variant_text

__all__ = [
    "Variant", "map_of", "payload_of", "unpivot", "variant_text",
    "any_band", "band", "date_text", "days_between", "decode", "field", "has_field", "keys_matching",
    "money", "parse_bool", "safe_ratio", "split_literal", "surrogate_key", "try_date", "try_decimal",
    "try_double", "try_number", "try_timestamp", "utc_instant", "utc_literal", "utc_text",
]
