"""Access to the free-form ``payload`` of a raw record: a map, or a ``Variant`` (see ``hearth.functions.variant``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearth.functions.variant import Variant, variant_text

#: Fixed value: names of payload keys that hold a month.
DATE_KEY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def field(payload: Column | str | Variant, name: str) -> Column:
    """Value of key ``name`` as text; NULL when the key is missing.  Keys are
    case-sensitive and may contain spaces (``'Complex ID'``)."""
    if isinstance(payload, Variant):
        return variant_text(payload.member(name))
    p = F.col(payload) if isinstance(payload, str) else payload
    return p.getItem(name).cast("string")


def has_field(payload: Column | str | Variant, name: str) -> Column:
    """Presence filter: the key exists with a non-NULL value (an empty string counts as present, and so
    does a JSON null in a variant, as it is a value there)."""
    if isinstance(payload, Variant):
        return payload.member(name).isNotNull()
    return field(payload, name).isNotNull()


def keys_matching(payload: Column | str, pattern: str = DATE_KEY) -> Column:
    """The payload restricted to keys matching ``pattern`` (applied before any explode,
    so non-matching keys never become rows)."""
    p = F.col(payload) if isinstance(payload, str) else payload
    return F.map_filter(p, lambda k, v: k.rlike(pattern))
