"""Scalar Column helpers: tolerant casts, keys, decoding and banding.

Everything here is a built-in Spark expression, so it stays inside whole-stage
codegen.  Casts never raise under ANSI mode: junk, empty strings and overflow
become NULL.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

ISO_DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}([T ].*)?$"
US_DATE = r"^\d{1,2}/\d{1,2}/\d{4}$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_date(c: ColumnOrName) -> Column:
    """Parse a date; NULL when the text is not a real calendar date.

    Accepts ``yyyy-MM-dd`` (optionally followed by a time part, as in ISO
    timestamps) and ``M/d/yyyy``.  A bare year or an impossible day is NULL.
    """
    s = F.trim(_col(c))
    iso = F.when(s.rlike(ISO_DATE_PREFIX), F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd"))
    us = F.when(s.rlike(US_DATE), F.try_to_date(s, "M/d/yyyy"))
    return F.coalesce(iso, us)


def try_decimal(c: ColumnOrName, precision: int, scale: int) -> Column:
    """Text -> decimal(p, s), rounded half-up to the scale; NULL on junk or overflow."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def try_number(c: ColumnOrName) -> Column:
    """Text -> integer-valued decimal(38,0); ``'3.7'`` rounds to 4 (a direct int cast would give NULL)."""
    return _col(c).try_cast("decimal(38,0)")


OFFSET_SUFFIX = r"(Z|[+-]\d{2}(:?\d{2})?)$"


def try_timestamp(c: ColumnOrName, assume_utc: bool = False) -> Column:
    """ISO-8601 text (offset allowed) -> timestamp; NULL when unparseable.

    Text without an offset is read in the session time zone, or as UTC with
    ``assume_utc`` (results then do not depend on the session)."""
    s = _col(c)
    if assume_utc:
        s = F.when(s.rlike(OFFSET_SUFFIX), s).otherwise(F.concat(s, F.lit("Z")))
    return F.try_to_timestamp(s)


def utc_instant(c: ColumnOrName) -> Column:
    """A zone-less timestamp (or ISO text without offset) read as a UTC wall clock."""
    col = _col(c)
    text = F.date_format(col.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.try_to_timestamp(F.concat(text, F.lit("Z")))


def utc_literal(text: str) -> Column:
    """ISO text without offset, as a UTC instant (not in the session zone)."""
    return F.try_to_timestamp(F.lit(text.replace("T", " ") + "Z"))


def utc_text(c: ColumnOrName) -> Column:
    """An instant rendered as UTC wall-clock text (``yyyy-MM-dd HH:mm:ss[.ffffff]``)."""
    return F.to_utc_timestamp(_col(c), F.current_timezone()).cast("timestamp_ntz").cast("string")


def try_double(c: ColumnOrName) -> Column:
    return _col(c).try_cast("double")


def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 of the parts joined by ``|``.  A NULL part makes the key NULL
    (``concat`` semantics); wrap parts in ``coalesce`` where that is not wanted."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        parts.append(_col(c).cast("string"))
    return F.md5(F.concat(*parts))


def money(c: ColumnOrName, precision: int = 14, scale: int = 2) -> Column:
    """Strip everything except digits and dots (``$1,234.50`` -> 1234.50), then try-cast."""
    return try_decimal(F.regexp_replace(_col(c), r"[^0-9.]", ""), precision, scale)


def split_literal(c: ColumnOrName, sep: str) -> Column:
    """Split on a literal separator; NULL input gives ``['']`` like an empty string."""
    return F.split(F.coalesce(_col(c), F.lit("")), re.escape(sep))


def parse_bool(c: ColumnOrName) -> Column:
    """``lower(x) = 'true'``; NULL stays NULL."""
    return F.lower(_col(c)) == F.lit("true")


def decode(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Simple CASE: mapped value when the key matches, else the input unchanged."""
    col = _col(c)
    out = None
    for key, value in mapping.items():
        out = F.when(col == F.lit(key), F.lit(value)) if out is None else out.when(col == F.lit(key), F.lit(value))
    return col if out is None else out.otherwise(col)


def band(c: ColumnOrName, thresholds: Sequence[tuple[float, str]], default: str) -> Column:
    """Searched CASE: first ``(minimum, label)`` with ``c >= minimum`` wins."""
    col = _col(c)
    out = None
    for minimum, label in thresholds:
        cond = col >= F.lit(minimum)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def any_band(conditions: Iterable[tuple[Column, str]], default: str) -> Column:
    """Searched CASE over arbitrary predicates, in order."""
    out = None
    for cond, label in conditions:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def safe_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b in double precision; NULL when b is 0 or NULL (ANSI division by zero would raise)."""
    return _col(a).cast("double") / F.nullif(_col(b).cast("double"), F.lit(0.0))


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole days from ``start`` to ``end`` (end - start)."""
    return F.datediff(_col(end), _col(start))


def date_text(c: ColumnOrName) -> Column:
    """Date -> ``yyyy-MM-dd`` text."""
    return _col(c).cast("date").cast("string")
