"""Merge and incremental maintenance without a table format.

There is no MERGE target here (no Delta/Iceberg), so each operator returns the
new version of the table as a DataFrame; ``sources.sinks.write_version`` writes
it to a new folder and swaps a pointer, never overwriting a path being read.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.operators.windows import OrderSpec, latest_by


class DuplicateKeyError(ValueError):
    pass


def _candidates(target: DataFrame, only: Mapping[str, Sequence[object]] | None) -> DataFrame:
    """The part of the target that can match the batch, as the caller knows it.

    ``only`` names key columns and all values that the batch has there (the feeds of
    a load, say).  On a partition column (``dataset_name`` on the landed
    layout) the literal filter skips every other partition folder."""
    for name, values in (only or {}).items():
        target = target.where(F.col(name).isin(list(values)))
    return target


def existing_keys(target: DataFrame, keys: Sequence[str], only: Mapping[str, Sequence[object]] | None = None) -> DataFrame:
    """Keys of the target that a batch can match."""
    return _candidates(target, only).select(*keys)


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], only: Mapping[str, Sequence[object]] | None = None) -> DataFrame:
    """Batch rows whose key is absent from the target (the rows a merge inserts).
    Only the key columns of the target are shuffled; with ``only`` (values of key
    columns that the caller knows the batch to be in) just those partitions are read."""
    return batch.join(existing_keys(target, keys, only), list(keys), "left_anti")


def merge_insert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], only: Mapping[str, Sequence[object]] | None = None
) -> DataFrame:
    """The table after an insert-if-absent merge: matched rows untouched, new
    keys inserted.  Duplicates inside the batch are all inserted (the source of
    a MERGE is not de-duplicated).  To store the result, append only
    ``new_rows`` (``sources.sinks.append_new``) rather than rewriting the table."""
    return target.unionByName(new_rows(target, batch, keys, only).select(*target.columns))


def insert_ignore(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[OrderSpec] | None = None,
    only: Mapping[str, Sequence[object]] | None = None,
) -> DataFrame:
    """INSERT ... ON CONFLICT DO NOTHING: like ``merge_insert`` but duplicates
    inside the batch also collapse, the first under ``order`` winning (give a
    unique tie-break for a reproducible choice)."""
    return merge_insert(target, first_per_key(batch, keys, order), keys, only)


def first_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[OrderSpec] | None = None) -> DataFrame:
    """One row per key: the first under ``order`` (any one without an order)."""
    return latest_by(batch, keys, order) if order else batch.dropDuplicates(list(keys))


def upsert(target: DataFrame, batch: DataFrame, key: str | Sequence[str], check_unique: bool = True) -> DataFrame:
    """Replace target rows whose key is in the batch, insert the rest.

    A batch holding one key twice is an error (as for a MERGE with several
    source rows per target row); the check is one aggregation over the batch.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if check_unique:
        dup = batch.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
        if dup:
            raise DuplicateKeyError(f"batch repeats key {dup[0].asDict()}")
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return batch.select(*target.columns).unionByName(kept)


def high_water_mark(target: DataFrame | None, col: str, default: str = "1900-01-01") -> object:
    """``coalesce(max(col), default)`` of the target (one scalar to the driver)."""
    if target is None:
        return _dt.date.fromisoformat(default)
    mark = target.agg(F.max(col)).first()[0]
    return mark if mark is not None else _dt.date.fromisoformat(default)


def since_watermark(batch: DataFrame, target: DataFrame | None, col: str, default: str = "1900-01-01") -> DataFrame:
    """Rows at or after the target's high-water mark.  The newest period is
    always reprocessed; rows older than the mark are ignored.  The mark is a
    literal, so the filter reaches the scan and can prune files."""
    mark = high_water_mark(target, col, default)
    return batch.where(F.col(col) >= F.lit(mark))


def incremental(
    model_output: DataFrame,
    current: DataFrame | None,
    key: str,
    watermark_col: str,
    full_refresh: bool = False,
) -> DataFrame:
    """One incremental run: filter the freshly computed model by the current
    table's high-water mark, then upsert by ``key``.  Windows inside
    ``model_output`` were computed over the full input, before this filter."""
    if current is None or full_refresh:
        return model_output
    return upsert(current, since_watermark(model_output, current, watermark_col), key)

