"""Raw-record envelope: every source row becomes one keyed, hashed record.

    dataset_name, dataset_type, source_url, source_row_id, record_hash,
    extracted_at, ingested_at, run_id, original_s3_key, payload (map<string,string>)

All of it is column expressions over the source DataFrame; executors build the
key and the hash, the driver only plans.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.functions.scalar import utc_literal
from hearth.operators.ordinal import with_dense_index
from hearth.schemas import RAW_SCHEMA


@dataclass(frozen=True)
class SourceSpec:
    """What the envelope needs to know about one feed."""

    name: str
    dataset_type: str
    url: str
    primary_key: tuple[str, ...] = field(default_factory=tuple)


def payload_from_columns(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """map<string,string> of the row: every column as text (nested values as
    JSON text), keys in sorted order so the content hash needs no sort."""
    cols = sorted(columns if columns is not None else df.columns)
    kv = []
    for name in cols:
        dtype = df.schema[name].dataType
        c = F.col(f"`{name}`")
        value = F.to_json(c) if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string")
        kv += [F.lit(name), value]
    return F.create_map(*kv)


def key_part(payload: Column, key: str) -> Column:
    """One business-key part: the key as named, else lower-cased, else spaces as
    underscores; only a missing (NULL) value falls through; NULL/'' -> ''."""
    candidates = [key]
    for alt in (key.lower(), key.replace(" ", "_")):
        if alt not in candidates:
            candidates.append(alt)
    return F.coalesce(*[payload.getItem(k) for k in candidates], F.lit(""))


def source_row_id(payload: Column, keys: Sequence[str], fallback: Column | None) -> Column:
    """``|``-joined key parts; when every part is empty use ``fallback``."""
    if not keys:
        return fallback if fallback is not None else F.lit(None).cast("string")
    parts = [key_part(payload, k) for k in keys]
    joined = F.concat_ws("|", *parts)
    if fallback is None:
        return joined
    all_empty = F.concat(*parts) == F.lit("")
    return F.when(all_empty, fallback).otherwise(joined)


def sorted_map(payload: Column) -> Column:
    """The same map with its entries in key order."""
    return F.map_from_entries(F.array_sort(F.map_entries(payload)))


def record_hash(
    name: Column, dataset_type: Column, url: Column, row_id: Column, payload: Column, payload_sorted: bool = False
) -> Column:
    """SHA-256 hex of the canonical JSON of {name, type, url, row id, payload}.

    Canonical JSON: object keys in sorted order at both levels, no whitespace,
    NULLs written out (for ASCII text this is byte-for-byte what a compact,
    key-sorted ``json.dumps`` of the same record gives).  The hash therefore
    does not depend on payload key order.  Pass ``payload_sorted=True`` when
    the map was built from keys in sorted order (``payload_from_columns`` does)
    to skip the per-row sort.  Run id and timestamps are not hashed: the same
    logical row landed by a later run keeps its hash.
    """
    doc = F.struct(
        name.alias("dataset_name"),
        dataset_type.alias("dataset_type"),
        (payload if payload_sorted else sorted_map(payload)).alias("payload"),
        row_id.alias("source_row_id"),
        url.alias("source_url"),
    )
    return F.sha2(F.to_json(doc, {"ignoreNullFields": "false"}), 256)


def to_raw_records(
    df: DataFrame,
    spec: SourceSpec,
    run_id: str | Column,
    ingested_at: str | Column,
    original_key: str | Column | None = None,
    payload: Column | None = None,
    ordinal: bool = True,
    payload_sorted: bool | None = None,
    ordinal_scope: str = "input",
) -> DataFrame:
    """Wrap every row of ``df`` in the raw-record envelope.

    ``payload_sorted``: the given ``payload`` map was built with its keys in
    sorted order (default: true for the payload built here from the columns).
    ``ordinal_scope``: ``input`` numbers rows across the whole input; ``file``
    restarts at 1 in every source file (``df`` must then be a file scan).

    ``ordinal`` controls the ``name:row_number`` fallback key used when every
    key part of a row is empty (or the spec has no key).  It costs one extra
    scan of the input (see ``with_dense_index``); pass ``False`` only when every
    row is known to carry its key.
    """
    base = df
    need_ordinal = ordinal or not spec.primary_key
    if need_ordinal:
        within = F.col("_metadata.file_path") if ordinal_scope == "file" else None
        base = with_dense_index(base, "__ordinal", within=within)
    p = payload if payload is not None else payload_from_columns(df)
    if payload_sorted is None:
        payload_sorted = payload is None
    name, dtype, url = F.lit(spec.name), F.lit(spec.dataset_type), F.lit(spec.url)
    fallback = F.concat(F.lit(spec.name + ":"), F.col("__ordinal").cast("string")) if need_ordinal else None
    # text without an offset is a UTC wall clock, whatever the session zone
    ts = utc_literal(ingested_at) if isinstance(ingested_at, str) else ingested_at.cast("timestamp")
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    okey = (F.lit(original_key) if isinstance(original_key, str) else original_key) if original_key is not None else None
    staged = base.select(p.alias("payload"), *([F.col("__ordinal")] if need_ordinal else []), *([okey.alias("__okey")] if okey is not None else []), run.alias("__run"), ts.alias("__ts"))
    row_id = source_row_id(F.col("payload"), spec.primary_key, fallback)
    with_id = staged.withColumn("source_row_id", row_id)
    return with_id.select(
        name.alias("dataset_name"),
        dtype.alias("dataset_type"),
        url.alias("source_url"),
        F.col("source_row_id"),
        record_hash(name, dtype, url, F.col("source_row_id"), F.col("payload"), payload_sorted).alias("record_hash"),
        F.col("__ts").alias("extracted_at"),
        F.col("__ts").alias("ingested_at"),
        F.col("__run").cast("string").alias("run_id"),
        (F.col("__okey") if okey is not None else F.lit(None)).cast("string").alias("original_s3_key"),
        F.col("payload"),
    )


def union_raw(frames: Sequence[DataFrame]) -> DataFrame:
    """All feeds share one raw table: UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ingest_summary(raw: DataFrame) -> DataFrame:
    """Rows landed per feed and type."""
    return raw.groupBy("dataset_name", "dataset_type").agg(F.count(F.lit(1)).alias("row_count"))


def dataset_slice(raw: DataFrame, name: str) -> DataFrame:
    """Rows of one feed.  On a ``dataset_name=`` partitioned layout this is a
    partition filter, and on a union of feeds Catalyst prunes the other branches."""
    return raw.where(F.col("dataset_name") == F.lit(name))


def conform_raw(df: DataFrame) -> DataFrame:
    """Project any raw-shaped frame onto ``RAW_SCHEMA`` column order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])


def latest_versions(raw: DataFrame, order=(("ingested_at", "desc"), "record_hash")) -> DataFrame:
    """One version per (dataset_name, source_row_id): the newest by ``order``.

    A wide feed that gains a month column gets a new content hash, so an
    insert-only raw table keeps both versions of that row; staging on all of
    them repeats ids.  This keeps the latest version only (planned as a
    partial WindowGroupLimit, so a hot key shrinks before the shuffle)."""
    from hearth.operators.windows import latest_by

    return latest_by(raw, ["dataset_name", "source_row_id"], list(order))
