"""DataFrame operators: envelope, relational, joins, aggregates, windows, merges, quality."""

from hearth.operators.aggregates import (
    aggregate_with_median,
    any_stable,
    count_when,
    flag_sum,
    grouped_median,

    mean,
    rollup_sum,
    sum_default,
)
from hearth.operators.envelope import (
    SourceSpec,
    dataset_slice,
    ingest_summary,
    latest_versions,
    payload_from_columns,
    record_hash,
    source_row_id,
    to_raw_records,
    union_raw,
)
from hearth.operators.joins import anti, full_outer_coalesce, join_null_safe, left_chain, lookup
from hearth.operators.merge import (
    first_per_key,
    high_water_mark,
    incremental,
    insert_ignore,
    merge_insert,
    new_rows,
    since_watermark,
    upsert,
)
from hearth.operators.ordinal import with_dense_index
from hearth.operators.relational import distinct_rows, project, where_in, where_present
from hearth.operators.windows import lag_ratio, latest_by, rolling_stddev, with_lags

__all__ = [
    "SourceSpec", "aggregate_with_median", "anti", "any_stable", "count_when", "dataset_slice", "distinct_rows",
    "first_per_key", "flag_sum", "full_outer_coalesce", "grouped_median", "high_water_mark", "left_chain",
    "incremental", "ingest_summary", "insert_ignore", "join_null_safe", "lag_ratio", "latest_by",
    "latest_versions", "lookup", "mean", "merge_insert", "new_rows",
    "payload_from_columns", "project", "record_hash", "rolling_stddev", "rollup_sum", "since_watermark",
    "source_row_id", "sum_default", "to_raw_records", "union_raw", "upsert", "where_in", "where_present",
    "with_dense_index", "with_lags",
]
