"""File scans and sinks."""

from hearth.sources.catalog import register_raw_table
from hearth.sources.files import read_csv_rows, read_json_rows, read_normalized
from hearth.sources.sinks import (
    append_audit,
    append_new,
    extract,
    materialize,
    publish,
    read_current,
    upsert_partitions,
    write_normalized,
    write_version,
)

__all__ = [
    "append_audit", "append_new", "extract", "materialize", "publish", "read_csv_rows", "read_current",
    "read_json_rows", "read_normalized", "register_raw_table", "upsert_partitions", "write_normalized",
    "write_version",
]
