"""Fixed schemas: the raw-record envelope and the load audit."""

from __future__ import annotations

from pyspark.sql import types as T

ENVELOPE_KEYS = ("dataset_name", "source_row_id", "record_hash")

RAW_SCHEMA = T.StructType(
    [
        T.StructField("dataset_name", T.StringType(), False),
        T.StructField("dataset_type", T.StringType(), False),
        T.StructField("source_url", T.StringType(), False),
        T.StructField("source_row_id", T.StringType(), False),
        T.StructField("record_hash", T.StringType(), False),
        T.StructField("extracted_at", T.TimestampType(), True),
        T.StructField("ingested_at", T.TimestampType(), True),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("original_s3_key", T.StringType(), True),
        T.StructField("payload", T.MapType(T.StringType(), T.StringType(), True), False),
    ]
)

# Landed JSONL carries timestamps as ISO text; the loader parses them tolerantly.
RAW_JSONL_SCHEMA = T.StructType(
    [
        T.StructField("dataset_name", T.StringType(), True),
        T.StructField("dataset_type", T.StringType(), True),
        T.StructField("source_url", T.StringType(), True),
        T.StructField("source_row_id", T.StringType(), True),
        T.StructField("record_hash", T.StringType(), True),
        T.StructField("extracted_at", T.StringType(), True),
        T.StructField("ingested_at", T.StringType(), True),
        T.StructField("run_id", T.StringType(), True),
        T.StructField("original_s3_key", T.StringType(), True),
        T.StructField("payload", T.MapType(T.StringType(), T.StringType(), True), True),
    ]
)

# Landed layout: the JSONL schema plus the ``ingest_date`` path column.
LANDED_SCHEMA = T.StructType(RAW_JSONL_SCHEMA.fields + [T.StructField("ingest_date", T.StringType(), True)])

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("load_id", T.StringType(), False),
        T.StructField("loaded_at", T.TimestampType(), False),
        T.StructField("stage_name", T.StringType(), True),
        T.StructField("rows_loaded", T.LongType(), True),
        T.StructField("status", T.StringType(), True),
    ]
)
