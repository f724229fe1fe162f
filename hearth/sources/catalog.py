"""Partitioned table over landed raw records, with partition repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearth.sources.files import GOOD_LINES

RAW_TABLE_DDL = """
CREATE TABLE IF NOT EXISTS {name} (
  dataset_type STRING, source_url STRING, source_row_id STRING, record_hash STRING,
  extracted_at STRING, ingested_at STRING, original_s3_key STRING, payload MAP<STRING, STRING>,
  _corrupt_record STRING, dataset_name STRING, ingest_date STRING, run_id STRING
) USING json
OPTIONS (mode 'PERMISSIVE')
PARTITIONED BY (dataset_name, ingest_date, run_id)
LOCATION '{root}'
"""


def register_raw_table(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Register the landed layout as a partitioned table and discover its
    partitions (a new table sees no rows until the repair).  The returned rows
    leave malformed lines out, as ``read_normalized`` does; the table itself keeps
    their text in ``_corrupt_record``.  A filter on
    ``dataset_name`` then prunes whole directories."""
    spark.sql(RAW_TABLE_DDL.format(name=name, root=root.replace("'", "\\'")))
    spark.catalog.recoverPartitions(name)
    return spark.table(name).where(GOOD_LINES).drop("_corrupt_record")
