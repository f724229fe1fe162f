"""Incremental pickup of landed files with Structured Streaming.

The daily load becomes a file-source stream run with ``availableNow``: every
run processes the files that arrived since the last one, exactly once (the
checkpoint remembers them), and each micro-batch is merged into the target
with the same insert-if-absent operator as the batch path.  No streaming state
grows with the data: de-duplication happens against the target table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.operators.merge import first_per_key
from hearth.schemas import ENVELOPE_KEYS
from hearth.sources.files import GOOD_LINES, LANDED_AND_REJECTS
from hearth.sources.sinks import append_new


def landed_stream(
    spark: SparkSession, root: str, max_files_per_trigger: int | None = None, file_pattern: str | None = None
) -> DataFrame:
    """Stream of raw records from JSONL landed under ``root`` (hive layout), read as ``read_normalized``
    reads it: the same file name pattern, rejects and source file."""
    reader = spark.readStream.schema(LANDED_AND_REJECTS).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_pattern:
        reader = reader.option("pathGlobFilter", file_pattern)
    df = reader.json(root).where(GOOD_LINES)
    return df.select(
        "dataset_name", "dataset_type", "source_url", "source_row_id", "record_hash",
        F.try_to_timestamp(F.col("extracted_at")).alias("extracted_at"),
        F.try_to_timestamp(F.col("ingested_at")).alias("ingested_at"),
        "run_id", F.coalesce(F.col("original_s3_key"), F.col("_metadata.file_path")).alias("original_s3_key"), "payload",
    )


def _merge_batch(target_root: str, keys: Sequence[str], dedupe_batch: bool, order, partition_by):
    def run(batch: DataFrame, epoch_id: int) -> None:
        pick = (lambda rows: first_per_key(rows, keys, order)) if dedupe_batch else None
        append_new(batch, target_root, keys, partition_by, pick=pick)

    return run


def ingest_available(
    stream: DataFrame,
    target_root: str,
    checkpoint: str,
    keys: Sequence[str] = ENVELOPE_KEYS,
    dedupe_batch: bool = False,
    order=None,
    partition_by: Sequence[str] = ("dataset_name",),
) -> None:
    """Process every file available now, append the new keys to the target
    table, stop.  Each micro-batch writes only its new rows (the table is never
    rewritten); a replayed micro-batch appends nothing.  A rerun with the same
    checkpoint and no new files changes nothing."""
    q = (
        stream.writeStream.foreachBatch(_merge_batch(target_root, keys, dedupe_batch, order, partition_by))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def stream_insert_ignore(
    stream: DataFrame, target_root: str, checkpoint: str, keys: Sequence[str] = ENVELOPE_KEYS, order=None
) -> None:
    """Streaming INSERT ... ON CONFLICT DO NOTHING: a key arriving twice, in one
    batch or across batches, is kept once (first under ``order``)."""
    ingest_available(stream, target_root, checkpoint, keys, dedupe_batch=True, order=order)
