import tempfile

from hearth.operators.envelope import SourceSpec, to_raw_records
from hearth.sources.sinks import write_normalized
from hearth.streaming.ingest import ingest_available, landed_stream, stream_insert_ignore

SPEC = SourceSpec("feed_s", "t", "u", ("id",))


def _raw(spark, ids, run="run-1"):
    src = spark.createDataFrame([(str(i), f"v{i}") for i in ids], "id string, v string")
    return to_raw_records(src, SPEC, run, "2026-05-01 00:00:00")


def test_available_now_processes_new_files_once(spark):
    base = tempfile.mkdtemp(prefix="hearth-stream-")
    landing, target, ckpt = f"{base}/in", f"{base}/target", f"{base}/ckpt"
    write_normalized(_raw(spark, [1, 2]), landing)
    ingest_available(landed_stream(spark, landing), target, ckpt)
    assert spark.read.parquet(target).count() == 2
    write_normalized(_raw(spark, [2, 3], run="run-2"), landing)  # 2 again: same key, not re-inserted
    ingest_available(landed_stream(spark, landing), target, ckpt)
    first = sorted(r["source_row_id"] for r in spark.read.parquet(target).collect())
    ingest_available(landed_stream(spark, landing), target, ckpt)  # nothing new
    assert sorted(r["source_row_id"] for r in spark.read.parquet(target).collect()) == first == ["1", "2", "3"]


def test_stream_dedupe_within_and_across_batches(spark):
    base = tempfile.mkdtemp(prefix="hearth-dedupe-")
    landing, target, ckpt = f"{base}/in", f"{base}/target", f"{base}/ckpt"
    write_normalized(_raw(spark, [1, 2]), landing)
    write_normalized(_raw(spark, [1]), landing)
    stream_insert_ignore(landed_stream(spark, landing), target, ckpt)
    write_normalized(_raw(spark, [2, 4]), landing)
    stream_insert_ignore(landed_stream(spark, landing), target, ckpt)
    assert sorted(r["source_row_id"] for r in spark.read.parquet(target).collect()) == ["1", "2", "4"]
