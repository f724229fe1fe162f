"""Landed text is stored compressed and read back alike; an upsert leaves few files; a merge works its batch out twice at most."""

import os

from pyspark.sql import functions as F

from hearth.operators.envelope import SourceSpec, to_raw_records
from hearth.plans import queries_io
from hearth.sources import key_index, sinks
from hearth.sources.catalog import register_raw_table
from hearth.sources.files import read_normalized
from hearth.streaming.ingest import landed_stream, stream_insert_ignore

SPEC = SourceSpec("feed_z", "t", "https://example.org/a/long/name.csv", ("id",))


def _raw(spark, n, run="run-1999"):
    src = spark.range(n).select(F.col("id").cast("string").alias("id"), *[F.lit(f"value {k}").alias(f"a_long_column_name_{k}") for k in range(12)])
    return to_raw_records(src, SPEC, run, "1999-05-01 00:00:00")


def _files(root):
    return [os.path.join(p, f) for p, _, names in os.walk(root) for f in names if not f.startswith((".", "_"))]


def _bytes(root):
    return sum(os.path.getsize(f) for f in _files(root))


def _read(df):
    return sorted(str(r) for r in df.drop("original_s3_key").collect())


def test_compressed_landing_is_small_and_reads_alike(spark, tmp_path):
    plain, small = str(tmp_path / "plain"), str(tmp_path / "small")
    sinks.write_normalized(_raw(spark, 2000), plain)
    sinks.write_normalized(_raw(spark, 2000), small, compression="gzip")
    assert _bytes(small) * 4 < _bytes(plain)
    assert _read(read_normalized(spark, small)) == _read(read_normalized(spark, plain))
    assert register_raw_table(spark, "raw_records_small", small).count() == 2000
    stream_insert_ignore(landed_stream(spark, small), str(tmp_path / "t"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2000


def test_compressed_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "LANDED_ROWS", 100)
    sinks.write_normalized(_raw(spark, 1000).coalesce(1), str(tmp_path / "l"), compression="gzip")
    assert len(_files(tmp_path / "l")) == 10
    assert read_normalized(spark, str(tmp_path / "l")).count() == 1000


def test_queries_land_compressed(spark, tmp_path):
    queries_io._land(_raw(spark, 50), str(tmp_path / "l"))
    assert _files(tmp_path / "l") and all(f.endswith(".json.gz") for f in _files(tmp_path / "l"))


def test_tolerant_scan_lands_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries_io, "_fresh", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(queries_io.bindings, "raw_records", lambda spark, d: _raw(spark, 50))
    assert queries_io._jsonl_tolerant(spark, "").count() == 50
    assert _files(tmp_path) and all(f.endswith(".gz") for f in _files(tmp_path))


def test_upsert_leaves_a_file_a_partition(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(0, 4000, 1, 16).select(F.col("id").alias("k"), (F.col("id") % 4).alias("day"), (F.col("id") % 4).alias("month"))
    sinks.upsert_partitions(rows.where("day < 3"), root, "k", "day", "month")
    sinks.upsert_partitions(rows, root, "k", "day", "month")
    assert spark.read.parquet(root).count() == 4000
    assert len([f for f in _files(root) if f.endswith(".parquet")]) == 4


def test_an_indexed_append_works_its_batch_out_twice(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def costly(x):
        seen.add(1)
        return f"k{x}"

    def batch():
        return spark.range(0, 300, 1, 2).select(F.lit("a").alias("part"), costly("id").alias("id"))

    root = str(tmp_path / "t")
    key_index.append_indexed(batch(), root, ["part", "id"], ["part"])
    seen.value = 0
    key_index.append_indexed(batch(), root, ["part", "id"], ["part"])
    assert spark.read.parquet(root).count() == 300
    assert seen.value <= 600
