"""Hashes that go ahead of the rows change no result, and leave little on disk."""

import random

import pytest
from pyspark.sql import functions as F

from hearth.operators.envelope import SourceSpec, to_raw_records
from hearth.operators.merge import first_per_key, new_rows
from hearth.session import frugal_writes
from hearth.plans import queries_io
from hearth.sources import fresh, key_index, sinks

SPEC = SourceSpec("feed_f", "t", "u", ("id",))
SCHEMA = "part string, id string, v long"


def _rows(rng, n, ids):
    return [(rng.choice(["a", "b", None]), rng.choice([None, *[f"k{i}" for i in range(ids)]]), v) for v in range(n)]


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


@pytest.mark.parametrize("places, slice_rows", [(1 << 28, 10**6), (1 << 12, 20)])
def test_fresh_rows_are_those_of_the_join(spark, monkeypatch, places, slice_rows):
    monkeypatch.setattr(fresh, "MOST_PLACES", places)
    monkeypatch.setattr(fresh, "SLICE_ROWS", slice_rows)
    rng = random.Random(places)
    batch = spark.createDataFrame(_rows(rng, 300, 400), SCHEMA)
    target = spark.createDataFrame(_rows(rng, 200, 400), SCHEMA)
    keys = ["part", "id"]
    with fresh.fresh_rows(batch, target.select(*keys), keys) as rows:
        assert _sorted(rows) == _sorted(new_rows(target, batch, keys).select(*batch.columns))

    def pick(df):
        return first_per_key(df, keys, ["v"])

    with fresh.fresh_rows(batch, target.select(*keys), keys, pick) as rows:
        assert _sorted(rows) == _sorted(new_rows(target, pick(batch), keys).select(*batch.columns))
    with fresh.fresh_rows(batch, None, keys, pick) as rows:
        assert _sorted(rows) == _sorted(pick(batch))


def test_keys_of_other_types_are_joined(spark):
    batch = spark.createDataFrame([("7", 1), ("8", 2)], "id string, v long")
    target = spark.createDataFrame([(7,)], "id int")
    with fresh.fresh_rows(batch, target, ["id"]) as rows:
        assert [r["v"] for r in rows.collect()] == [2]


def test_only_rows_that_share_a_key_are_compared(spark, tmp_path):
    root, seen = str(tmp_path / "t"), []

    def pick(rows):
        seen.append(rows.count())
        return first_per_key(rows, ["part", "id"], ["v"])

    batch = spark.range(5000).select(F.lit("a").alias("part"), F.greatest("id", F.lit(10)).cast("string").alias("id"), F.col("id").alias("v"))
    sinks.append_new(batch, root, ["part", "id"], ["part"], pick=pick)
    assert spark.read.parquet(root).count() == 4990
    assert spark.read.parquet(root).where("id = 10").first()["v"] == 0
    assert 11 <= seen[0] < 500


def test_a_merge_leaves_no_shuffles(spark, tmp_path):
    root = str(tmp_path / "t")
    batch = spark.range(2000).select(F.lit("a").alias("part"), F.col("id").cast("string").alias("id"))
    before = _shuffle_files(spark)
    sinks.append_new(batch.where("id < 500").repartition(3), root, ["part", "id"], ["part"])
    sinks.append_new(batch.repartition(3), root, ["part", "id"], ["part"])
    assert not _shuffle_files(spark) - before
    assert spark.read.parquet(root).count() == 2000


def test_settings_come_back(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), frugal_writes(spark):
        assert spark.conf.get(name) != before
        raise ValueError
    assert spark.conf.get(name) == before


def _feed(spark, n):
    src = spark.range(n).select(F.col("id").cast("string").alias("id"), (F.col("id") % 7).cast("string").alias("v"))
    return to_raw_records(src, SPEC, "run-1999", "1999-05-01 00:00:00")


def test_indexed_appends_work_the_records_out_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(queries_io.bindings, "raw_records", lambda s, d: calls.append(d) or _feed(s, 300))
    got = queries_io._append_indexed(spark, "")
    columns = ["dataset_name", "source_row_id", "record_hash", "run_id"]
    assert _sorted(got.select(*columns)) == _sorted(_feed(spark, 300).select(*columns))
    assert len(calls) == 1


def test_an_indexed_append_leaves_no_shuffles(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fresh, "SLICE_ROWS", 100)
    root = str(tmp_path / "t")
    before = _shuffle_files(spark)
    for n in (300, 400, 400):
        key_index.append_indexed(_feed(spark, n).drop("payload"), root, ["dataset_name", "source_row_id"])
    assert not _shuffle_files(spark) - before
    assert spark.read.parquet(root).count() == 400
