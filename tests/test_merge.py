import pytest
from pyspark.sql import functions as F

from hearth.operators.joins import full_outer_coalesce
from hearth.operators.merge import DuplicateKeyError, incremental, insert_ignore, merge_insert, upsert

KEYS = ["dataset_name", "source_row_id", "record_hash"]
SCHEMA = "dataset_name string, source_row_id string, record_hash string, v int"


def test_merge_insert_idempotent_and_keeps_batch_duplicates(spark):
    target = spark.createDataFrame([("a", "1", "h1", 1)], SCHEMA)
    batch = spark.createDataFrame([("a", "1", "h1", 9), ("a", "2", "h2", 2), ("a", "2", "h2", 3)], SCHEMA)
    once = merge_insert(target, batch, KEYS)
    twice = merge_insert(once, batch, KEYS)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert sorted(r["v"] for r in once.collect()) == [1, 2, 3]


def test_insert_ignore_collapses_batch_duplicates(spark):
    target = spark.createDataFrame([("a", "1", "h1", 1)], SCHEMA)
    batch = spark.createDataFrame([("a", "2", "h2", 3), ("a", "2", "h2", 2)], SCHEMA)
    out = insert_ignore(target, batch, KEYS, order=["v"])
    assert sorted(r["v"] for r in out.collect()) == [1, 2]


def test_upsert_rejects_duplicate_batch_keys(spark):
    t = spark.createDataFrame([("k", 1)], "id string, v int")
    with pytest.raises(DuplicateKeyError):
        upsert(t, spark.createDataFrame([("k", 2), ("k", 3)], "id string, v int"), "id")
    out = upsert(t, spark.createDataFrame([("k", 2), ("j", 3)], "id string, v int"), "id")
    assert sorted(tuple(r) for r in out.collect()) == [("j", 3), ("k", 2)]


def test_incremental_equals_full_refresh_without_late_rows(spark):
    full = spark.createDataFrame([(f"id{i}", i, i * 10) for i in range(10)], "id string, day int, v int")
    first_run = full.where(F.col("day") < 6)
    inc = incremental(full, first_run, "id", "day")
    assert sorted(inc.collect()) == sorted(full.collect())


def test_full_outer_null_tolerant_key(spark):
    left = spark.createDataFrame([("z1", None, 1), (None, "a", 2), ("z2", "x", 3)], "zip string, nta string, h int")
    right = spark.createDataFrame([("z1", "", 10), (None, "a", 20), ("z2", None, 30)], "zip string, nta string, p int")
    j = full_outer_coalesce(left, right, on=["zip", "nta"], null_as={"nta": ""})
    rows = sorted(((r["l__h"] or 0), (r["r__p"] or 0)) for r in j.collect())
    # NULL and '' NTA match; NULL zips never match and both survive unmatched
    assert rows == sorted([(1, 10), (2, 0), (0, 20), (3, 0), (0, 30)])


def test_append_new_is_replay_safe(spark):
    import tempfile

    from hearth.sources.sinks import append_new

    root = tempfile.mkdtemp(prefix="hearth-append-") + "/t"
    batch = spark.createDataFrame([("a", "1", "h1", 1), ("a", "2", "h2", 2)], SCHEMA)
    append_new(batch, root, KEYS)
    append_new(batch, root, KEYS)  # replay: nothing new
    append_new(spark.createDataFrame([("a", "3", "h3", 3), ("a", "1", "h1", 9)], SCHEMA), root, KEYS)
    assert sorted(r["v"] for r in spark.read.parquet(root).collect()) == [1, 2, 3]


def test_upsert_partitions_rewrites_only_recent_partitions(spark):
    import os
    import tempfile

    from hearth.sources.sinks import upsert_partitions

    root = tempfile.mkdtemp(prefix="hearth-upsert-") + "/t"
    first = spark.createDataFrame([(f"id{i}", i % 5, i) for i in range(10)], "id string, day int, v int")
    upsert_partitions(first, root, "id", "day")
    old_files = {f for f in os.listdir(f"{root}/day=0")}
    second = spark.createDataFrame([(f"id{i}", i % 5, i * 100) for i in range(10) if i % 5 >= 4] + [("new", 4, 7)], "id string, day int, v int")
    upsert_partitions(second, root, "id", "day")
    got = sorted((r["id"], r["day"], r["v"]) for r in spark.read.parquet(root).collect())
    want = sorted([(f"id{i}", i % 5, i) for i in range(10) if i % 5 < 4] + [(f"id{i}", 4, i * 100) for i in (4, 9)] + [("new", 4, 7)])
    assert got == want
    assert {f for f in os.listdir(f"{root}/day=0")} == old_files  # untouched partition


def test_upsert_partitions_coarse_partition_keeps_rows_before_the_mark(spark):
    import tempfile

    from hearth.sources.sinks import upsert_partitions

    root = tempfile.mkdtemp(prefix="hearth-upsert2-") + "/t"
    first = spark.createDataFrame([("a", 1, 10, 1), ("b", 2, 10, 2), ("c", 3, 10, 3)], "id string, day int, month int, v int")
    upsert_partitions(first, root, "id", "day", "month")
    second = spark.createDataFrame([("c", 3, 10, 30), ("d", 4, 10, 4)], "id string, day int, month int, v int")
    upsert_partitions(second, root, "id", "day", "month")
    got = sorted((r["id"], r["v"]) for r in spark.read.parquet(root).collect())
    assert got == [("a", 1), ("b", 2), ("c", 30), ("d", 4)]
