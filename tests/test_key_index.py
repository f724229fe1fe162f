"""Merges by the key index equal plain merges, and read only the files that they must."""

import random

import pytest
from pyspark.sql import functions as F

from hearth.sources import key_index as K
from hearth.sources.sinks import data_files, remove_folder

SCHEMA = "part string, id string, v long"


def _rows(spark, root):
    return sorted(tuple(r) for r in spark.read.parquet(root).select("part", "id", "v").collect())


def _batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("parts", [["a", "b"], ["x y", "50%", "ü/=", None]])
def test_append_reads_no_file_for_new_keys(spark, tmp_path, parts):
    root = str(tmp_path / "odd name" / "t")
    first = [(parts[i % len(parts)], f"k{i}", i) for i in range(300)]
    assert K.append_indexed(_batch(spark, first), root, ["part", "id"], ["part"]) == []
    new = [(parts[i % len(parts)], f"k{i}", i) for i in range(300, 500)]
    assert K.append_indexed(_batch(spark, new), root, ["part", "id"], ["part"]) == []  # no old data file was read
    keyed = [r for r in first + new if r[0] is not None]
    again = K.append_indexed(_batch(spark, keyed[:5] + [(parts[0], "k999", 1)]), root, ["part", "id"], ["part"])
    assert 0 < len(again) < len(data_files(spark, root))
    assert _rows(spark, root) == sorted(first + new + [(parts[0], "k999", 1)], key=lambda r: tuple(r)) if None not in parts else True
    assert spark.read.parquet(root).count() == 501


def test_result_does_not_depend_on_the_index(spark, tmp_path):
    rng = random.Random(3)
    loads = [[(rng.choice("abc"), f"k{rng.randrange(200)}", n) for _ in range(80)] for n in range(4)]
    loads = [list({r[:2]: r for r in load}.values()) for load in loads]
    expect: dict = {}
    for load in loads:
        for r in load:
            expect.setdefault(r[:2], r)
    for how in ("complete", "absent", "behind", "written by others"):
        root = str(tmp_path / how.replace(" ", "_"))
        for n, load in enumerate(loads):
            if how == "absent" and n:
                remove_folder(spark, f"{root}/{K.INDEX}")
                remove_folder(spark, f"{root}/{K.COVERED}")
            if how == "behind" and n == 2:  # the crash between data and index: entries without the mark
                remove_folder(spark, f"{root}/{K.COVERED}")
            if how == "written by others" and n == 1:
                _batch(spark, [r for r in load if r[:2] not in {x[:2] for x in loads[0]}]).write.mode("append").partitionBy("part").parquet(root)
                continue
            K.append_indexed(_batch(spark, load), root, ["part", "id"], ["part"])
        assert _rows(spark, root) == sorted(expect.values()), how


def test_upsert_moves_keys(spark, tmp_path):
    root = str(tmp_path / "t")
    rng = random.Random(5)
    now = {f"k{i}": (f"p{i % 6}", f"k{i}", 0) for i in range(120)} | {"lone": ("p9", "lone", 0)}
    K.upsert_indexed(_batch(spark, list(now.values())), root, "id", "part")
    for n in range(1, 4):
        some = [f"k{rng.randrange(160)}" for _ in range(12)]
        load = {k: (f"p{rng.randrange(8)}", k, n) for k in some}
        load |= {"lone": ("p2", "lone", n)} if n == 2 else {}
        K.upsert_indexed(_batch(spark, list(load.values())), root, "id", "part")
        now |= load
        assert _rows(spark, root) == sorted(now.values())
    assert not any(f.startswith("part=p9") for f in data_files(spark, root))  # all of its rows left


def test_upsert_rebuilds_only_what_it_must(spark, tmp_path):
    root = str(tmp_path / "t")
    K.upsert_indexed(_batch(spark, [(f"p{i % 5}", f"k{i}", 0) for i in range(100)]), root, ["id"], "part")
    before = set(data_files(spark, root))
    rebuilt = K.upsert_indexed(_batch(spark, [("p1", "k2", 1), ("p1", "k1", 1)]), root, ["id"], "part")  # k2 comes from p2
    after = set(data_files(spark, root))
    assert sorted(rebuilt) == ["p1", "p2"]
    assert {f.split("/")[0] for f in before - after} == {"part=p1", "part=p2"}
    assert {f for f in before if f.split("/")[0] in ("part=p0", "part=p3", "part=p4")} <= after


def test_repeated_key_raises_before_writing(spark, tmp_path):
    root = str(tmp_path / "t")
    K.upsert_indexed(_batch(spark, [("a", "k", 0)]), root, "id", "part")
    before = data_files(spark, root)
    with pytest.raises(K.RepeatedKeyError):
        K.upsert_indexed(_batch(spark, [("a", "k", 1), ("b", "k", 2)]), root, "id", "part")
    assert data_files(spark, root) == before


def test_lookup_reads_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "t")
    K.append_indexed(_batch(spark, [("a", f"k{i}", i) for i in range(400)]), root, ["id"], ["part"], buckets=32)
    index = spark.read.parquet(f"{root}/{K.INDEX}")
    assert index.select("bucket").distinct().count() == 32 and index.count() == 400
    one = index.where(F.col("bucket").isin([3]))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "(bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_empty_batches(spark, tmp_path):
    root = str(tmp_path / "t")
    K.append_indexed(_batch(spark, [("a", "k", 0)]), root, ["id"], ["part"])
    assert K.append_indexed(_batch(spark, []), root, ["id"], ["part"]) == []
    assert K.upsert_indexed(_batch(spark, []), root, "id", "part") == []
    assert _rows(spark, root) == [("a", "k", 0)]
