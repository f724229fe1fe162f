import json
import os
import tempfile

from pyspark.sql import functions as F

import pytest
from hearth.operators.envelope import SourceSpec, to_raw_records
from hearth.sources.catalog import register_raw_table
from hearth.sources.files import read_csv_rows, read_json_rows, read_normalized
from hearth.sources.sinks import append_audit, read_current, write_normalized, write_version


def _dir():
    return tempfile.mkdtemp(prefix="hearth-src-")


def test_csv_quotes_newlines_blank_lines_and_empties(spark):
    d = _dir()
    with open(os.path.join(d, "a.csv"), "w", encoding="utf-8") as fh:
        fh.write('﻿id,name,note\n1,Ada," spaced "\n\n2,"Grace, ""G""\nHopper",\n3,,""\n')
    rows = sorted(tuple(r) for r in read_csv_rows(spark, d).collect())
    assert rows == [("1", "Ada", " spaced "), ("2", 'Grace, "G"\nHopper', ""), ("3", "", "")]


def test_json_documents(spark):
    d = _dir()
    docs = {
        "a.json": [{"id": 1, "name": "Ada"}, 5, "x"],
        "b.json": {"records": [], "data": [{"id": 2, "nested": {"k": [1, 2]}}]},
        "c.json": {"rows": [{"id": 3}]},
        "d.json": "just text",
        "e.json": {"records": {"id": 4}, "data": [{"id": 5}]},
    }
    for name, doc in docs.items():
        with open(os.path.join(d, name), "w") as fh:
            json.dump(doc, fh)
    rows = read_json_rows(spark, d).select("row").collect()
    got = sorted((r["row"]["id"], r["row"].get("name"), r["row"].get("nested")) for r in rows)
    assert got == [("1", "Ada", None), ("2", None, '{"k":[1,2]}'), ("3", None, None)]


def test_jsonl_roundtrip_skips_bad_lines_and_repairs_partitions(spark):
    spec = SourceSpec("feed_a", "t", "u", ("id",))
    src = spark.createDataFrame([("1", "x"), ("2", None)], "id string, v string")
    raw = to_raw_records(src, spec, "run-1", "2026-05-01 00:00:00")
    root = _dir() + "/landed"
    write_normalized(raw, root)
    back = read_normalized(spark, root).collect()
    assert sorted(r["source_row_id"] for r in back) == ["1", "2"]
    assert {r["dataset_name"] for r in back} == {"feed_a"}
    assert [r["payload"] for r in back if r["source_row_id"] == "2"][0] == {"id": "2", "v": None}
    part = [p for p, _, files in os.walk(root) if any(f.endswith(".json") for f in files)][0]
    with open(os.path.join(part, "part-bad.json"), "w") as fh:
        fh.write('{"source_row_id": "3", "payload": {"id": \n')
    assert read_normalized(spark, root).count() == 2
    with_rejects = read_normalized(spark, root, keep_rejects=True)
    rejects = with_rejects.where(F.col("_corrupt_record").isNotNull()).select("source_row_id", "_corrupt_record").collect()
    assert len(rejects) == 1
    table = register_raw_table(spark, "raw_records_test", root)
    assert table.where("dataset_name = 'feed_a'").count() == 2


def test_versions_and_audit(spark):
    root = _dir()
    assert read_current(spark, root + "/t") is None
    write_version(spark.range(3), root + "/t")
    write_version(spark.range(5), root + "/t")
    assert read_current(spark, root + "/t").count() == 5
    append_audit(spark.range(7), "stage-a", root + "/audit")
    append_audit(spark.range(2), "stage-a", root + "/audit")
    assert sorted(r["rows_loaded"] for r in spark.read.parquet(root + "/audit").collect()) == [2, 7]


def test_materialize_view_and_table(spark):
    from hearth.sources.sinks import materialize

    root = _dir()
    view = materialize(spark.range(4), "staging", "stg_demo", root)
    assert spark.table("stg_demo").count() == 4 and view.count() == 4
    table = materialize(spark.range(6), "marts", "mart_demo", root)
    assert table.count() == 6 and spark.table("mart_demo").count() == 6
    again = materialize(spark.range(2), "marts", "mart_demo", root)  # new version, old one untouched
    assert again.count() == 2


def test_csv_without_multiline_splits(spark):
    d = _dir()
    with open(os.path.join(d, "b.csv"), "w", encoding="utf-8") as fh:
        fh.write("id,v\n" + "".join(f"{i},x{i}\n" for i in range(50)))
    rows = read_csv_rows(spark, d, multiline=False)
    assert rows.count() == 50 and set(rows.columns) == {"id", "v"}


def test_csv_files_follow_their_own_headers(spark):
    d = _dir()
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write("id,2026-01-01\n1,x\n")
    with open(os.path.join(d, "b.csv"), "w") as fh:
        fh.write("﻿id,2025-12-01,2026-01-01\n2,old,new\n3,,z\n")
    rows = sorted((r["id"], r["2025-12-01"], r["2026-01-01"]) for r in read_csv_rows(spark, d).collect())
    assert rows == [("1", None, "x"), ("2", "old", "new"), ("3", "", "z")]


def test_malformed_json_document_raises_or_is_skipped(spark):
    d = _dir()
    with open(os.path.join(d, "good.json"), "w") as fh:
        json.dump([{"id": 1}], fh)
    with open(os.path.join(d, "cut.json"), "w") as fh:
        fh.write('[{"id": 2}, {"id": ')
    with pytest.raises(Exception):
        read_json_rows(spark, d).collect()
    assert [r["row"]["id"] for r in read_json_rows(spark, d, malformed="skip").collect()] == ["1"]


def test_jsonl_count_does_not_depend_on_columns(spark):
    d = _dir()
    with open(os.path.join(d, "part-0.json"), "w") as fh:
        fh.write('{"dataset_name": "a", "source_row_id": "1", "payload": {"k": "v"}}\n')
        fh.write('{"dataset_name": "a", "source_row_id": "2", "payload": 5}\n')
        fh.write('{"dataset_name": "a", "source_row_id": "3", "payl\n')
    df = read_normalized(spark, d, as_of="2026-05-01 00:00:00")
    assert df.count() == len(df.collect()) == df.select("source_row_id").distinct().count() == df.select("loaded_at").count() == 1


def _damage(root):
    for folder, _, names in os.walk(root):
        for n in names:
            if n.endswith(".parquet"):
                with open(os.path.join(folder, n), "wb") as fh:
                    fh.write(b"broken")


def test_damaged_tables_raise_and_stay(spark):
    from hearth.sources.sinks import append_new, upsert_partitions

    df = spark.createDataFrame([("k1", "2024-01", "a"), ("k2", "2024-02", "a")], "id string, month string, dataset_name string")
    for write in (lambda r, x: upsert_partitions(x, r, "id", "month"), lambda r, x: append_new(x, r, ["dataset_name", "id"])):
        root = _dir() + "/t"
        write(root, df)
        _damage(root)
        before = sorted(n for _, _, names in os.walk(root) for n in names)
        with pytest.raises(Exception):
            write(root, df.where("id = 'k2'"))
        assert sorted(n for _, _, names in os.walk(root) for n in names) == before
    root = _dir() + "/v"
    version = write_version(df, root)
    _damage(version)
    with pytest.raises(Exception):
        read_current(spark, root).collect()


def test_upsert_refuses_repeated_and_moved_keys(spark):
    from hearth.operators.merge import DuplicateKeyError
    from hearth.sources.sinks import upsert_partitions

    schema = "id string, month string, v int"
    root = _dir() + "/t"
    upsert_partitions(spark.createDataFrame([("k1", "2024-01", 1), ("k2", "2024-02", 1)], schema), root, "id", "month")
    for batch in ([("k1", "2024-02", 2)], [("k3", "2024-03", 2), ("k3", "2024-03", 3)]):
        with pytest.raises(DuplicateKeyError):
            upsert_partitions(spark.createDataFrame(batch, schema), root, "id", "month")
    assert spark.read.parquet(root).count() == 2
