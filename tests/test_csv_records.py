"""CSV with quoted newlines over many splits equals the reader that takes whole files."""

import random

import pytest
from pyspark.sql import functions as F

from hearth.sources.csv_records import open_ranges, physical_lines
from hearth.sources.files import read_csv_rows


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _field(rng):
    kind = rng.randrange(9)
    text = "".join(rng.choice("ab ,;é") for _ in range(rng.randrange(12)))
    if kind == 0:
        return '"' + text.replace(",", "\n") + '\n\n, ""quoted"" \n"'
    if kind == 1:
        return '"' + "line\n" * rng.randrange(1, 60) + '"'  # longer than several splits at times
    if kind == 2:
        return '""'
    if kind == 3:
        return '"""\n"""'
    return text.replace(",", "").replace(";", "")


def _write(path, rows, header="id,name,note", newline="\n", bom=False):
    text = newline.join([header, *rows]) + newline
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())


def _same(spark, path):
    whole, split = read_csv_rows(spark, path), read_csv_rows(spark, path, multiline="split")
    assert split.columns == whole.columns
    key = lambda r: [str(x) for x in r]
    got, expect = sorted(map(tuple, split.collect()), key=key), sorted(map(tuple, whole.collect()), key=key)
    assert got == expect and expect
    return expect


@pytest.mark.parametrize("seed", range(4))
def test_one_file_over_many_tasks(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    rows = [f"{i},{_field(rng)},{_field(rng)}" for i in range(250)]
    for k in range(0, 250, 40):
        rows.insert(k, "")  # blank lines
    path = tmp_path / "one.csv"
    _write(path, rows, bom=seed == 1)
    lines = physical_lines(spark, str(path))
    ranges = open_ranges(lines)
    assert len(ranges) > 10 and any(ranges.values()) and not all(ranges.values())
    assert lines.rdd.getNumPartitions() > 10
    assert len(_same(spark, str(path))) == 250


def test_a_field_longer_than_several_splits(spark, tmp_path, small_splits):
    path = tmp_path / "long.csv"
    _write(path, ['1,"' + "x\n" * 3000 + '",a', "2,b,c", '3,"' + '""\n' * 2000 + '",d'])
    rows = _same(spark, str(path))
    assert sorted(len(r[1]) for r in rows) == [1, 3 * 2000 - 2000, 6000]


def test_files_with_other_headers(spark, tmp_path, small_splits):
    rng = random.Random(8)
    _write(tmp_path / "a.csv", [f"{i},{_field(rng)},{_field(rng)}" for i in range(80)])
    _write(tmp_path / "b.csv", [f"{_field(rng)},{i}" for i in range(60)], header="name,2024-01-01")
    _write(tmp_path / "c.csv", [], header="id,name,note")
    assert len(_same(spark, str(tmp_path))) == 140


def test_windows_line_ends(spark, tmp_path, small_splits):
    rng = random.Random(2)
    _write(tmp_path / "w.csv", [f"{i},plain {i},{rng.choice(['x', '', ' y '])}" for i in range(200)], newline="\r\n")
    assert len(_same(spark, str(tmp_path / "w.csv"))) == 200


def test_short_and_long_rows(spark, tmp_path, small_splits):
    _write(tmp_path / "s.csv", ["1", "2,b", "3,b,c", "4,,", ",,", '"",,""'] * 40)
    _same(spark, str(tmp_path / "s.csv"))


def test_only_a_header(spark, tmp_path):
    _write(tmp_path / "h.csv", [])
    out = read_csv_rows(spark, str(tmp_path / "h.csv"), multiline="split")
    assert out.columns == ["id", "name", "note"] and out.count() == 0


def test_parsing_stays_with_spark(spark, tmp_path):
    _write(tmp_path / "p.csv", ["1,a,b"])
    plan = read_csv_rows(spark, str(tmp_path / "p.csv"), multiline="split").select(F.col("id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "from_csv" in plan.lower() or "csvtostructs" in plan.lower()
