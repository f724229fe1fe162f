"""Records are landed with like rows together and by writes that leave no shuffles and sort no whole rows; rows are the same."""

import gzip
import os

from pyspark.sql import functions as F

from hearth.operators.envelope import SourceSpec, to_raw_records
from hearth.plans import bindings, queries_io
from hearth.sources import sinks
from hearth.sources.files import read_normalized

SMOKE = "/root/testdata/sf0.001"
SPEC = SourceSpec("feed_o", "t", "u", ("id",))


def _files(root):
    return [os.path.join(p, f) for p, _, names in os.walk(root) for f in names if not f.startswith((".", "_"))]


def _text(df):
    return sorted(str(r) for r in df.drop("original_s3_key").collect())


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _feed(spark, n):
    src = spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("v"))
    return to_raw_records(src.repartition(3), SPEC, "run-1999", "1999-05-01 00:00:00")


def _tables(spark, root, n):
    """The tables that permits are made of, with ``n`` line items of a year."""

    def pick(seed, among):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(among))

    spark.range(n).select(
        F.col("id").alias("l_orderkey"), pick(1, 200).alias("l_partkey"), pick(2, 100).alias("l_suppkey"), pick(3, 7).cast("int").alias("l_linenumber"),
        (pick(4, 90000) / 7).alias("l_extendedprice"), F.when(pick(5, 2) == 0, "A").otherwise("N").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.date_add(F.lit("1997-01-01").cast("date"), pick(6, 300).cast("int")).cast("timestamp_ntz").alias("l_shipdate"),
    ).write.parquet(f"{root}/lineitem.parquet")
    named = F.concat(F.lit("Supplier#"), F.col("id").cast("string")).alias("s_name")
    spark.range(100).select(F.col("id").alias("s_suppkey"), named, (F.col("id") % 25).alias("s_nationkey")).write.parquet(f"{root}/supplier.parquet")
    spark.range(200).select(F.col("id").alias("p_partkey"), F.when(pick(7, 2) == 0, "LARGE").otherwise("ECONOMY").alias("p_type")).write.parquet(f"{root}/part.parquet")
    return root


def test_landed_rows_are_together_and_the_same(spark, tmp_path):
    plain, ordered = str(tmp_path / "plain"), str(tmp_path / "ordered")
    for small, root in ((bindings.raw_records(spark, SMOKE), plain), (queries_io._records(spark, SMOKE), ordered)):
        queries_io._land(small, f"{root}-small")
    assert _text(read_normalized(spark, f"{plain}-small")) == _text(read_normalized(spark, f"{ordered}-small"))
    larger = _tables(spark, str(tmp_path), 20000)
    queries_io._land(bindings.permits_raw(spark, larger).coalesce(1), plain)
    with bindings.like_rows_together():
        queries_io._land(bindings.permits_raw(spark, larger).coalesce(1), ordered)
    sizes = [sum(os.path.getsize(f) for f in _files(root)) for root in (plain, ordered)]
    assert sizes[1] < 0.95 * sizes[0], sizes


def test_order_is_for_the_records_built_inside(spark):
    with bindings.like_rows_together():
        inside = bindings.permits_raw(spark, SMOKE)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (inside, bindings.permits_raw(spark, SMOKE))]
    assert ["Sort [" in p for p in plans] == [True, False]


def test_landing_leaves_no_shuffles(spark, tmp_path):
    before = _shuffle_files(spark)
    sinks.write_normalized(_feed(spark, 200), str(tmp_path / "l"))
    assert not _shuffle_files(spark) - before
    assert read_normalized(spark, str(tmp_path / "l")).count() == 200


def test_tolerant_scan_works_its_records_out_once(spark, tmp_path, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    def records(s, d):
        return _feed(s, 50).withColumn("source_row_id", counted("source_row_id"))

    monkeypatch.setattr(queries_io, "_fresh", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(queries_io.bindings, "raw_records", records)
    before = _shuffle_files(spark)
    out = queries_io._jsonl_tolerant(spark, "")
    assert seen.value == 50 and not _shuffle_files(spark) - before
    assert _text(out) == _text(_feed(spark, 50))
    lines = [line for f in _files(tmp_path) for line in gzip.open(f, "rt").read().splitlines()]
    assert len(lines) == 100 and sum("broken" in line for line in lines) == 50
