"""Outer joins keep rows with a NULL key and do not put them into one task."""

import pytest
from pyspark.sql import functions as F

from hearth.operators.joins import full_outer_coalesce, left_chain


@pytest.fixture
def one_task_a_partition(spark):
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _facts(spark, n=6000):
    """A third of the keys is NULL."""
    return spark.range(n).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 400).alias("zip"), (F.col("id") * 7).alias("v"))


def _largest(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes), sum(sizes) / 16


def test_chain_spreads_null_keys(spark, one_task_a_partition):
    facts = _facts(spark)
    dims = [spark.range(0, 400, k).select(F.col("id").alias("zip"), (F.col("id") * k).alias("w")) for k in (2, 3)]
    out = left_chain(facts, [(dims[0], "a__", "zip"), (dims[1], "b__", ("zip", "zip"))])
    assert out.columns == ["id", "zip", "v", "a__zip", "a__w", "b__zip", "b__w"]
    most, mean = _largest(out)
    assert most < 2 * mean
    plain = facts.alias("f").join(dims[0].alias("a"), F.col("f.zip") == F.col("a.zip"), "left")
    assert _largest(plain)[0] > 4 * mean  # what it is without
    expect = plain.join(dims[1].alias("b"), F.col("f.zip") == F.col("b.zip"), "left").select("f.*", "a.zip", "a.w", "b.zip", "b.w").toDF(*out.columns)
    assert out.exceptAll(expect).isEmpty() and expect.exceptAll(out).isEmpty()


def test_chain_fans_out_and_keeps_all_rows(spark):
    facts = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (3, None)], "id int, k string")
    many = spark.createDataFrame([("x", 1), ("x", 2), (None, 3)], "k string, w int")
    rows = sorted(map(tuple, left_chain(facts, [(many, "m__", "k")]).collect()), key=str)
    assert rows == sorted([(1, "x", "x", 1), (1, "x", "x", 2), (2, "y", None, None), (3, None, None, None), (3, None, None, None)], key=str)
    assert left_chain(facts.limit(0), [(many, "m__", "k")]).count() == 0


def test_full_outer_spreads_null_keys_of_both_sides(spark, one_task_a_partition):
    left, right = _facts(spark), _facts(spark).withColumnRenamed("v", "w").withColumn("id", F.col("id") + 10_000_000)
    left, right = (d.dropDuplicates(["zip"]).unionByName(d.where("zip is null")) for d in (left, right))
    out = full_outer_coalesce(left, right, ["zip"])
    expect = left.alias("l").join(right.alias("r"), F.col("l.zip") == F.col("r.zip"), "full_outer").toDF(*out.columns)
    assert out.exceptAll(expect).isEmpty() and expect.exceptAll(out).isEmpty()
    most, mean = _largest(out)
    assert most < 2 * mean
