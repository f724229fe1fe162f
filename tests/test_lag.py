import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hearth.operators.windows import with_lags


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_ranked_lag_equals_window_with_hot_key(spark, parts):
    rnd = random.Random(3)
    rows = []
    for i in range(2000):
        k = "hot" if i % 3 == 0 else (None if i % 17 == 0 else f"k{i % 41}")
        rows.append((k, rnd.randint(0, 300), i, None if i % 23 == 0 else float(rnd.randint(1, 999))))
    df = spark.createDataFrame(rows, "k string, d int, id int, v double")
    ranked = with_lags(df, ["k"], ["d", "id"], [("v", "prev_v")], strategy="ranked", partitions=parts)
    w = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_last(), F.col("id").asc_nulls_last())
    plain = df.withColumn("prev_v", F.lag("v").over(w))
    assert sorted(map(tuple, ranked.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_ranked_lag_with_spark_chosen_partitions(spark):
    df = spark.createDataFrame([("hot" if i % 2 else f"k{i % 7}", i // 3, i, float(i)) for i in range(500)], "k string, d int, id int, v double")
    ranked = with_lags(df, ["k"], ["d", "id"], [("v", "prev_v")], strategy="ranked")
    w = Window.partitionBy("k").orderBy("d", "id")
    plain = df.withColumn("prev_v", F.lag("v").over(w))
    assert sorted(map(tuple, ranked.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
