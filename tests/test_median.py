import random

import pandas as pd
import pytest

from hearth.operators.aggregates import grouped_median


@pytest.mark.parametrize("strategy", ["builtin", "ranked"])
def test_median_matches_pandas_with_hot_group_and_null_keys(spark, strategy):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):  # one group holds about a third of the rows
        g = "hot" if i % 3 == 0 else (None if i % 11 == 0 else f"g{i % 17}")
        v = None if i % 13 == 0 else float(rnd.randint(0, 50))
        rows.append((g, i % 2, v))
    df = spark.createDataFrame(rows, "g string, h int, v double")
    got = {(r["g"], r["h"]): r["m"] for r in grouped_median(df, ["g", "h"], "v", "m", strategy, partitions=5).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "h", "v"]).fillna({"g": "<null>"})
    want = pdf.dropna(subset=["v"]).groupby(["g", "h"])["v"].median().to_dict()
    want = {(None if g == "<null>" else g, h): m for (g, h), m in want.items()}
    assert got == pytest.approx(want)


def test_ranked_median_plans_no_nested_loop(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "g string, v double")
    median = grouped_median(df, ["g"], "v", "m")
    assert "NestedLoop" not in median._jdf.queryExecution().executedPlan().toString()
    assert {r["g"]: r["m"] for r in median.collect()} == {"a": 2.0, "b": 2.0}


def test_ranked_median_with_spark_chosen_partitions(spark):
    rows = [("hot" if i % 3 else f"g{i % 5}", float(i % 37)) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["m"] for r in grouped_median(df, ["g"], "v", "m", "ranked").collect()}
    want = pd.DataFrame(rows, columns=["g", "v"]).groupby("g")["v"].median().to_dict()
    assert got == pytest.approx(want)
