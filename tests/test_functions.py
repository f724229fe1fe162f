import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from hearth.functions import (
    band,
    days_between,
    decode,
    money,
    parse_bool,
    safe_ratio,
    split_literal,
    surrogate_key,
    try_date,
    try_decimal,
    try_number,
    try_timestamp,
)


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_try_date(spark):
    x = F.col("x")
    assert one(spark, try_date(x), "2024-01-03") == dt.date(2024, 1, 3)
    assert one(spark, try_date(x), "2024-01-03T00:00:00.000") == dt.date(2024, 1, 3)
    assert one(spark, try_date(x), "1/3/2024") == dt.date(2024, 1, 3)
    assert one(spark, try_date(x), "2024-02-30") is None
    assert one(spark, try_date(x), "2024") is None
    assert one(spark, try_date(x), "") is None
    assert one(spark, try_date(x), None) is None


def test_try_decimal_and_number(spark):
    x = F.col("x")
    assert one(spark, try_decimal(x, 12, 2), "1.005") == Decimal("1.01")
    assert one(spark, try_decimal(x, 12, 2), "") is None
    assert one(spark, try_decimal(x, 12, 2), "call for price") is None
    assert one(spark, try_decimal(x, 12, 2), "12345678901.5") is None  # overflow
    assert one(spark, try_number(x), "3.7") == Decimal(4)
    assert one(spark, try_number(x), "2.5") == Decimal(3)
    assert one(spark, try_number(x), "seven") is None


def test_try_timestamp(spark):
    x = F.col("x")
    assert one(spark, try_timestamp(x), "2024-01-01T02:00:07+02:00") == dt.datetime(2024, 1, 1, 0, 0, 7)
    assert one(spark, try_timestamp(x), "yesterday") is None


def test_surrogate_key_propagates_null(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "p string, q string")
    keys = [r["k"] for r in df.select(surrogate_key("p", "q").alias("k")).collect()]
    assert keys[0] == "d0726241020676b14aa6298ce6a18b21"  # md5('a|b')
    assert keys[1] is None


def test_money_split_bool_decode(spark):
    x = F.col("x")
    assert one(spark, money(x, 14, 2), "$1,234.50") == Decimal("1234.50")
    assert one(spark, money(x, 14, 2), "-$5.00") == Decimal("5.00")
    assert one(spark, money(x, 14, 2), "1.2.3") is None
    assert one(spark, split_literal(x, "|"), "a|b||") == ["a", "b", "", ""]
    assert one(spark, split_literal(x, "|"), None) == [""]
    assert one(spark, parse_bool(x), "TRUE") is True
    assert one(spark, parse_bool(x), "True ") is False
    assert one(spark, parse_bool(x), None) is None
    assert one(spark, decode(x, {"M": "Manhattan"}), "M") == "Manhattan"
    assert one(spark, decode(x, {"M": "Manhattan"}), "Zz") == "Zz"


def test_band_ratio_days(spark):
    df = spark.createDataFrame([(160.0,), (80.0,), (None,)], "v double")
    bands = [r[0] for r in df.select(band(F.abs(F.coalesce("v", F.lit(0.0))), [(150, "high"), (75, "moderate")], "stable")).collect()]
    assert bands == ["high", "moderate", "stable"]
    assert one(spark, safe_ratio(F.lit(1.0), F.col("x")), 0.0, "x double") is None
    d = spark.createDataFrame([(dt.date(2026, 3, 18), dt.date(2026, 4, 30))], "a date, b date")
    assert d.select(days_between("a", "b")).first()[0] == 43


def test_utc_helpers_ignore_session_zone(spark):
    from hearth.functions import utc_instant, utc_literal, utc_text

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("select timestamp_ntz'2001-11-04 00:00:00' n, '2024-01-01 10:00:00' s, '2024-01-01T02:00:07+02:00' o")
        r = df.select(
            utc_text(utc_instant("n")).alias("a"),
            utc_text(try_timestamp("s", assume_utc=True)).alias("b"),
            utc_text(try_timestamp("o", assume_utc=True)).alias("c"),
            utc_text(utc_literal("2001-09-01 00:00:00")).alias("d"),
        ).first()
        assert tuple(r) == ("2001-11-04 00:00:00", "2024-01-01 10:00:00", "2024-01-01 00:00:07", "2001-09-01 00:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
