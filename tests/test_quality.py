import datetime as dt

import pytest

from hearth.operators import quality
from hearth.plans.bindings import REQUIRED_DATASETS
from hearth.schemas import RAW_SCHEMA


def raw(spark, rows):
    full = [
        (n, "t", "u", rid, h, None, dt.datetime(2026, 5, 1), run, None, payload)
        for (n, rid, h, run, payload) in rows
    ]
    return spark.createDataFrame(full, RAW_SCHEMA)


def good_rows():
    return [(n, f"{n}-1", f"h-{n}", "r1", {"rent": "3000"}) for n in REQUIRED_DATASETS]


def test_gate_passes(spark):
    report = quality.quality_report(raw(spark, good_rows()), REQUIRED_DATASETS)
    assert set(quality.enforce(report).values()) == {"passed"}


def test_gate_fails_on_missing_dataset(spark):
    rows = [r for r in good_rows() if r[0] != "mta_subway_stations"]
    with pytest.raises(quality.ValidationError, match="loaded 5 of 6 required datasets"):
        quality.enforce(quality.quality_report(raw(spark, rows), REQUIRED_DATASETS))


def test_gate_fails_on_duplicate_hash_within_run(spark):
    rows = good_rows() + [("listing_snapshots", "other", "h-listing_snapshots", "r1", {"rent": "1"})]
    with pytest.raises(quality.ValidationError, match="duplicate_record_hashes failed: listing_snapshots:h-listing_snapshots:r1"):
        quality.enforce(quality.quality_report(raw(spark, rows), REQUIRED_DATASETS))
    # the same hash in a later run is not a violation
    later = good_rows() + [("listing_snapshots", "listing_snapshots-1", "h-listing_snapshots", "r2", {"rent": "3000"})]
    quality.enforce(quality.quality_report(raw(spark, later), REQUIRED_DATASETS))


def test_gate_fails_on_invalid_rent(spark):
    rows = good_rows() + [
        ("listing_snapshots", "x", "hx", "r1", {"rent": "n/a"}),
        ("listing_snapshots", "y", "hy", "r1", {}),
    ]
    with pytest.raises(quality.ValidationError, match="2 listing snapshots have invalid rent"):
        quality.enforce(quality.quality_report(raw(spark, rows), REQUIRED_DATASETS))


def test_unknown_check_not_applicable(spark):
    report = quality.quality_report(raw(spark, good_rows()), REQUIRED_DATASETS, ["create_table"])
    assert [tuple(r) for r in report.collect()] == [("create_table", "not_applicable", "")]


def test_not_null_unique_relationships(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, "y")], "k string, v string")
    assert sorted(tuple(r) for r in quality.not_null(df, ["k", "v"]).collect()) == [("k", 1), ("v", 1)]
    assert [tuple(r) for r in quality.unique(df, "k").collect()] == [("a", 2)]
    parent = spark.createDataFrame([("a",)], "k string")
    child = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert [r["k"] for r in quality.relationships(child, "k", parent, "k").collect()] == ["b"]


def test_freshness_states(spark):
    df = raw(spark, good_rows())
    state = lambda h: quality.freshness(df, dt.datetime(2026, 5, 1) + dt.timedelta(hours=h), "ingested_at").first()["freshness_state"]
    assert (state(1), state(40), state(80)) == ("pass", "warn", "error")


def test_missing_datasets_lists_absent_names(spark):
    rows = [r for r in good_rows() if r[0] not in ("zillow_zori_zip", "listing_snapshots")]
    got = sorted(r[0] for r in quality.missing_datasets(spark, raw(spark, rows), REQUIRED_DATASETS).collect())
    assert got == ["listing_snapshots", "zillow_zori_zip"]
