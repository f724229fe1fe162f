"""Hand-checked results on five seed listing rows (FIXTURES.md section 3)."""

import datetime as dt
import tempfile

import pytest

from hearth.operators.envelope import SourceSpec, to_raw_records
from hearth.plans import marts, staging
from hearth.plans.intermediate import int_transit_access_by_borough
from hearth.sources.files import read_csv_rows

# The seed listing feed (header and five rows).
SEED_CSV = """listing_id,snapshot_date,address,postal_code,neighborhood,borough,rent,bedrooms,bathrooms,sqft,property_type,amenities,status,listed_date,latitude,longitude
rp-nyc-0001,2026-03-31,214 W 109th St,10025,Upper West Side,Manhattan,3250,1,1,640,Apartment,"laundry|elevator|dishwasher",active,2026-03-18,40.80243,-73.96515
rp-nyc-0001,2026-04-30,214 W 109th St,10025,Upper West Side,Manhattan,3375,1,1,640,Apartment,"laundry|elevator|dishwasher",active,2026-03-18,40.80243,-73.96515
rp-nyc-0002,2026-03-31,41-12 29th St,11101,Long Island City,Queens,4100,2,2,910,Apartment,"doorman|gym|roof deck|in-unit laundry",active,2026-03-08,40.75039,-73.93690
rp-nyc-0002,2026-04-30,41-12 29th St,11101,Long Island City,Queens,4050,2,2,910,Apartment,"doorman|gym|roof deck|in-unit laundry",leased,2026-03-08,40.75039,-73.93690
rp-nyc-0003,2026-04-30,88 E 3rd St,10003,East Village,Manhattan,2895,0,1,430,Studio,"pets allowed|laundry",active,2026-04-10,40.72430,-73.98960
"""

SPEC = SourceSpec("listing_snapshots", "listings", "file://listings.csv", ("listing_id", "snapshot_date"))
MAR, APR = dt.date(2026, 3, 31), dt.date(2026, 4, 30)


@pytest.fixture(scope="module")
def listings(spark):
    folder = tempfile.mkdtemp(prefix="hearth-seed-")
    with open(f"{folder}/listing_snapshots.csv", "w", encoding="utf-8") as fh:
        fh.write("﻿" + SEED_CSV)
    rows = read_csv_rows(spark, folder)
    raw = to_raw_records(rows, SPEC, "run-seed", "2026-05-01 06:00:00")
    return staging.stg_listing_snapshots(raw)


def test_history(spark, listings):
    h = marts.fct_listing_history(listings)
    got = {
        (r["listing_id"][-1], r["snapshot_date"]): (
            r["days_on_market"],
            None if r["rent_change_amount"] is None else float(r["rent_change_amount"]),
            None if r["rent_change_pct"] is None else round(r["rent_change_pct"], 6),
        )
        for r in h.collect()
    }
    assert got == {
        ("1", MAR): (13, None, None),
        ("1", APR): (43, 125.0, 0.038462),
        ("2", MAR): (23, None, None),
        ("2", APR): (53, -50.0, -0.012195),
        ("3", APR): (20, None, None),
    }


@pytest.mark.parametrize("strategy", ["builtin", "ranked"])
def test_churn(spark, listings, strategy):
    churn = marts.mart_inventory_churn(marts.fct_listing_history(listings), strategy)
    got = {
        (r["postal_code"], r["snapshot_date"]): (
            r["listing_count"], r["active_listing_count"], r["leased_listing_count"], r["avg_listing_rent"],
            r["median_listing_rent"], r["listings_with_price_changes"], r["listing_count_delta"],
        )
        for r in churn.collect()
    }
    assert got == {
        ("10003", APR): (1, 1, 0, 2895.0, 2895.0, 0, None),
        ("10025", MAR): (1, 1, 0, 3250.0, 3250.0, 0, None),
        ("10025", APR): (1, 1, 0, 3375.0, 3375.0, 1, 0),
        ("11101", MAR): (1, 1, 0, 4100.0, 4100.0, 0, None),
        ("11101", APR): (1, 0, 1, 4050.0, 4050.0, 1, 0),
    }


def test_transit_price_effect(spark, listings):
    stations = spark.createDataFrame(
        [("1", "Manhattan", 2, 1, True), ("2", "Manhattan", None, 0, False)],
        "station_complex_id string, borough string, station_count int, ada_score int, in_cbd boolean",
    )
    out = marts.mart_transit_price_effect(listings, int_transit_access_by_borough(stations), "ranked")
    got = {
        (r["borough"], r["snapshot_date"]): (r["avg_listing_rent"], r["median_listing_rent"], r["listing_count"], r["station_complex_count"])
        for r in out.collect()
    }
    assert got == {
        ("Manhattan", MAR): (3250.0, 3250.0, 1, 2),
        ("Manhattan", APR): (3135.0, 3135.0, 2, 2),
        ("Queens", MAR): (4100.0, 4100.0, 1, None),
        ("Queens", APR): (4050.0, 4050.0, 1, None),
    }


def test_dim_listings(spark, listings):
    got = {r["listing_id"]: (float(r["current_rent"]), r["current_status"]) for r in marts.dim_listings(listings).collect()}
    assert got == {"rp-nyc-0001": (3375.0, "active"), "rp-nyc-0002": (4050.0, "leased"), "rp-nyc-0003": (2895.0, "active")}


def test_bom_stripped_and_amenities_split(spark, listings):
    r = listings.where("listing_id = 'rp-nyc-0003'").first()
    assert r["amenities"] == ["pets allowed", "laundry"]
    assert r["listing_snapshot_id"] is not None and len(r["listing_snapshot_id"]) == 32
