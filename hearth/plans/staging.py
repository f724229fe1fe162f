"""Staging models: typed, keyed rows per feed, read schema-on-read from the
raw table's payload (a map or a variant) with tolerant casts.  Each is a pure DataFrame function."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions import (
    decode,
    field,
    has_field,
    money,
    parse_bool,
    payload_of,
    split_literal,
    surrogate_key,
    try_date,
    try_decimal,
    try_number,
    unpivot,
)
from hearth.functions.payload import DATE_KEY
from hearth.operators.envelope import dataset_slice, latest_versions

# Station borough codes and their names.
STATION_BOROUGHS = {"M": "Manhattan", "Q": "Queens", "Bk": "Brooklyn", "Bx": "Bronx", "SI": "Staten Island"}


def _slice(raw: DataFrame, dataset: str, latest_version: bool) -> DataFrame:
    src = dataset_slice(raw, dataset)
    return latest_versions(src) if latest_version else src


def _wide_series(raw: DataFrame, dataset: str, month_col: str, value_col: str, cast, latest_version: bool = False) -> DataFrame:
    """Unpivot a wide monthly feed: one row per (region, date key).  Non-date
    keys of a map are dropped before the explode, so they never become rows."""
    p = payload_of(raw)
    exploded = unpivot(_slice(raw, dataset, latest_version), "payload", DATE_KEY, "__k", "__v").select(
        field(p, "RegionID").alias("region_id"),
        try_number(field(p, "SizeRank")).alias("size_rank"),
        field(p, "RegionName").alias("postal_code"),
        field(p, "RegionType").alias("region_type"),
        field(p, "StateName").alias("state_name"),
        "__k",
        "__v",
        "ingested_at",
        "run_id",
    )
    return exploded.select(
        "region_id",
        "size_rank",
        "postal_code",
        "region_type",
        "state_name",
        try_date(F.col("__k")).alias(month_col),
        cast(F.col("__v")).alias(value_col),
        "ingested_at",
        "run_id",
    ).where(F.col(value_col).isNotNull())


def stg_rent_prices(raw: DataFrame, latest_version: bool = False) -> DataFrame:
    """``latest_version`` (all staging models): stage only the newest version
    of each source row instead of every landed version."""
    rows = _wide_series(raw, "zillow_zori_zip", "rent_month", "zori_rent", lambda c: try_decimal(c, 12, 2), latest_version)
    return rows.select(surrogate_key("region_id", "rent_month").alias("rent_price_id"), *rows.columns)


def stg_inventory(raw: DataFrame, latest_version: bool = False) -> DataFrame:
    rows = _wide_series(raw, "zillow_inventory_zip", "inventory_month", "active_inventory", try_number, latest_version)
    return rows.select(surrogate_key("region_id", "inventory_month").alias("inventory_id"), *rows.columns)


def stg_listing_snapshots(raw: DataFrame, latest_version: bool = False) -> DataFrame:
    p = payload_of(raw)
    src = _slice(raw, "listing_snapshots", latest_version).where(has_field(p, "listing_id"))
    return src.select(
        surrogate_key(F.col("source_row_id"), F.coalesce(F.col("record_hash"), F.lit(""))).alias("listing_snapshot_id"),
        field(p, "listing_id").alias("listing_id"),
        try_date(field(p, "snapshot_date")).alias("snapshot_date"),
        field(p, "address").alias("address"),
        field(p, "postal_code").alias("postal_code"),
        field(p, "neighborhood").alias("neighborhood"),
        field(p, "borough").alias("borough"),
        try_decimal(field(p, "rent"), 12, 2).alias("rent"),
        try_number(field(p, "bedrooms")).alias("bedrooms"),
        try_decimal(field(p, "bathrooms"), 8, 2).alias("bathrooms"),
        try_number(field(p, "sqft")).alias("sqft"),
        field(p, "property_type").alias("property_type"),
        split_literal(field(p, "amenities"), "|").alias("amenities"),
        field(p, "status").alias("listing_status"),
        try_date(field(p, "listed_date")).alias("listed_date"),
        try_decimal(field(p, "latitude"), 12, 8).alias("latitude"),
        try_decimal(field(p, "longitude"), 12, 8).alias("longitude"),
        "ingested_at",
        "run_id",
    )


def stg_permits(raw: DataFrame, latest_version: bool = False) -> DataFrame:
    p = payload_of(raw)
    src = _slice(raw, "nyc_dob_approved_permits", latest_version).where(has_field(p, "job_filing_number"))
    key_parts = [F.coalesce(field(p, k), F.lit("")) for k in ("job_filing_number", "work_permit", "sequence_number")]
    return src.select(
        surrogate_key(*key_parts).alias("permit_id"),
        field(p, "job_filing_number").alias("job_filing_number"),
        field(p, "work_permit").alias("work_permit"),
        field(p, "sequence_number").alias("sequence_number"),
        field(p, "filing_reason").alias("filing_reason"),
        field(p, "house_no").alias("house_number"),
        field(p, "street_name").alias("street_name"),
        field(p, "borough").alias("borough"),
        field(p, "zip_code").alias("postal_code"),
        field(p, "community_board").alias("community_board"),
        field(p, "census_tract").alias("census_tract"),
        field(p, "nta").alias("neighborhood_code"),
        field(p, "work_type").alias("work_type"),
        try_date(field(p, "approved_date")).alias("approved_date"),
        try_date(field(p, "issued_date")).alias("issued_date"),
        try_date(field(p, "expired_date")).alias("expired_date"),
        field(p, "job_description").alias("job_description"),
        money(field(p, "estimated_job_costs"), 14, 2).alias("estimated_job_cost"),
        field(p, "permit_status").alias("permit_status"),
        try_decimal(field(p, "latitude"), 12, 8).alias("latitude"),
        try_decimal(field(p, "longitude"), 12, 8).alias("longitude"),
        "ingested_at",
        "run_id",
    )


def stg_neighborhood_housing(raw: DataFrame, latest_version: bool = False) -> DataFrame:
    p = payload_of(raw)
    src = _slice(raw, "nyc_housing_units_by_building", latest_version).where(has_field(p, "project_id"))
    return src.select(
        surrogate_key(
            F.coalesce(field(p, "project_id"), F.lit("")), F.coalesce(field(p, "building_id"), F.lit(""))
        ).alias("housing_building_id"),
        field(p, "project_id").alias("project_id"),
        field(p, "project_name").alias("project_name"),
        try_date(field(p, "project_start_date")).alias("project_start_date"),
        try_date(field(p, "project_completion_date")).alias("project_completion_date"),
        field(p, "building_id").alias("building_id"),
        field(p, "house_number").alias("house_number"),
        field(p, "street_name").alias("street_name"),
        field(p, "borough").alias("borough"),
        field(p, "postcode").alias("postal_code"),
        field(p, "bbl").alias("bbl"),
        field(p, "bin").alias("bin"),
        field(p, "community_board").alias("community_board"),
        field(p, "neighborhood_tabulation_area").alias("neighborhood_code"),
        try_decimal(field(p, "latitude"), 12, 8).alias("latitude"),
        try_decimal(field(p, "longitude"), 12, 8).alias("longitude"),
        field(p, "reporting_construction_type").alias("construction_type"),
        field(p, "extended_affordability_status").alias("extended_affordability_status"),
        try_number(field(p, "counted_rental_units")).alias("counted_rental_units"),
        try_number(field(p, "all_counted_units")).alias("all_counted_units"),
        try_number(field(p, "total_units")).alias("total_units"),
        "ingested_at",
        "run_id",
    )


def stg_transit_access(raw: DataFrame, latest_version: bool = False) -> DataFrame:
    p = payload_of(raw)
    src = _slice(raw, "mta_subway_stations", latest_version).where(has_field(p, "Complex ID"))
    return src.select(
        field(p, "Complex ID").alias("station_complex_id"),
        parse_bool(field(p, "Is Complex")).alias("is_complex"),
        try_number(field(p, "Number Of Stations In Complex")).alias("station_count"),
        field(p, "Stop Name").alias("stop_name"),
        field(p, "Display Name").alias("display_name"),
        field(p, "Borough").alias("borough_code"),
        decode(field(p, "Borough"), STATION_BOROUGHS).alias("borough"),
        parse_bool(field(p, "CBD")).alias("in_cbd"),
        field(p, "Daytime Routes").alias("daytime_routes"),
        field(p, "Structure Type").alias("structure_type"),
        try_decimal(field(p, "Latitude"), 12, 8).alias("latitude"),
        try_decimal(field(p, "Longitude"), 12, 8).alias("longitude"),
        try_number(field(p, "ADA")).alias("ada_score"),
        field(p, "ADA Notes").alias("ada_notes"),
        "ingested_at",
        "run_id",
    )
