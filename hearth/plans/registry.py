"""Registered queries: one Spark callable and one DuckDB SQL string per key.

Every key carries a column spec (``"name kind, ..."``, kinds as in
``oracle.present`` plus ``r`` = double rounded to 6 places, used where the
two engines accumulate floating-point sums in different orders).  Both sides
render their result through the same spec.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.plans import oracle
from hearth.plans.graph import SHARED_MODELS, ModelGraph
from hearth.plans.present import checkable

SparkQuery = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    spark: SparkQuery
    sql: str | None
    columns: str


REGISTRY: dict[str, Entry] = {}


def _parse(columns: str) -> list[tuple[str, str]]:
    return [tuple(item.split()) for item in columns.split(",")]  # type: ignore[misc]


def render_spark(df: DataFrame, columns: str) -> DataFrame:
    spec = _parse(columns)
    out = checkable(df.select(*[F.col(f"`{n}`") for n, _ in spec]))
    cols = []
    for n, kind in spec:
        c = F.col(f"`{n}`")
        if kind == "r":
            c = F.round(c.cast("double"), 6)
        elif kind == "f":
            c = c.cast("double")
        elif kind == "i":
            c = c.cast("long")
        cols.append(c.alias(n))
    return out.select(*cols)


def render_sql(source: str, columns: str) -> str:
    out = []
    for n, kind in _parse(columns):
        if kind in ("d", "f"):
            out.append(f"cast({n} AS DOUBLE) AS {n}")
        elif kind == "r":
            out.append(f"round(cast({n} AS DOUBLE), 6) AS {n}")
        elif kind == "t":
            out.append(f"cast({n} AS VARCHAR) AS {n}")
        elif kind == "i":
            out.append(f"cast({n} AS BIGINT) AS {n}")
        elif kind == "a":
            out.append(f"to_json({n}) AS {n}")
        elif kind == "m":
            out.append(f"to_json(list_sort(map_entries({n}))) AS {n}")
        else:
            out.append(n)
    return f"SELECT {', '.join(out)} FROM {source}"


def register(key: str, columns: str, spark: SparkQuery, sql: str | None) -> None:
    columns = " ".join(columns.split())
    REGISTRY[key] = Entry(lambda s, d, _f=spark, _c=columns: render_spark(_f(s, d), _c), sql, columns)


def register_fragment(key: str, columns: str, spark: SparkQuery, fragment: str, where: str = "") -> None:
    """Register a key whose oracle is a named fragment (optionally filtered)."""
    cols = " ".join(columns.split())
    src = fragment if not where else f"(SELECT * FROM {fragment} WHERE {where})"
    register(key, cols, spark, oracle.compose(render_sql(src, cols), fragment))


# ---------------------------------------------------------------------------
# models

MODEL_COLUMNS = {
    "stg_rent_prices": "rent_price_id s, region_id s, size_rank d, postal_code s, region_type s, state_name s, rent_month t, zori_rent d, ingested_at t, run_id s",
    "stg_inventory": "inventory_id s, region_id s, size_rank d, postal_code s, region_type s, state_name s, inventory_month t, active_inventory d, ingested_at t, run_id s",
    "stg_listing_snapshots": "listing_snapshot_id s, listing_id s, snapshot_date t, address s, postal_code s, neighborhood s, borough s, rent d, bedrooms d, bathrooms d, sqft d, property_type s, amenities a, listing_status s, listed_date t, latitude d, longitude d, ingested_at t, run_id s",
    "stg_permits": "permit_id s, job_filing_number s, work_permit s, sequence_number s, filing_reason s, house_number s, street_name s, borough s, postal_code s, community_board s, census_tract s, neighborhood_code s, work_type s, approved_date t, issued_date t, expired_date t, job_description s, estimated_job_cost d, permit_status s, latitude d, longitude d, ingested_at t, run_id s",
    "stg_neighborhood_housing": "housing_building_id s, project_id s, project_name s, project_start_date t, project_completion_date t, building_id s, house_number s, street_name s, borough s, postal_code s, bbl s, bin s, community_board s, neighborhood_code s, latitude d, longitude d, construction_type s, extended_affordability_status s, counted_rental_units d, all_counted_units d, total_units d, ingested_at t, run_id s",
    "stg_transit_access": "station_complex_id s, is_complex b, station_count d, stop_name s, display_name s, borough_code s, borough s, in_cbd b, daytime_routes s, structure_type s, latitude d, longitude d, ada_score d, ada_notes s, ingested_at t, run_id s",
    "int_zip_month_market_signals": "zip_month_signal_id s, postal_code s, state_name s, signal_month t, zori_rent d, active_inventory d, rent_mom_delta d, rent_yoy_pct f, inventory_mom_delta d, six_month_rent_volatility r",
    "int_neighborhood_development_signals": "development_signal_id s, borough s, postal_code s, neighborhood_code s, housing_projects i, affordable_rental_units d, total_housing_units d, permit_count i, estimated_development_cost d, latest_permit_issued_date t",
    "int_transit_access_by_borough": "borough s, station_complex_count i, station_count d, ada_station_complex_count i, cbd_station_complex_count i",
    "dim_listings": "listing_id s, address s, postal_code s, neighborhood s, borough s, bedrooms d, bathrooms d, sqft d, property_type s, amenities a, listed_date t, latitude d, longitude d, current_status s, current_rent d, latest_snapshot_date t",
    "dim_neighborhoods": "neighborhood_id s, postal_code s, neighborhood s, borough s, neighborhood_code s, housing_projects i, affordable_rental_units d, permit_count i",
    "fct_listing_history": "listing_snapshot_id s, listing_id s, snapshot_date t, postal_code s, neighborhood s, borough s, rent d, bedrooms d, bathrooms d, sqft d, property_type s, listing_status s, days_on_market i, rent_change_amount d, rent_change_pct f, ingested_at t, run_id s",
    "fct_rent_trends": "zip_month_signal_id s, postal_code s, state_name s, signal_month t, zori_rent d, active_inventory d, rent_mom_delta d, rent_yoy_pct f, inventory_mom_delta d, six_month_rent_volatility r, rent_volatility_band s",
    "mart_affordability": "affordability_id s, postal_code s, signal_month t, zori_rent d, annual_rent d, income_needed_at_30_pct f, rent_yoy_pct f, rent_volatility_band s",
    "mart_development_activity": "development_activity_id s, borough s, postal_code s, neighborhood_code s, housing_projects i, affordable_rental_units d, total_housing_units d, permit_count i, estimated_development_cost d, latest_permit_issued_date t, development_activity_band s",
    "mart_inventory_churn": "inventory_churn_id s, postal_code s, neighborhood s, borough s, snapshot_date t, listing_count i, active_listing_count i, leased_listing_count i, avg_listing_rent f, median_listing_rent r, avg_days_on_market f, listings_with_price_changes i, listing_count_delta i",
    "mart_transit_price_effect": "transit_price_effect_id s, borough s, snapshot_date t, avg_listing_rent f, median_listing_rent r, listing_count i, station_complex_count i, station_count d, ada_station_complex_count i, cbd_station_complex_count i, rent_per_station_complex f",
    "mart_neighborhood_scorecard": "neighborhood_scorecard_id s, neighborhood_id s, postal_code s, neighborhood s, borough s, latest_rent_month t, zori_rent d, rent_yoy_pct f, six_month_rent_volatility r, rent_volatility_band s, active_inventory d, listing_count i, active_listing_count i, leased_listing_count i, avg_days_on_market f, housing_projects i, affordable_rental_units d, permit_count i, estimated_development_cost d, development_activity_band s, recruiter_demo_signal_score i",
}


# Graphs that read the listing staging and the development signals from
# several branches write them once (parquet under the checkpoint folder).
MATERIALIZED = {"mart_neighborhood_scorecard": SHARED_MODELS}


def _model(name: str) -> SparkQuery:
    return lambda spark, sf_dir: getattr(ModelGraph(spark, sf_dir, materialize=MATERIALIZED.get(name, ())), name)


for _name, _cols in MODEL_COLUMNS.items():
    register_fragment(_name, _cols, _model(_name), _name)


# operator-level and source-level keys register themselves on import
from hearth.plans import queries_ops as _ops  # noqa: E402,F401
from hearth.plans import queries_io as _io  # noqa: E402,F401
