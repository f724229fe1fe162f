"""Dimensions, facts and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions import any_band, band, days_between, surrogate_key
from hearth.operators.aggregates import aggregate_with_median, any_stable, count_when, mean
from hearth.operators.joins import full_outer_coalesce, left_chain, lookup
from hearth.operators.merge import incremental
from hearth.operators.windows import latest_by, ordered_window, with_lags

# Volatility bands (absolute six-month stddev of rent).
VOLATILITY_BANDS = [(150, "high volatility"), (75, "moderate volatility")]
VOLATILITY_DEFAULT = "stable"
# Development bands (permit count, estimated cost).
DEVELOPMENT_HIGH = (100, 100_000_000)
DEVELOPMENT_MODERATE = (25, 25_000_000)
# Scorecard points.
VOLATILITY_POINTS = {"high volatility": 3, "moderate volatility": 2}
VOLATILITY_POINTS_DEFAULT = 1
PERMIT_POINTS = [(50, 2), (10, 1)]

#: Columns of the listing history before and after its derived ones; what these and the daily inventory read; the others, carried along.
HISTORY_COLUMNS = (
    ("listing_snapshot_id", "listing_id", "snapshot_date", "postal_code", "neighborhood", "borough", "rent", "bedrooms", "bathrooms", "sqft", "property_type", "listing_status"),
    ("ingested_at", "run_id"),
)
HISTORY_READ = ("listing_snapshot_id", "listing_id", "snapshot_date", "postal_code", "neighborhood", "borough", "rent", "listing_status", "listed_date")
HISTORY_CARRIED = ("bedrooms", "bathrooms", "sqft", "property_type", "ingested_at", "run_id")

LISTING_ORDER = [("snapshot_date", "desc"), ("ingested_at", "desc"), "listing_snapshot_id"]


def dim_listings(listings: DataFrame) -> DataFrame:
    """Latest snapshot per listing (ties broken by the unique snapshot id)."""
    latest = latest_by(listings, ["listing_id"], LISTING_ORDER)
    return latest.select(
        "listing_id",
        "address",
        "postal_code",
        "neighborhood",
        "borough",
        "bedrooms",
        "bathrooms",
        "sqft",
        "property_type",
        "amenities",
        "listed_date",
        "latitude",
        "longitude",
        F.col("listing_status").alias("current_status"),
        F.col("rent").alias("current_rent"),
        F.col("snapshot_date").alias("latest_snapshot_date"),
    )


def development_by_zip(dev_signals: DataFrame) -> DataFrame:
    """Roll development signals up from (zip, NTA) to zip."""
    return dev_signals.groupBy("postal_code").agg(
        any_stable("neighborhood_code").alias("neighborhood_code"),
        any_stable("borough").alias("borough"),
        F.sum("housing_projects").alias("housing_projects"),
        F.sum("affordable_rental_units").alias("affordable_rental_units"),
        F.sum("permit_count").alias("permit_count"),
    )


def dim_neighborhoods(listings: DataFrame, dev_signals: DataFrame) -> DataFrame:
    areas = listings.where(F.col("postal_code").isNotNull()).select("postal_code", "neighborhood", "borough").distinct()
    j = full_outer_coalesce(areas, development_by_zip(dev_signals), on=["postal_code"])
    zip_ = F.coalesce("l__postal_code", "r__postal_code")
    return j.select(
        F.md5(
            F.concat(
                F.coalesce(zip_, F.lit("")),
                F.lit("|"),
                F.coalesce("l__neighborhood", "r__neighborhood_code", F.lit("unknown")),
            )
        ).alias("neighborhood_id"),
        zip_.alias("postal_code"),
        F.coalesce("l__neighborhood", "r__neighborhood_code", F.lit("Unknown")).alias("neighborhood"),
        F.coalesce("l__borough", "r__borough").alias("borough"),
        F.col("r__neighborhood_code").alias("neighborhood_code"),
        F.coalesce("r__housing_projects", F.lit(0)).alias("housing_projects"),
        F.coalesce("r__affordable_rental_units", F.lit(0)).alias("affordable_rental_units"),
        F.coalesce("r__permit_count", F.lit(0)).alias("permit_count"),
    )


def listing_history(listings: DataFrame, lag_strategy: str = "ranked") -> DataFrame:
    """Every snapshot with days on market and the change since the previous
    snapshot of the same listing.  The lag is computed once and shared; a
    listing with an outsized history is range-split instead of windowed.
    Only columns that the history has or reads go through the lag; those in
    ``HISTORY_CARRIED`` that ``listings`` is without are left out of the history."""
    carried = [c for c in HISTORY_CARRIED if c in listings.columns]
    prev = with_lags(
        listings.where(F.col("listing_id").isNotNull()).select(*HISTORY_READ, *carried),
        ["listing_id"],
        ["snapshot_date", "listing_snapshot_id"],
        [("rent", "__prev_rent")],
        lag_strategy,
    )
    first, last = ([c for c in part if c in HISTORY_READ or c in carried] for part in HISTORY_COLUMNS)
    return prev.select(
        *first,
        days_between("listed_date", "snapshot_date").alias("days_on_market"),
        (F.col("rent") - F.col("__prev_rent")).alias("rent_change_amount"),
        (F.col("rent").cast("double") / F.nullif(F.col("__prev_rent").cast("double"), F.lit(0.0)) - F.lit(1.0)).alias(
            "rent_change_pct"
        ),
        *last,
    )


def fct_listing_history(
    listings: DataFrame, current: DataFrame | None = None, full_refresh: bool = False, lag_strategy: str = "ranked"
) -> DataFrame:
    """Incremental fact: windows over the full input first, then the
    high-water-mark filter and an upsert on the snapshot id."""
    return incremental(listing_history(listings, lag_strategy), current, "listing_snapshot_id", "snapshot_date", full_refresh)


def volatility_band(c: str = "six_month_rent_volatility"):
    return band(F.abs(F.coalesce(F.col(c), F.lit(0.0))), VOLATILITY_BANDS, VOLATILITY_DEFAULT)


def rent_trends(zip_signals: DataFrame) -> DataFrame:
    return zip_signals.select(
        "zip_month_signal_id",
        "postal_code",
        "state_name",
        "signal_month",
        "zori_rent",
        "active_inventory",
        "rent_mom_delta",
        "rent_yoy_pct",
        "inventory_mom_delta",
        "six_month_rent_volatility",
        volatility_band().alias("rent_volatility_band"),
    )


def fct_rent_trends(zip_signals: DataFrame, current: DataFrame | None = None, full_refresh: bool = False) -> DataFrame:
    return incremental(rent_trends(zip_signals), current, "zip_month_signal_id", "signal_month", full_refresh)


def mart_affordability(trends: DataFrame) -> DataFrame:
    annual = F.col("zori_rent") * F.lit(12)
    return trends.where(F.col("zori_rent").isNotNull()).select(
        surrogate_key("postal_code", "signal_month").alias("affordability_id"),
        "postal_code",
        "signal_month",
        "zori_rent",
        annual.alias("annual_rent"),
        (annual.cast("double") / F.lit(0.30)).alias("income_needed_at_30_pct"),
        "rent_yoy_pct",
        "rent_volatility_band",
    )


def development_band():
    permits, cost = F.col("permit_count"), F.col("estimated_development_cost")
    return any_band(
        [
            ((permits >= DEVELOPMENT_HIGH[0]) | (cost >= DEVELOPMENT_HIGH[1]), "high development"),
            ((permits >= DEVELOPMENT_MODERATE[0]) | (cost >= DEVELOPMENT_MODERATE[1]), "moderate development"),
        ],
        "low development",
    )


def mart_development_activity(dev_signals: DataFrame) -> DataFrame:
    return dev_signals.select(
        F.col("development_signal_id").alias("development_activity_id"),
        "borough",
        "postal_code",
        "neighborhood_code",
        "housing_projects",
        "affordable_rental_units",
        "total_housing_units",
        "permit_count",
        "estimated_development_cost",
        "latest_permit_issued_date",
        development_band().alias("development_activity_band"),
    )


def inventory_daily(history: DataFrame, median_strategy: str = "builtin") -> DataFrame:
    keys = ["postal_code", "neighborhood", "borough", "snapshot_date"]
    return aggregate_with_median(
        history,
        keys,
        [
            F.count_distinct("listing_id").alias("listing_count"),
            count_when(F.col("listing_status") == "active").alias("active_listing_count"),
            count_when(F.col("listing_status") == "leased").alias("leased_listing_count"),
            mean("rent", scale=2).alias("avg_listing_rent"),
            mean("days_on_market").alias("avg_days_on_market"),
            count_when(F.col("rent_change_amount") != 0).alias("listings_with_price_changes"),
        ],
        [("rent", "median_listing_rent")],
        median_strategy,
    )


def mart_inventory_churn(history: DataFrame, median_strategy: str = "builtin") -> DataFrame:
    daily = inventory_daily(history, median_strategy)
    # neighborhood and borough break ties between groups sharing (zip, day)
    w = ordered_window(["postal_code"], ["snapshot_date", "neighborhood", "borough"])
    return daily.select(
        surrogate_key("postal_code", "snapshot_date").alias("inventory_churn_id"),
        "postal_code",
        "neighborhood",
        "borough",
        "snapshot_date",
        "listing_count",
        "active_listing_count",
        "leased_listing_count",
        "avg_listing_rent",
        "median_listing_rent",
        "avg_days_on_market",
        "listings_with_price_changes",
        (F.col("listing_count") - F.lag("listing_count").over(w)).alias("listing_count_delta"),
    )


def listing_borough_rents(listings: DataFrame, median_strategy: str = "builtin") -> DataFrame:
    return aggregate_with_median(
        listings,
        ["borough", "snapshot_date"],
        [mean("rent", scale=2).alias("avg_listing_rent"), F.count_distinct("listing_id").alias("listing_count")],
        [("rent", "median_listing_rent")],
        median_strategy,
    )


def mart_transit_price_effect(listings: DataFrame, transit_by_borough: DataFrame, median_strategy: str = "builtin") -> DataFrame:
    rents = listing_borough_rents(listings, median_strategy)
    j = lookup(rents, transit_by_borough, ["borough"])
    return j.select(
        F.md5(F.concat(F.col("borough"), F.lit("|"), F.col("snapshot_date").cast("string"))).alias("transit_price_effect_id"),
        "borough",
        "snapshot_date",
        "avg_listing_rent",
        "median_listing_rent",
        "listing_count",
        "station_complex_count",
        "station_count",
        "ada_station_complex_count",
        "cbd_station_complex_count",
        (F.col("avg_listing_rent") / F.nullif(F.col("station_complex_count").cast("double"), F.lit(0.0))).alias(
            "rent_per_station_complex"
        ),
    )


def latest_rent(trends: DataFrame) -> DataFrame:
    return latest_by(trends, ["postal_code"], [("signal_month", "desc"), "zip_month_signal_id", "zori_rent"])


def latest_churn(churn: DataFrame) -> DataFrame:
    return latest_by(churn, ["postal_code"], [("snapshot_date", "desc"), "neighborhood", "borough"])


def signal_score(volatility_band_col, permits_col):
    vol = None
    for label, pts in VOLATILITY_POINTS.items():
        cond = volatility_band_col == F.lit(label)
        vol = F.when(cond, F.lit(pts)) if vol is None else vol.when(cond, F.lit(pts))
    vol = vol.otherwise(F.lit(VOLATILITY_POINTS_DEFAULT))
    perm = None
    for minimum, pts in PERMIT_POINTS:
        cond = permits_col >= F.lit(minimum)
        perm = F.when(cond, F.lit(pts)) if perm is None else perm.when(cond, F.lit(pts))
    perm = perm.otherwise(F.lit(0))
    return vol + perm


def mart_neighborhood_scorecard(
    neighborhoods: DataFrame, trends: DataFrame, churn: DataFrame, development: DataFrame
) -> DataFrame:
    """One row per neighborhood and matching development area (the join to
    development fans out where a zip has several areas)."""
    j = left_chain(
        neighborhoods,
        [(latest_rent(trends), "r__", "postal_code"), (latest_churn(churn), "c__", "postal_code"), (development, "d__", "postal_code")],
    )
    return j.select(
        F.md5(
            F.concat(F.col("neighborhood_id"), F.lit("|"), F.coalesce(F.col("r__signal_month").cast("string"), F.lit("no-rent")))
        ).alias("neighborhood_scorecard_id"),
        F.col("neighborhood_id"),
        F.col("postal_code"),
        F.col("neighborhood"),
        F.col("borough"),
        F.col("r__signal_month").alias("latest_rent_month"),
        F.col("r__zori_rent").alias("zori_rent"),
        F.col("r__rent_yoy_pct").alias("rent_yoy_pct"),
        F.col("r__six_month_rent_volatility").alias("six_month_rent_volatility"),
        F.col("r__rent_volatility_band").alias("rent_volatility_band"),
        F.col("r__active_inventory").alias("active_inventory"),
        F.col("c__listing_count").alias("listing_count"),
        F.col("c__active_listing_count").alias("active_listing_count"),
        F.col("c__leased_listing_count").alias("leased_listing_count"),
        F.col("c__avg_days_on_market").alias("avg_days_on_market"),
        F.col("housing_projects"),
        F.col("affordable_rental_units"),
        F.col("permit_count"),
        F.col("d__estimated_development_cost").alias("estimated_development_cost"),
        F.col("d__development_activity_band").alias("development_activity_band"),
        signal_score(
            F.col("r__rent_volatility_band"), F.coalesce(F.col("d__permit_count"), F.col("permit_count"), F.lit(0))
        ).alias("recruiter_demo_signal_score"),
    )
