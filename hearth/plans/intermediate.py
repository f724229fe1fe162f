"""Intermediate models: zip-month market signals, development signals,
transit access per borough."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions import surrogate_key
from hearth.operators.aggregates import count_when, flag_sum, sum_default
from hearth.operators.joins import full_outer_coalesce
from hearth.operators.windows import lag_ratio, ordered_window, rolling_stddev


def zip_month_joined(rent: DataFrame, inventory: DataFrame) -> DataFrame:
    """Rent and inventory series side by side: full outer join on (zip, month)."""
    j = full_outer_coalesce(
        rent.select("postal_code", "state_name", "rent_month", "zori_rent"),
        inventory.select("postal_code", "state_name", "inventory_month", "active_inventory"),
        on=["postal_code", ("rent_month", "inventory_month")],
    )
    return j.select(
        F.coalesce("l__postal_code", "r__postal_code").alias("postal_code"),
        F.coalesce("l__state_name", "r__state_name").alias("state_name"),
        F.coalesce("l__rent_month", "r__inventory_month").alias("signal_month"),
        F.col("l__zori_rent").alias("zori_rent"),
        F.col("r__active_inventory").alias("active_inventory"),
    )


def int_zip_month_market_signals(rent: DataFrame, inventory: DataFrame) -> DataFrame:
    keys, order = ["postal_code"], ["signal_month"]
    w = ordered_window(keys, order)
    j = zip_month_joined(rent, inventory).where(F.col("postal_code").isNotNull() & F.col("signal_month").isNotNull())
    # one Window operator: all four expressions share partitioning and order
    return j.select(
        surrogate_key("postal_code", "signal_month").alias("zip_month_signal_id"),
        "postal_code",
        "state_name",
        "signal_month",
        "zori_rent",
        "active_inventory",
        (F.col("zori_rent") - F.lag("zori_rent").over(w)).alias("rent_mom_delta"),
        lag_ratio("zori_rent", keys, order, n=12).alias("rent_yoy_pct"),
        (F.col("active_inventory") - F.lag("active_inventory").over(w)).alias("inventory_mom_delta"),
        rolling_stddev("zori_rent", keys, order, rows=6).alias("six_month_rent_volatility"),
    )


def housing_by_area(housing: DataFrame) -> DataFrame:
    return housing.groupBy("borough", "postal_code", "neighborhood_code").agg(
        F.count_distinct("housing_building_id").alias("housing_projects"),
        sum_default("counted_rental_units", 0).alias("affordable_rental_units"),
        sum_default("total_units", 0).alias("total_housing_units"),
    )


def permits_by_area(permits: DataFrame) -> DataFrame:
    return permits.groupBy("borough", "postal_code", "neighborhood_code").agg(
        F.count_distinct("permit_id").alias("permit_count"),
        sum_default("estimated_job_cost", 0).alias("estimated_development_cost"),
        F.max("issued_date").alias("latest_permit_issued_date"),
    )


def int_neighborhood_development_signals(housing: DataFrame, permits: DataFrame) -> DataFrame:
    """Housing and permit activity per (zip, NTA): both sides pre-aggregated,
    then a full outer join where a NULL and an empty NTA match each other."""
    j = full_outer_coalesce(
        housing_by_area(housing),
        permits_by_area(permits),
        on=["postal_code", "neighborhood_code"],
        null_as={"neighborhood_code": ""},
    )
    zip_ = F.coalesce("l__postal_code", "r__postal_code")
    nta = F.coalesce("l__neighborhood_code", "r__neighborhood_code")
    return j.select(
        F.md5(F.concat(F.coalesce(zip_, F.lit("")), F.lit("|"), F.coalesce(nta, F.lit("")))).alias("development_signal_id"),
        F.coalesce("l__borough", "r__borough").alias("borough"),
        zip_.alias("postal_code"),
        nta.alias("neighborhood_code"),
        F.coalesce("l__housing_projects", F.lit(0)).alias("housing_projects"),
        F.coalesce("l__affordable_rental_units", F.lit(0)).alias("affordable_rental_units"),
        F.coalesce("l__total_housing_units", F.lit(0)).alias("total_housing_units"),
        F.coalesce("r__permit_count", F.lit(0)).alias("permit_count"),
        F.coalesce("r__estimated_development_cost", F.lit(0)).alias("estimated_development_cost"),
        F.col("r__latest_permit_issued_date").alias("latest_permit_issued_date"),
    )


def int_transit_access_by_borough(transit: DataFrame) -> DataFrame:
    return transit.groupBy("borough").agg(
        F.count_distinct("station_complex_id").alias("station_complex_count"),
        sum_default("station_count", 1).alias("station_count"),
        flag_sum(F.col("ada_score") > 0).alias("ada_station_complex_count"),
        count_when(F.col("in_cbd")).alias("cbd_station_complex_count"),
    )

