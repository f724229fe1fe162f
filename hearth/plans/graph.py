"""The model graph over the bound test tables, built lazily.

``ModelGraph(spark, sf_dir).fct_rent_trends`` is a DataFrame whose plan reaches
back to the parquet scans.  No job looks at sizes while it is built; the
range-split lag and the shared models are written once (checkpoint, parquet)
because later steps read them twice.  Medians of rents use the built-in
percentile: its memory is bounded by the distinct prices, which are cents.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from hearth.plans import bindings, intermediate, marts, staging
from hearth.session import scratch_path

# Models read more than once by the scorecard: worth materializing there, with the columns it reads (None: all).
SHARED_MODELS = {"stg_listing_snapshots": marts.HISTORY_READ, "int_neighborhood_development_signals": None}


class ModelGraph:
    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        median_strategy: str = "builtin",
        lag_strategy: str = "ranked",
        materialize: Iterable[str] | Mapping[str, Sequence[str] | None] = (),
    ):
        """``materialize``: model names computed once and checkpointed (to the
        shared ``spark.checkpoint.dir``) when first used, for graphs that read
        them several times; everything else stays a lazy plan.  A mapping names
        the columns that the graph reads of each (None: all)."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.median_strategy = median_strategy
        self.lag_strategy = lag_strategy
        self.materialize = dict(materialize) if isinstance(materialize, Mapping) else dict.fromkeys(materialize)

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write a shared model once as parquet under the checkpoint folder and
        read it back (columnar and compressed, with file statistics for the
        readers, unlike an RDD checkpoint)."""
        if name not in self.materialize:
            return df
        path = scratch_path(self.spark, f"model-{name}-{uuid.uuid4().hex}")
        (df.select(*self.materialize[name]) if self.materialize[name] else df).write.parquet(path)
        return self.spark.read.parquet(path)

    def table(self, name: str) -> DataFrame:
        return bindings.table(self.spark, self.sf_dir, name)

    # raw ------------------------------------------------------------------
    @cached_property
    def raw(self) -> DataFrame:
        return bindings.raw_records(self.spark, self.sf_dir)

    # staging --------------------------------------------------------------
    @cached_property
    def stg_rent_prices(self) -> DataFrame:
        return staging.stg_rent_prices(bindings.rent_wide_raw(self.spark, self.sf_dir))

    @cached_property
    def stg_inventory(self) -> DataFrame:
        return staging.stg_inventory(bindings.inventory_wide_raw(self.spark, self.sf_dir))

    @cached_property
    def stg_listing_snapshots(self) -> DataFrame:
        return self._keep("stg_listing_snapshots", staging.stg_listing_snapshots(bindings.listings_raw(self.spark, self.sf_dir)))

    @cached_property
    def stg_permits(self) -> DataFrame:
        return staging.stg_permits(bindings.permits_raw(self.spark, self.sf_dir))

    @cached_property
    def stg_neighborhood_housing(self) -> DataFrame:
        return staging.stg_neighborhood_housing(bindings.housing_raw(self.spark, self.sf_dir))

    @cached_property
    def stg_transit_access(self) -> DataFrame:
        return staging.stg_transit_access(bindings.stations_raw(self.spark, self.sf_dir))

    # intermediate -----------------------------------------------------------
    @cached_property
    def int_zip_month_market_signals(self) -> DataFrame:
        return intermediate.int_zip_month_market_signals(self.stg_rent_prices, self.stg_inventory)

    @cached_property
    def int_neighborhood_development_signals(self) -> DataFrame:
        return self._keep(
            "int_neighborhood_development_signals",
            intermediate.int_neighborhood_development_signals(self.stg_neighborhood_housing, self.stg_permits),
        )

    @cached_property
    def int_transit_access_by_borough(self) -> DataFrame:
        return intermediate.int_transit_access_by_borough(self.stg_transit_access)

    # marts ------------------------------------------------------------------
    @cached_property
    def dim_listings(self) -> DataFrame:
        return marts.dim_listings(self.stg_listing_snapshots)

    @cached_property
    def dim_neighborhoods(self) -> DataFrame:
        return marts.dim_neighborhoods(self.stg_listing_snapshots, self.int_neighborhood_development_signals)

    @cached_property
    def fct_listing_history(self) -> DataFrame:
        return marts.fct_listing_history(self.stg_listing_snapshots, lag_strategy=self.lag_strategy)

    @cached_property
    def fct_rent_trends(self) -> DataFrame:
        return marts.fct_rent_trends(self.int_zip_month_market_signals)

    @cached_property
    def mart_affordability(self) -> DataFrame:
        return marts.mart_affordability(self.fct_rent_trends)

    @cached_property
    def mart_development_activity(self) -> DataFrame:
        return marts.mart_development_activity(self.int_neighborhood_development_signals)

    @cached_property
    def mart_inventory_churn(self) -> DataFrame:
        return marts.mart_inventory_churn(self.fct_listing_history, self.median_strategy)

    @cached_property
    def mart_transit_price_effect(self) -> DataFrame:
        return marts.mart_transit_price_effect(
            self.stg_listing_snapshots, self.int_transit_access_by_borough, self.median_strategy
        )

    @cached_property
    def mart_neighborhood_scorecard(self) -> DataFrame:
        return marts.mart_neighborhood_scorecard(
            self.dim_neighborhoods, self.fct_rent_trends, self.mart_inventory_churn, self.mart_development_activity
        )
