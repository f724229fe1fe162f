"""Data-quality checks.  Each returns a DataFrame (violations or a small
metric); ``quality_report`` unions them into (check, state, detail) and
``enforce`` raises on the first failure.  Only the report, a handful of rows,
ever reaches the driver."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.functions.scalar import utc_literal
from hearth.operators.aggregates import count_when
from hearth.session import ensure_checkpoint_dir

# The check names of the validation gate.
RECORD_COUNTS = "raw_record_counts"
REQUIRED_PRESENCE = "required_dataset_presence"
DUPLICATE_HASHES = "duplicate_record_hashes"
PRICE_QUALITY = "listing_snapshot_price_quality"
KNOWN_CHECKS = (RECORD_COUNTS, REQUIRED_PRESENCE, DUPLICATE_HASHES, PRICE_QUALITY)


class ValidationError(RuntimeError):
    pass


def record_counts(raw: DataFrame) -> DataFrame:
    """Rows and latest ingest time per dataset."""
    return raw.groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("record_count"), F.max("ingested_at").alias("latest_ingested_at")
    )


def required_datasets(raw: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: how many of the required datasets have rows."""
    return raw.where(F.col("dataset_name").isin(list(names))).agg(
        F.count_distinct("dataset_name").alias("loaded_dataset_count")
    )


def missing_datasets(spark: SparkSession, raw: DataFrame, names: Sequence[str]) -> DataFrame:
    """Required dataset names with no rows (the names list is the small side)."""
    wanted = spark.createDataFrame([(n,) for n in names], "dataset_name string")
    present = raw.where(F.col("dataset_name").isin(list(names))).select("dataset_name").distinct()
    return wanted.join(present, "dataset_name", "left_anti")


def duplicate_hashes(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """Hashes repeated within one run (a later run may legitimately repeat a
    hash).  ``limit`` keeps the first violations in key order (default: all)."""
    keys = ["dataset_name", "record_hash", "run_id"]
    dup = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).where(F.col("duplicate_count") > 1)
    return dup.orderBy(*keys).limit(limit) if limit is not None else dup


def unparseable(raw: DataFrame, dataset: str, name: str, type_: str = "double", alias: str = "invalid_count") -> DataFrame:
    """One row: rows of ``dataset`` whose payload field does not parse as ``type_``."""
    return raw.where(F.col("dataset_name") == dataset).agg(
        count_when(F.col("payload").getItem(name).try_cast(type_).isNull()).alias(alias)
    )


def freshness(
    raw: DataFrame, as_of: _dt.datetime | str, loaded_col: str = "loaded_at", warn_hours: float = 36, error_hours: float = 72
) -> DataFrame:
    """One row: newest load time, its age in hours at ``as_of`` and pass/warn/error.
    ``as_of`` as text without offset is a UTC wall clock."""
    as_of_c = utc_literal(as_of) if isinstance(as_of, str) else F.lit(as_of).cast("timestamp")
    latest = raw.agg(F.max(loaded_col).alias("max_loaded_at"))
    age = (F.unix_micros(as_of_c) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / F.lit(3_600_000_000.0)
    return latest.select(
        "max_loaded_at",
        age.alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
        .when(age > error_hours, F.lit("error"))
        .when(age > warn_hours, F.lit("warn"))
        .otherwise(F.lit("pass"))
        .alias("freshness_state"),
    )


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, null_count) for every column, from one pass over ``df``."""
    counts = df.agg(*[count_when(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, null_count)")


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` occurring more than once (NULL ignored)."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    parents = parent.select(F.col(pk).alias("__pk")).distinct()
    return child.where(F.col(fk).isNotNull()).join(parents, F.col(fk) == F.col("__pk"), "left_anti")


#: Columns that every model promises to fill and to keep unique, and keys that must exist elsewhere
#: (child column, parent model, parent column).  Fixed values.
MODEL_TESTS: dict[str, dict[str, list]] = {
    "raw_records": {"not_null": ["dataset_name", "source_row_id", "record_hash"]},
    "stg_listing_snapshots": {"not_null": ["listing_snapshot_id", "listing_id", "snapshot_date", "rent"], "unique": ["listing_snapshot_id"]},
    "stg_rent_prices": {"not_null": ["rent_price_id", "postal_code", "rent_month"], "unique": ["rent_price_id"]},
    "stg_inventory": {"not_null": ["inventory_id", "postal_code"], "unique": ["inventory_id"]},
    "stg_permits": {"not_null": ["permit_id", "postal_code"], "unique": ["permit_id"]},
    "stg_neighborhood_housing": {"not_null": ["housing_building_id", "postal_code", "borough"], "unique": ["housing_building_id"]},
    "stg_transit_access": {"not_null": ["station_complex_id"], "unique": ["station_complex_id"]},
    "dim_listings": {"not_null": ["listing_id", "postal_code"], "unique": ["listing_id"]},
    "dim_neighborhoods": {"not_null": ["neighborhood_id"], "unique": ["neighborhood_id"]},
    "fct_listing_history": {
        "not_null": ["listing_snapshot_id"], "unique": ["listing_snapshot_id"], "relationships": [("listing_id", "dim_listings", "listing_id")],
    },
    "fct_rent_trends": {"not_null": ["zip_month_signal_id", "postal_code"], "unique": ["zip_month_signal_id"]},
    "mart_neighborhood_scorecard": {"not_null": ["neighborhood_scorecard_id"], "unique": ["neighborhood_scorecard_id"]},
    "mart_affordability": {"not_null": ["affordability_id"], "unique": ["affordability_id"]},
    "mart_inventory_churn": {"not_null": ["inventory_churn_id"], "unique": ["inventory_churn_id"]},
    "mart_transit_price_effect": {"not_null": ["transit_price_effect_id"], "unique": ["transit_price_effect_id"]},
    "mart_development_activity": {"not_null": ["development_activity_id"], "unique": ["development_activity_id"]},
}


def data_tests(models: Mapping[str, DataFrame], tests: Mapping[str, Mapping[str, list]] = MODEL_TESTS) -> DataFrame:
    """(model, column_name, test, violations) for every declared test of the given models: rows without a
    value, values that repeat, rows whose key has no parent.  0 violations: passed.

    A model's NULL counts and repeats come from one aggregation by each unique
    column, summed over its values; other NULL counts ride along."""
    parts: list[DataFrame] = []

    def row(model: str, column: str, test: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(test).alias("test"), F.col("violations").cast("long"))

    for name, declared in tests.items():
        if name not in models:
            continue
        df, filled, single = models[name], list(declared.get("not_null", ())), list(declared.get("unique", ()))
        by = single[0] if single else None
        groups = df.groupBy(*([by] if by else [])).agg(F.count(F.lit(1)).alias("__n"), *[count_when(F.col(c).isNull()).alias(f"__null_{c}") for c in filled])
        again = F.sum(F.when((F.col("__n") > 1) & F.col(by).isNotNull(), 1).otherwise(0)) if by else F.lit(0)
        one = groups.agg(F.coalesce(again, F.lit(0)).alias("__again"), *[F.coalesce(F.sum(f"__null_{c}"), F.lit(0)).alias(f"__null_{c}") for c in filled])
        cells = [(c, "not_null", f"__null_{c}") for c in filled] + ([(by, "unique", "__again")] if by else [])
        stack = ", ".join(f"'{c}', '{t}', cast(`{v}` as bigint)" for c, t, v in cells)
        parts.append(one.selectExpr(f"'{name}' as model", f"stack({len(cells)}, {stack}) as (column_name, test, violations)"))
        for c in single[1:]:
            parts.append(row(name, c, "unique", unique(df, c).agg(F.count(F.lit(1)).alias("violations"))))
        for c, parent, pk in declared.get("relationships", ()):
            parts.append(row(name, c, "relationships", relationships(df, c, models[parent], pk).agg(F.count(F.lit(1)).alias("violations"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_REPORT = T.StructType(
    [T.StructField("check_name", T.StringType()), T.StructField("state", T.StringType()), T.StructField("detail", T.StringType())]
)


def _row(check: str, failed: Column, detail_fail: Column, detail_pass: str = "passed") -> list[Column]:
    return [
        F.lit(check).alias("check_name"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("passed")).alias("state"),
        F.when(failed, detail_fail).otherwise(F.lit(detail_pass)).alias("detail"),
    ]


def hash_groups(raw: DataFrame, price_dataset: str = "listing_snapshots", price_field: str = "rent") -> DataFrame:
    """The one aggregation every gate check is derived from:
    rows, newest ingest time and unparseable prices per (dataset, hash, run).
    The shuffle is keyed by the hash, so no dataset lands in one task."""
    invalid = (F.col("dataset_name") == price_dataset) & F.col("payload").getItem(price_field).try_cast("double").isNull()
    return raw.groupBy("dataset_name", "record_hash", "run_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("ingested_at").alias("latest_ingested_at"),
        count_when(invalid).alias("invalid_price"),
    )


def quality_report(
    raw: DataFrame,
    required: Sequence[str],
    checks: Sequence[str] = KNOWN_CHECKS,
    price_dataset: str = "listing_snapshots",
    price_field: str = "rent",
    materialize: bool = True,
) -> DataFrame:
    """(check_name, state, detail) per requested check; unknown names are
    ``not_applicable``.

    Counts are one row per dataset, straight from the raw table; with
    ``materialize`` those few rows are checkpointed once to the shared checkpoint
    folder and every check reads them from there.  Repeated hashes are grouped
    in a pass of their own, of which five examples are kept."""
    groups = hash_groups(raw, price_dataset, price_field)
    invalid = (F.col("dataset_name") == price_dataset) & F.col("payload").getItem(price_field).try_cast("double").isNull()
    per_dataset = raw.groupBy("dataset_name").agg(F.count(F.lit(1)).alias("record_count"), count_when(invalid).alias("invalid_price"))
    if materialize:
        ensure_checkpoint_dir(raw.sparkSession)
        per_dataset = per_dataset.checkpoint(eager=True)
    parts: list[DataFrame] = []
    for check in checks:
        if check == RECORD_COUNTS:
            m = per_dataset.agg(
                F.count(F.lit(1)).alias("n"),
                F.array_join(F.sort_array(F.collect_list(F.when(F.col("record_count") <= 0, F.col("dataset_name")))), ", ").alias("empty"),
            )
            failed = (F.col("n") == 0) | (F.col("empty") != "")
            detail = F.when(F.col("n") == 0, F.lit("no raw records found")).otherwise(F.concat(F.lit("empty datasets "), F.col("empty")))
            parts.append(m.select(*_row(check, failed, detail)))
        elif check == REQUIRED_PRESENCE:
            m = per_dataset.where(F.col("dataset_name").isin(list(required))).agg(
                F.count(F.lit(1)).alias("loaded_dataset_count")
            )
            n = F.col("loaded_dataset_count")
            detail = F.format_string(f"loaded %d of {len(required)} required datasets", n)
            parts.append(m.select(*_row(check, n < len(required), detail)))
        elif check == DUPLICATE_HASHES:
            first5 = (
                groups.where(F.col("n") > 1)
                .orderBy("dataset_name", "record_hash", "run_id")
                .limit(5)
                .agg(
                    F.count(F.lit(1)).alias("n"),
                    F.array_join(
                        F.sort_array(F.collect_list(F.concat_ws(":", "dataset_name", "record_hash", "run_id"))), ", "
                    ).alias("examples"),
                )
            )
            parts.append(first5.select(*_row(check, F.col("n") > 0, F.col("examples"))))
        elif check == PRICE_QUALITY:
            m = per_dataset.agg(F.coalesce(F.sum("invalid_price"), F.lit(0)).alias("invalid_count"))
            n = F.col("invalid_count")
            detail = F.format_string("%d listing snapshots have invalid rent", n)
            parts.append(m.select(*_row(check, n > 0, detail)))
        else:
            spark = raw.sparkSession
            parts.append(spark.createDataFrame([(check, "not_applicable", "")], _REPORT))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def enforce(report: DataFrame) -> dict[str, str]:
    """Raise ``ValidationError`` for the first failed check; else return states."""
    rows = report.collect()
    for r in rows:
        if r["state"] == "failed":
            raise ValidationError(f"validation {r['check_name']} failed: {r['detail']}")
    return {r["check_name"]: r["state"] for r in rows}
