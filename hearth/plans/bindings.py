"""Bindings: reshape the driver's TPC-H-style tables into the six housing feeds.

The driver's data has no housing tables, so each feed is derived from a test
table by a fixed rule, and landed through the same envelope operator a real
feed would go through.  The DuckDB oracle (``plans.oracle``) derives the very
same rows with SQL.  Every binding reads whole tables; nothing is sampled.

Derived values only vary with modulo rules on keys so that NULLs, empty
strings and junk text reach the tolerant casts; no rows are filtered out.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions.scalar import utc_instant
from hearth.operators.envelope import SourceSpec, to_raw_records, union_raw

# Fixed values of the feeds (names, types and business keys of the six sources).
LISTINGS = SourceSpec("listing_snapshots", "listings", "file://listing_snapshots.csv", ("listing_id", "snapshot_date"))
RENT = SourceSpec("zillow_zori_zip", "rent_prices", "https://example.org/zori_zip.csv", ("RegionID",))
INVENTORY = SourceSpec("zillow_inventory_zip", "inventory", "https://example.org/inventory_zip.csv", ("RegionID",))
HOUSING = SourceSpec(
    "nyc_housing_units_by_building", "neighborhood_inventory", "https://example.org/housing_units.csv",
    ("project_id", "building_id"),
)
PERMITS = SourceSpec(
    "nyc_dob_approved_permits", "permits", "https://example.org/approved_permits.csv",
    ("job_filing_number", "work_permit", "sequence_number"),
)
STATIONS = SourceSpec("mta_subway_stations", "transit_access", "https://example.org/subway_stations.csv", ("Complex ID",))

REQUIRED_DATASETS = (
    "zillow_zori_zip",
    "zillow_inventory_zip",
    "nyc_housing_units_by_building",
    "nyc_dob_approved_permits",
    "mta_subway_stations",
    "listing_snapshots",
)

# Region key -> borough name, and -> station borough code.
BOROUGH_BY_REGION = {0: "Manhattan", 1: "Queens", 2: "Brooklyn", 3: "Bronx", 4: "Staten Island"}
BOROUGH_CODE_BY_REGION = {0: "M", 1: "Q", 2: "Bk", 3: "Bx", 4: "SI"}
STATUS_BY_ORDER_STATUS = {"O": "active", "F": "leased", "P": "pending"}

WIDE_INGESTED_AT = "2001-09-01 00:00:00"
STATIONS_INGESTED_AT = "2001-09-02 00:00:00"
HOUSING_INGESTED_AT = "2001-09-03 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give per-row work at least one task per core.

    A file with a single row group scans as one task, and the envelope work
    after it (payload maps, parsing, hashing) would then run on one core.  When
    the scan yields fewer partitions than the session's default parallelism the
    (column-pruned) rows are spread round-robin; a large input already has
    more partitions than cores and is left alone, so this costs nothing at
    scale."""
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # no RDD view of the plan (e.g. a remote session): leave it
        return df
    return df.repartition(want) if have < want else df


_LIKE_ROWS: ContextVar[bool] = ContextVar("like_rows_together", default=False)


@contextmanager
def like_rows_together() -> Iterator[None]:
    """Feeds that are built inside have like rows (of a day, a postal code, a kind) next to each other within a task.
    Landed as text they take less room compressed, as more of a row repeats the one before.  The columns of the source are
    sorted, before payloads are made of them; rows are the same."""
    token = _LIKE_ROWS.set(True)
    try:
        yield
    finally:
        _LIKE_ROWS.reset(token)


def _ordered(df: DataFrame, *columns: str) -> DataFrame:
    return df.sortWithinPartitions(*columns) if _LIKE_ROWS.get() else df


def _case(c: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def _text(c: Column) -> Column:
    return c.cast("string")


def _money_text(c: Column, precision: int = 12) -> Column:
    return c.cast(f"decimal({precision},2)").cast("string")


def _payload(entries: dict[str, Column]) -> Column:
    # create_map (not map_from_arrays): Catalyst folds payload['key'] on a
    # literal-keyed map into the value expression, so readers that only pick
    # fields never build the map.
    # Keys in sorted order: the content hash can skip its per-row sort.
    kv = []
    for k in sorted(entries):
        kv += [F.lit(k), entries[k].cast("string")]
    return F.create_map(*kv)


def _run_of_year(ts: Column) -> Column:
    return F.concat(F.lit("run-"), F.year(ts).cast("string"))


# ---------------------------------------------------------------------------
# feeds


def listings_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing snapshot per order: the customer is the listing, the order
    date the snapshot day, the customer's nation the postal code."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))
    c = table(spark, sf_dir, "customer")
    # nation is a scanned file: Spark sizes it from file statistics and
    # broadcasts it on that proven size; no hint or extra job needed.
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    j = _ordered(j, "o_orderdate", "c_nationkey", "c_mktsegment", "o_orderstatus", "o_orderpriority")
    day = F.col("o_orderdate").cast("date")
    return j.select(
        _payload(
            {
                "listing_id": _text(F.col("o_custkey")),
                "snapshot_date": _text(day),
                "address": F.col("c_name"),
                "postal_code": _text(F.col("c_nationkey")),
                "neighborhood": F.col("c_mktsegment"),
                "borough": _case(F.col("n_regionkey"), BOROUGH_BY_REGION),
                "rent": F.when(F.col("o_orderkey") % 101 == 0, F.lit("call for price")).otherwise(_money_text(F.col("o_totalprice"))),
                "bedrooms": _text(F.col("o_custkey") % 4),
                "bathrooms": F.when(F.col("o_custkey") % 3 == 0, F.lit("1.5")).otherwise(F.lit("1")),
                "sqft": _text(F.col("o_custkey") % 25 * 40 + 400),
                "property_type": F.when(F.col("o_custkey") % 4 == 0, F.lit("Studio")).otherwise(F.lit("Apartment")),
                "amenities": F.when(F.col("o_orderpriority").startswith("5"), F.lit("")).otherwise(
                    F.regexp_replace(F.lower(F.col("o_orderpriority")), "-", "|")
                ),
                "status": _case(F.col("o_orderstatus"), STATUS_BY_ORDER_STATUS, "pending"),
                "listed_date": _text(F.trunc(day, "month")),
                "latitude": F.concat(F.lit("40."), F.lpad(_text(F.col("o_custkey") % 100000), 5, "0")),
                "longitude": F.concat(F.lit("-73.9"), _text(F.col("c_nationkey"))),
            }
        ).alias("payload"),
        utc_instant(F.col("o_orderdate")).alias("ingested_at"),
        _run_of_year(F.col("o_orderdate")).alias("run_id"),
    )


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = listings_source(spark, sf_dir)
    # listing_id and snapshot_date are always present: no ordinal fallback needed.
    return to_raw_records(src, LISTINGS, F.col("run_id"), F.col("ingested_at"), payload=F.col("payload"), ordinal=False, payload_sorted=True)


def _wide_payload(monthly: DataFrame, region: str, value: str) -> DataFrame:
    """Per region: fixed attributes plus one ``yyyy-MM-01`` key per month."""
    per_region = monthly.groupBy(region).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("month_key"), F.col(value)))).alias("months")
    )
    attrs = _payload(
        {
            "RegionID": _text(F.col(region) + 10000),
            "SizeRank": _text(F.col(region) + 1),
            "RegionName": _text(F.col(region)),
            "RegionType": F.lit("zip"),
            "StateName": F.lit("NY"),
        }
    )
    return per_region.select(F.map_concat(attrs, F.col("months")).alias("payload"))


def rent_wide_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly rent index per nation: the highest order total of the month."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    monthly = (
        o.join(c, o.o_custkey == c.c_custkey)
        .groupBy("c_nationkey", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"))
        .agg(F.max("o_totalprice").alias("price"))
        .select("c_nationkey", _text(F.col("month")).alias("month_key"), _money_text(F.col("price")).alias("price"))
    )
    wide = _wide_payload(monthly, "c_nationkey", "price")
    return to_raw_records(wide, RENT, "run-wide", WIDE_INGESTED_AT, payload=F.col("payload"), ordinal=False, payload_sorted=False)


def inventory_wide_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly inventory per supplier nation: line items shipped that month."""
    l = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    monthly = (
        l.join(s, l.l_suppkey == s.s_suppkey)
        .groupBy("s_nationkey", F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("s_nationkey", _text(F.col("month")).alias("month_key"), _text(F.col("n")).alias("n"))
    )
    wide = _wide_payload(monthly, "s_nationkey", "n")
    return to_raw_records(wide, INVENTORY, "run-wide", WIDE_INGESTED_AT, payload=F.col("payload"), ordinal=False, payload_sorted=False)


def stations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station complex per supplier, borough from the supplier's region."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    k = F.col("s_suppkey")
    src = j.select(
        _payload(
            {
                "Complex ID": _text(k),
                "Is Complex": F.when(k % 2 == 0, F.lit("True")).otherwise(F.lit("false")),
                "Number Of Stations In Complex": F.when(k % 7 == 0, F.lit("")).otherwise(_text(k % 4 + 1)),
                "Stop Name": F.col("s_name"),
                "Display Name": F.col("s_name"),
                "Borough": _case(F.col("n_regionkey"), BOROUGH_CODE_BY_REGION),
                "CBD": F.when(F.col("s_acctbal") > 0, F.lit("TRUE")).otherwise(F.lit("false")),
                "Daytime Routes": F.lit("A C"),
                "Structure Type": F.lit("Subway"),
                "Latitude": F.concat(F.lit("40.7"), _text(k % 1000)),
                "Longitude": F.concat(F.lit("-73.9"), _text(k % 1000)),
                "ADA": _text(k % 3),
                "ADA Notes": F.lit(""),
            }
        ).alias("payload")
    )
    return to_raw_records(src, STATIONS, "run-stations", STATIONS_INGESTED_AT, payload=F.col("payload"), ordinal=False, payload_sorted=True)


def housing_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One housing building per part; the brand is the project."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    src = p.select(
        _payload(
            {
                "project_id": F.col("p_brand"),
                "project_name": F.col("p_name"),
                "project_start_date": _text(F.date_add(F.lit("2015-01-01").cast("date"), (k % 365).cast("int"))),
                "project_completion_date": F.when(k % 3 == 0, F.lit("")).otherwise(
                    _text(F.date_add(F.lit("2018-01-01").cast("date"), (k % 700).cast("int")))
                ),
                "building_id": _text(k),
                "house_number": _text(k % 300 + 1),
                "street_name": F.col("p_name"),
                "borough": F.concat(F.lit("B"), _text(k % 2)),
                "postcode": F.when(k % 50 == 0, F.lit(None)).otherwise(_text(k % 25)),
                "bbl": _text(k + 1000000000),
                "bin": _text(k + 2000000),
                "community_board": _text(k % 12 + 1),
                "neighborhood_tabulation_area": F.when(F.col("p_type") == "ECONOMY", F.lit(None)).otherwise(F.col("p_type")),
                "latitude": F.concat(F.lit("40.6"), _text(k % 1000)),
                "longitude": F.concat(F.lit("-73.8"), _text(k % 1000)),
                "reporting_construction_type": F.when(k % 2 == 0, F.lit("New Construction")).otherwise(F.lit("Preservation")),
                "extended_affordability_status": F.lit("No"),
                "counted_rental_units": F.when(F.col("p_size") % 9 == 0, F.lit(None)).otherwise(_text(F.col("p_size"))),
                "all_counted_units": _text(F.col("p_size")),
                "total_units": _text(F.col("p_size")),
            }
        ).alias("payload")
    )
    return to_raw_records(src, HOUSING, "run-housing", HOUSING_INGESTED_AT, payload=F.col("payload"), ordinal=False, payload_sorted=True)


def permits_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One permit per line item: supplier nation is the zip, part type the NTA
    (ECONOMY becomes an empty NTA, so NULL-vs-empty matching is exercised)."""
    l = spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"
        )
    )
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    # the supplier last: its name does not pass through the larger join's shuffle
    j = l.join(p, l.l_partkey == p.p_partkey).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    j = _ordered(j, "l_shipdate", "s_nationkey", "p_type", "l_returnflag", "l_linestatus", "l_suppkey")
    ship = F.col("l_shipdate").cast("date")
    src = j.select(
        _payload(
            {
                "job_filing_number": _text(F.col("l_orderkey")),
                "work_permit": _text(F.col("l_linenumber")),
                "sequence_number": _text(F.col("l_partkey")),
                "filing_reason": F.col("l_returnflag"),
                "house_no": _text(F.col("l_suppkey")),
                "street_name": F.col("s_name"),
                "borough": F.concat(F.lit("B"), _text(F.col("s_nationkey") % 5)),
                "zip_code": _text(F.col("s_nationkey")),
                "community_board": _text(F.col("s_nationkey") % 12 + 1),
                "census_tract": _text(F.col("l_partkey") % 500),
                "nta": F.when(F.col("p_type") == "ECONOMY", F.lit("")).otherwise(F.col("p_type")),
                "work_type": F.col("l_linestatus"),
                "approved_date": _text(F.date_sub(ship, 30)),
                "issued_date": F.concat(_text(ship), F.lit("T00:00:00.000")),
                "expired_date": F.lit(""),
                "job_description": F.lit("alteration"),
                "estimated_job_costs": F.concat(F.lit("$"), _money_text(F.col("l_extendedprice"), 14)),
                "permit_status": F.lit("Issued"),
                "latitude": F.concat(F.lit("40.5"), _text(F.col("l_suppkey") % 1000)),
                "longitude": F.concat(F.lit("-74.0"), _text(F.col("l_suppkey") % 1000)),
            }
        ).alias("payload"),
        utc_instant(ship.cast("timestamp_ntz")).alias("ingested_at"),
        _run_of_year(ship).alias("run_id"),
    )
    return to_raw_records(src, PERMITS, F.col("run_id"), F.col("ingested_at"), payload=F.col("payload"), ordinal=False, payload_sorted=True)


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shared raw table: all six feeds, UNION ALL."""
    return union_raw(
        [
            rent_wide_raw(spark, sf_dir),
            inventory_wide_raw(spark, sf_dir),
            housing_raw(spark, sf_dir),
            permits_raw(spark, sf_dir),
            stations_raw(spark, sf_dir),
            listings_raw(spark, sf_dir),
        ]
    )
