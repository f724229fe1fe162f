"""Operator-level keys: envelope, payload, merge, join, aggregate, window,
scalar-function and data-quality operators, each on whole bound tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions import (
    decode,
    field,
    has_field,
    keys_matching,
    money,
    parse_bool,
    payload_of,
    surrogate_key,
    try_date,
    try_decimal,
    try_number,
    try_timestamp,
    unpivot,
)
from hearth.operators import quality
from hearth.operators.aggregates import rollup_sum
from hearth.operators.envelope import (
    SourceSpec,
    dataset_slice,
    ingest_summary,
    payload_from_columns,
    record_hash,
    source_row_id,
    to_raw_records,
    union_raw,
)
from hearth.operators.joins import anti
from hearth.operators.merge import incremental, insert_ignore, merge_insert, since_watermark
from hearth.operators.ordinal import with_dense_index
from hearth.operators.relational import distinct_rows, project, where_in, where_present
from hearth.plans import bindings, intermediate, marts, oracle
from hearth.plans.oracle import compose, fragment, q
from hearth.plans.graph import SHARED_MODELS, ModelGraph
from hearth.plans.registry import register, register_fragment
from hearth.plans.staging import STATION_BOROUGHS
from hearth.schemas import ENVELOPE_KEYS

P = ModelGraph


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return bindings.table(spark, d, name)


# ---------------------------------------------------------------------------
# envelope

CUSTOMERS = SourceSpec("customers", "customer", "file://customer.csv", ("c_custkey",))
SUPPLIERS = SourceSpec("suppliers", "supplier", "file://supplier.csv", ("S_SUPPKEY", "Supplier Name", "Nation Key"))
EVENTS = SourceSpec("events", "event", "file://events.jsonl", ("event_id",))
FIXED_RUN = "run-1"
FIXED_TS = "2024-01-01 00:00:00"
RAW_COLS = (
    "dataset_name s, dataset_type s, source_url s, source_row_id s, record_hash s, extracted_at t, "
    "ingested_at t, run_id s, original_s3_key s, payload m"
)


def customers_raw(spark, d):
    return to_raw_records(_t(spark, d, "customer"), CUSTOMERS, FIXED_RUN, FIXED_TS)


def _supplier_payload(df: DataFrame):
    blank = F.col("s_suppkey") % 10 == 0
    return F.map_from_arrays(
        F.array(F.lit("s_suppkey"), F.lit("supplier name"), F.lit("Nation_Key")),
        F.array(
            F.when(blank, F.lit("")).otherwise(F.col("s_suppkey").cast("string")),
            F.when(blank, F.lit(None)).otherwise(F.col("s_name")),
            F.when(blank, F.lit("")).otherwise(F.col("s_nationkey").cast("string")),
        ),
    )


def suppliers_raw(spark, d):
    s = _t(spark, d, "supplier")
    return to_raw_records(s, SUPPLIERS, FIXED_RUN, FIXED_TS, payload=_supplier_payload(s))


_CUSTOMER_PAYLOAD = oracle.payload(
    [(c, c) for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")]
)
fragment("customers_src", f"SELECT {_CUSTOMER_PAYLOAD} AS payload FROM customer")
fragment("customers_raw", oracle.envelope("customers_src", CUSTOMERS, q(FIXED_RUN), q(FIXED_TS)), "customers_src")
fragment(
    "suppliers_src",
    """
SELECT s_suppkey, map_from_entries([
    ('s_suppkey', CASE WHEN s_suppkey % 10 = 0 THEN '' ELSE cast(s_suppkey AS VARCHAR) END),
    ('supplier name', CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE s_name END),
    ('Nation_Key', CASE WHEN s_suppkey % 10 = 0 THEN '' ELSE cast(s_nationkey AS VARCHAR) END)
  ]) AS payload,
  row_number() OVER (ORDER BY s_suppkey) AS ordinal
FROM supplier
""",
)
_SUPPLIER_PARTS = ", ".join(oracle.key_part(k) for k in SUPPLIERS.primary_key)
_SUPPLIER_RID = (
    f"CASE WHEN concat({_SUPPLIER_PARTS}) = '' THEN 'suppliers:' || cast(ordinal AS VARCHAR) "
    f"ELSE concat_ws('|', {_SUPPLIER_PARTS}) END"
)
fragment(
    "suppliers_raw",
    f"""
SELECT 'suppliers' AS dataset_name, 'supplier' AS dataset_type, 'file://supplier.csv' AS source_url, rid AS source_row_id,
       {oracle.record_hash_sql("'suppliers'", "'supplier'", "'file://supplier.csv'", 'rid')} AS record_hash,
       cast({q(FIXED_TS)} AS TIMESTAMP) AS extracted_at, cast({q(FIXED_TS)} AS TIMESTAMP) AS ingested_at,
       {q(FIXED_RUN)} AS run_id, cast(NULL AS VARCHAR) AS original_s3_key, payload, s_suppkey
FROM (SELECT *, {_SUPPLIER_RID} AS rid FROM suppliers_src)
""",
    "suppliers_src",
)

register_fragment("envelope_build", RAW_COLS, customers_raw, "customers_raw")
register_fragment(
    "envelope_row_id",
    "s_suppkey i, source_row_id s",
    lambda spark, d: (
        lambda s: with_dense_index(s, "__ord").select(
            "s_suppkey",
            source_row_id(
                _supplier_payload(s), SUPPLIERS.primary_key, F.concat(F.lit("suppliers:"), F.col("__ord").cast("string"))
            ).alias("source_row_id"),
        )
    )(_t(spark, d, "supplier")),
    "suppliers_raw",
)
register(
    "envelope_ordinal",
    "o_orderkey i, ordinal i",
    lambda spark, d: with_dense_index(_t(spark, d, "orders").select("o_orderkey"), "ordinal"),
    "SELECT cast(o_orderkey AS BIGINT) AS o_orderkey, cast(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS ordinal FROM orders",
)


def _events_hash(spark, d):
    e = _t(spark, d, "events")
    p = payload_from_columns(e)
    return e.select(
        "event_id",
        record_hash(F.lit("events"), F.lit("event"), F.lit("file://events.jsonl"), F.col("event_id").cast("string"), p, True).alias(
            "record_hash"
        ),
    )


_EVENTS_PAYLOAD = oracle.payload([(c, c) for c in ("event_id", "ts", "user_id", "event_type", "value", "props")])
register(
    "envelope_hash",
    "event_id i, record_hash s",
    _events_hash,
    f"SELECT event_id, {oracle.record_hash_sql(q('events'), q('event'), q('file://events.jsonl'), 'cast(event_id AS VARCHAR)', _EVENTS_PAYLOAD)} AS record_hash FROM events",
)
register(
    "envelope_union",
    "dataset_name s, source_row_id s, record_hash s",
    lambda spark, d: union_raw([customers_raw(spark, d), suppliers_raw(spark, d)]),
    compose(
        "SELECT dataset_name, source_row_id, record_hash FROM customers_raw UNION ALL "
        "SELECT dataset_name, source_row_id, record_hash FROM suppliers_raw",
        "customers_raw",
        "suppliers_raw",
    ),
)
register(
    "ingest_summary",
    "dataset_name s, dataset_type s, row_count i",
    lambda spark, d: ingest_summary(P(spark, d).raw),
    compose("SELECT dataset_name, dataset_type, count(*) AS row_count FROM raw_records GROUP BY 1, 2", "raw_records"),
)
register_fragment(
    "dataset_slice",
    "dataset_name s, source_row_id s, record_hash s, run_id s",
    lambda spark, d: dataset_slice(P(spark, d).raw, "mta_subway_stations"),
    "raw_records",
    "dataset_name = 'mta_subway_stations'",
)

# ---------------------------------------------------------------------------
# payload access, filters, projections

register(
    "payload_extract",
    "event_id i, k s, missing s",
    lambda spark, d: _t(spark, d, "events").select(
        "event_id",
        field(F.from_json("props", "map<string,string>"), "k").alias("k"),
        field(F.from_json("props", "map<string,string>"), "no such key").alias("missing"),
    ),
    "SELECT event_id, json_extract_string(props, '$.k') AS k, cast(NULL AS VARCHAR) AS missing FROM events",
)
register(
    "payload_present",
    "source_row_id s, postcode s",
    lambda spark, d: bindings.housing_raw(spark, d)
    .where(has_field("payload", "postcode"))
    .select("source_row_id", field("payload", "postcode").alias("postcode")),
    compose("SELECT source_row_id, payload['postcode'] AS postcode FROM housing_raw WHERE payload['postcode'] IS NOT NULL", "housing_raw"),
)
register(
    "unpivot_dates",
    "postal_code s, month_key s, month_value s",
    lambda spark, d: bindings.rent_wide_raw(spark, d).select(
        field("payload", "RegionName").alias("postal_code"), F.explode(keys_matching("payload")).alias("month_key", "month_value")
    ),
    compose(
        "SELECT payload['RegionName'] AS postal_code, e['key'] AS month_key, e['value'] AS month_value "
        "FROM (SELECT *, unnest(map_entries(payload)) AS e FROM rent_wide_raw) "
        "WHERE regexp_full_match(e['key'], '[0-9]{4}-[0-9]{2}-[0-9]{2}')",
        "rent_wide_raw",
    ),
)


# the same access to a payload of VARIANT type: all events, with numbers, nested values, JSON null and a key with a space
def events_variant(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events")
    doc = F.struct(
        "event_id", F.col("event_type").alias("Event Type"), F.col("event_type").alias("type"), "user_id",
        F.when(F.col("event_id") % 3 == 0, F.col("user_id")).alias("maybe"), F.from_json("props", "struct<k: string>").alias("nested"),
        (F.col("event_id") % 2 == 0).alias("even"), F.date_format("ts", "yyyy-MM-dd").alias("2024-01-01"),
    )
    return e.select("event_id", F.parse_json(F.to_json(doc, {"ignoreNullFields": "false"})).alias("payload"))


VARIANT_KEYS = ("Event Type", "user_id", "maybe", "nested", "even")


def _payload_variant(spark, d):
    e = events_variant(spark, d)
    p = payload_of(e)
    present = e.where(has_field(p, "maybe") & ~has_field(p, "missing"))  # a JSON null is a value
    names = F.array(*[F.lit(k) for k in VARIANT_KEYS])
    texts = F.array(*[field(p, k) for k in VARIANT_KEYS])
    return present.select("event_id", F.explode(F.arrays_zip(names.alias("key"), texts.alias("value"))).alias("m")).select("event_id", "m.key", "m.value")


_VARIANT_SQL = {
    "Event Type": "event_type", "user_id": "cast(user_id AS VARCHAR)", "maybe": "CASE WHEN event_id % 3 = 0 THEN cast(user_id AS VARCHAR) END",
    "nested": "'{\"k\":\"' || json_extract_string(props, '$.k') || '\"}'", "even": "CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END",
}
register(
    "payload_variant",
    "event_id i, key s, value s",
    _payload_variant,
    " UNION ALL ".join(f"SELECT event_id, {q(k)} AS key, {sql} AS value FROM events" for k, sql in _VARIANT_SQL.items()),
)
register(
    "unpivot_variant",
    "event_id i, key s, value s",
    lambda spark, d: unpivot(events_variant(spark, d), "payload", "^([0-9-]+|user_id|maybe)$"),
    "SELECT event_id, '2024-01-01' AS key, strftime(ts, '%Y-%m-%d') AS value FROM events UNION ALL "
    "SELECT event_id, 'user_id', cast(user_id AS VARCHAR) FROM events UNION ALL "
    f"SELECT event_id, 'maybe', {_VARIANT_SQL['maybe']} FROM events",
)
IN_LIST = ("mta_subway_stations", "zillow_zori_zip", "no_such_feed")
register_fragment(
    "filter_in_list",
    "dataset_name s, source_row_id s, record_hash s",
    lambda spark, d: where_in(P(spark, d).raw, "dataset_name", IN_LIST),
    "raw_records",
    "dataset_name IN (" + ", ".join(q(v) for v in IN_LIST) + ")",
)
register_fragment(
    "filter_not_null",
    "listing_snapshot_id s, rent d",
    lambda spark, d: where_present(P(spark, d).stg_listing_snapshots, "rent"),
    "stg_listing_snapshots",
    "rent IS NOT NULL",
)
OLD_CUTOFF = "1998-06-01"


def _history_old(p: ModelGraph) -> DataFrame:
    return p.fct_listing_history.where(F.col("snapshot_date") < F.lit(OLD_CUTOFF).cast("date"))


register(
    "high_water_mark",
    "listing_snapshot_id s, snapshot_date t",
    lambda spark, d: (lambda p: since_watermark(p.fct_listing_history, _history_old(p), "snapshot_date"))(P(spark, d)),
    compose(
        "SELECT listing_snapshot_id, cast(snapshot_date AS VARCHAR) AS snapshot_date FROM fct_listing_history "
        "WHERE snapshot_date >= (SELECT coalesce(max(snapshot_date), DATE '1900-01-01') FROM fct_listing_history "
        f"WHERE snapshot_date < DATE '{OLD_CUTOFF}')",
        "fct_listing_history",
    ),
)
register(
    "project_rename",
    "development_activity_id s, postal_code s, nta s, permit_count i",
    lambda spark, d: project(
        P(spark, d).int_neighborhood_development_signals,
        {"development_signal_id": "development_activity_id", "postal_code": "postal_code", "neighborhood_code": "nta", "permit_count": "permit_count"},
    ),
    compose(
        "SELECT development_signal_id AS development_activity_id, postal_code, neighborhood_code AS nta, "
        "cast(permit_count AS BIGINT) AS permit_count FROM int_neighborhood_development_signals",
        "int_neighborhood_development_signals",
    ),
)
register(
    "distinct_rows",
    "postal_code s, neighborhood s, borough s",
    lambda spark, d: distinct_rows(P(spark, d).stg_listing_snapshots, "postal_code", "neighborhood", "borough"),
    compose("SELECT DISTINCT postal_code, neighborhood, borough FROM stg_listing_snapshots", "stg_listing_snapshots"),
)

# ---------------------------------------------------------------------------
# merges: target = runs up to 1997; batch = runs from 1997 on, plus run 2001 again

TARGET_LAST_RUN = "run-1997"
BATCH_REPEAT_RUN = "run-2001"


def _merge_inputs(spark, d):
    raw = bindings.listings_raw(spark, d)
    target = raw.where(F.col("run_id") <= TARGET_LAST_RUN)
    batch = raw.where(F.col("run_id") >= TARGET_LAST_RUN).unionByName(raw.where(F.col("run_id") == BATCH_REPEAT_RUN))
    return target, batch


fragment("merge_target", f"SELECT * FROM listings_raw WHERE run_id <= '{TARGET_LAST_RUN}'", "listings_raw")
fragment(
    "merge_batch",
    f"SELECT * FROM listings_raw WHERE run_id >= '{TARGET_LAST_RUN}' UNION ALL SELECT * FROM listings_raw WHERE run_id = '{BATCH_REPEAT_RUN}'",
    "listings_raw",
)
_KEYJOIN = " AND ".join(f"b.{k} = t.{k}" for k in ENVELOPE_KEYS)
fragment(
    "merge_new_rows",
    f"SELECT b.* FROM merge_batch b WHERE NOT EXISTS (SELECT 1 FROM merge_target t WHERE {_KEYJOIN})",
    "merge_batch",
    "merge_target",
)
fragment("merged_insert", "SELECT * FROM merge_target UNION ALL SELECT * FROM merge_new_rows", "merge_target", "merge_new_rows")
fragment(
    "merged_ignore",
    f"""
SELECT * FROM merge_target UNION ALL
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(ENVELOPE_KEYS)} ORDER BY ingested_at, run_id) AS rn FROM merge_new_rows
) WHERE rn = 1
""",
    "merge_target",
    "merge_new_rows",
)
MERGE_COLS = "dataset_name s, source_row_id s, record_hash s, run_id s"


def _merged_insert(spark, d):
    target, batch = _merge_inputs(spark, d)
    return merge_insert(target, batch, ENVELOPE_KEYS)


register_fragment("merge_insert_new", MERGE_COLS, _merged_insert, "merged_insert")
register_fragment(
    "merge_insert_ignore",
    MERGE_COLS,
    lambda spark, d: insert_ignore(*_merge_inputs(spark, d), ENVELOPE_KEYS, order=["ingested_at", "run_id"]),
    "merged_ignore",
)
register_fragment(
    "merge_idempotent",
    MERGE_COLS,
    lambda spark, d: (lambda t, b: merge_insert(merge_insert(t, b, ENVELOPE_KEYS), b, ENVELOPE_KEYS))(*_merge_inputs(spark, d)),
    "merged_insert",
)
register_fragment(
    "join_left_anti",
    MERGE_COLS,
    lambda spark, d: anti(*_merge_inputs(spark, d)[::-1], ENVELOPE_KEYS),
    "merge_new_rows",
)
fragment(
    "history_upserted",
    f"""
SELECT * FROM hw_batch UNION ALL
SELECT o.* FROM (SELECT * FROM fct_listing_history WHERE snapshot_date < DATE '{OLD_CUTOFF}') o
WHERE NOT EXISTS (SELECT 1 FROM hw_batch b WHERE b.listing_snapshot_id = o.listing_snapshot_id)
""",
    "hw_batch",
)
fragment(
    "hw_batch",
    "SELECT * FROM fct_listing_history WHERE snapshot_date >= (SELECT coalesce(max(snapshot_date), DATE '1900-01-01') "
    f"FROM fct_listing_history WHERE snapshot_date < DATE '{OLD_CUTOFF}')",
    "fct_listing_history",
)
FRAG_HISTORY_COLS = "listing_snapshot_id s, listing_id s, snapshot_date t, rent d, rent_change_amount d, rent_change_pct f, days_on_market i"
register_fragment(
    "merge_upsert",
    FRAG_HISTORY_COLS,
    lambda spark, d: (lambda p: incremental(p.fct_listing_history, _history_old(p), "listing_snapshot_id", "snapshot_date"))(P(spark, d)),
    "history_upserted",
)

# ---------------------------------------------------------------------------
# joins (operator views of the models)

register_fragment(
    "join_full_outer",
    "postal_code s, state_name s, signal_month t, zori_rent d, active_inventory d",
    lambda spark, d: (lambda p: intermediate.zip_month_joined(p.stg_rent_prices, p.stg_inventory))(P(spark, d)),
    "zip_month_joined",
)
register_fragment(
    "join_full_outer_nullsafe",
    "development_signal_id s, borough s, postal_code s, neighborhood_code s, housing_projects i, permit_count i",
    lambda spark, d: P(spark, d).int_neighborhood_development_signals,
    "int_neighborhood_development_signals",
)
register_fragment(
    "join_full_outer_dim",
    "neighborhood_id s, postal_code s, neighborhood s, borough s, neighborhood_code s, permit_count i",
    lambda spark, d: P(spark, d).dim_neighborhoods,
    "dim_neighborhoods",
)
register_fragment(
    "join_left_broadcast",
    "borough s, snapshot_date t, listing_count i, station_complex_count i, rent_per_station_complex f",
    lambda spark, d: P(spark, d).mart_transit_price_effect,
    "mart_transit_price_effect",
)
register_fragment(
    "join_left_chain",
    "neighborhood_scorecard_id s, postal_code s, latest_rent_month t, listing_count i, estimated_development_cost d, development_activity_band s",
    lambda spark, d: P(spark, d, materialize=SHARED_MODELS).mart_neighborhood_scorecard,
    "mart_neighborhood_scorecard",
)

# ---------------------------------------------------------------------------
# aggregates

register(
    "agg_group",
    "borough s, permit_rows i, latest_issued t",
    lambda spark, d: P(spark, d).stg_permits.groupBy("borough").agg(
        F.count(F.lit(1)).alias("permit_rows"), F.max("issued_date").alias("latest_issued")
    ),
    compose(
        "SELECT borough, count(*) AS permit_rows, cast(max(issued_date) AS VARCHAR) AS latest_issued FROM stg_permits GROUP BY 1",
        "stg_permits",
    ),
)
register(
    "agg_count_distinct",
    "postal_code s, permits i, filings i",
    lambda spark, d: P(spark, d).stg_permits.groupBy("postal_code").agg(
        F.count_distinct("permit_id").alias("permits"), F.count_distinct("job_filing_number").alias("filings")
    ),
    compose(
        "SELECT postal_code, count(DISTINCT permit_id) AS permits, count(DISTINCT job_filing_number) AS filings FROM stg_permits GROUP BY 1",
        "stg_permits",
    ),
)
register_fragment(
    "agg_sum_default",
    "borough s, postal_code s, neighborhood_code s, housing_projects i, affordable_rental_units d, total_housing_units d",
    lambda spark, d: intermediate.housing_by_area(P(spark, d).stg_neighborhood_housing),
    "housing_by_area",
)
register_fragment(
    "agg_conditional",
    "borough s, station_complex_count i, station_count d, ada_station_complex_count i, cbd_station_complex_count i",
    lambda spark, d: P(spark, d).int_transit_access_by_borough,
    "int_transit_access_by_borough",
)
register_fragment(
    "agg_avg_median",
    "borough s, snapshot_date t, avg_listing_rent f, median_listing_rent r, listing_count i",
    lambda spark, d: marts.listing_borough_rents(P(spark, d).stg_listing_snapshots, "ranked"),
    "listing_borough_rents",
)
register_fragment(
    "agg_any_value",
    "postal_code s, neighborhood_code s, borough s, housing_projects i, affordable_rental_units d, permit_count i",
    lambda spark, d: marts.development_by_zip(P(spark, d).int_neighborhood_development_signals),
    "development_by_zip",
)
register(
    "agg_rollup_sum",
    "postal_code s, housing_projects i, affordable_rental_units d, permit_count i",
    lambda spark, d: rollup_sum(
        P(spark, d).int_neighborhood_development_signals, ["postal_code"], ["housing_projects", "affordable_rental_units", "permit_count"]
    ),
    compose(
        "SELECT postal_code, cast(sum(housing_projects) AS BIGINT) AS housing_projects, cast(sum(affordable_rental_units) AS DOUBLE) AS affordable_rental_units, "
        "cast(sum(permit_count) AS BIGINT) AS permit_count FROM int_neighborhood_development_signals GROUP BY 1",
        "int_neighborhood_development_signals",
    ),
)
register(
    "check_duplicate_hashes",
    "dataset_name s, record_hash s, run_id s, duplicate_count i",
    lambda spark, d: quality.duplicate_hashes(_merged_insert(spark, d), 100),
    compose(
        "SELECT dataset_name, record_hash, run_id, count(*) AS duplicate_count FROM merged_insert "
        "GROUP BY 1, 2, 3 HAVING count(*) > 1 ORDER BY 1, 2, 3 LIMIT 100",
        "merged_insert",
    ),
)
register(
    "violation_sample",
    "dataset_name s, record_hash s, run_id s, duplicate_count i",
    lambda spark, d: quality.duplicate_hashes(_merged_insert(spark, d), 5),
    compose(
        "SELECT dataset_name, record_hash, run_id, count(*) AS duplicate_count FROM merged_insert "
        "GROUP BY 1, 2, 3 HAVING count(*) > 1 ORDER BY 1, 2, 3 LIMIT 5",
        "merged_insert",
    ),
)
register(
    "check_required_datasets",
    "loaded_dataset_count i",
    lambda spark, d: quality.required_datasets(P(spark, d).raw, bindings.REQUIRED_DATASETS),
    compose(
        "SELECT count(DISTINCT dataset_name) AS loaded_dataset_count FROM raw_records WHERE dataset_name IN ("
        + ", ".join(q(n) for n in bindings.REQUIRED_DATASETS)
        + ")",
        "raw_records",
    ),
)

# ---------------------------------------------------------------------------
# windows

register_fragment(
    "window_latest_per_key",
    "listing_id s, current_status s, current_rent d, latest_snapshot_date t",
    lambda spark, d: P(spark, d).dim_listings,
    "dim_listings",
)
register_fragment(
    "window_qualify_latest",
    "postal_code s, signal_month t, zori_rent d, rent_volatility_band s",
    lambda spark, d: marts.latest_rent(P(spark, d).fct_rent_trends),
    "latest_rent",
)
register_fragment(
    "window_lag_delta",
    "listing_snapshot_id s, rent d, rent_change_amount d",
    lambda spark, d: P(spark, d).fct_listing_history,
    "fct_listing_history",
)
register_fragment(
    "window_pct_change",
    "listing_snapshot_id s, rent_change_pct f",
    lambda spark, d: P(spark, d).fct_listing_history,
    "fct_listing_history",
)
register_fragment(
    "window_yoy_ratio",
    "zip_month_signal_id s, rent_yoy_pct f, rent_mom_delta d, inventory_mom_delta d",
    lambda spark, d: P(spark, d).int_zip_month_market_signals,
    "int_zip_month_market_signals",
)
register_fragment(
    "window_rolling_stddev",
    "zip_month_signal_id s, six_month_rent_volatility r",
    lambda spark, d: P(spark, d).int_zip_month_market_signals,
    "int_zip_month_market_signals",
)

# ---------------------------------------------------------------------------
# scalar functions


def _date_texts(spark, d):
    o = _t(spark, d, "orders")
    day = F.col("o_orderdate").cast("date")
    m = F.col("o_orderkey") % 6
    txt = (
        F.when(m == 0, day.cast("string"))
        .when(m == 1, F.concat(day.cast("string"), F.lit("T00:00:00.000")))
        .when(m == 2, F.date_format(day, "M/d/yyyy"))
        .when(m == 3, F.concat(F.year(day).cast("string"), F.lit("-02-30")))
        .when(m == 4, F.year(day).cast("string"))
        .otherwise(F.lit("soon"))
    )
    return o.select("o_orderkey", txt.alias("txt")).select("o_orderkey", "txt", try_date("txt").alias("parsed"))


register(
    "fn_try_date",
    "o_orderkey i, txt s, parsed t",
    _date_texts,
    f"""
SELECT o_orderkey, txt, cast({oracle.try_date('txt')} AS VARCHAR) AS parsed FROM (
  SELECT o_orderkey, CASE o_orderkey % 6
      WHEN 0 THEN cast(cast(o_orderdate AS DATE) AS VARCHAR)
      WHEN 1 THEN cast(cast(o_orderdate AS DATE) AS VARCHAR) || 'T00:00:00.000'
      WHEN 2 THEN strftime(cast(o_orderdate AS DATE), '%-m/%-d/%Y')
      WHEN 3 THEN cast(year(o_orderdate) AS VARCHAR) || '-02-30'
      WHEN 4 THEN cast(year(o_orderdate) AS VARCHAR)
      ELSE 'soon' END AS txt
  FROM orders)
""",
)


def _decimal_texts(spark, d):
    l = _t(spark, d, "lineitem")
    m = F.col("l_linenumber") % 4
    txt = (
        F.when(m == 0, F.col("l_extendedprice").cast("decimal(14,2)").cast("string"))
        .when(m == 1, F.concat(F.col("l_orderkey").cast("string"), F.lit("000000000.5")))
        .when(m == 2, F.lit(""))
        .otherwise(F.concat(F.lit("~"), F.col("l_quantity").cast("decimal(10,1)").cast("string")))
    )
    qty = (F.col("l_quantity").cast("decimal(10,1)") + F.lit(0.5)).cast("string")
    return l.select("l_orderkey", "l_linenumber", txt.alias("txt"), qty.alias("qty_txt")).select(
        "l_orderkey",
        "l_linenumber",
        "txt",
        try_decimal("txt", 12, 2).alias("dec"),
        "qty_txt",
        try_number("qty_txt").alias("num"),
    )


_DEC_SQL = """
SELECT l_orderkey, l_linenumber, txt, cast(try_cast(txt AS DECIMAL(12,2)) AS DOUBLE) AS dec,
       qty_txt, cast(try_cast(qty_txt AS DECIMAL(38,0)) AS DOUBLE) AS num FROM (
  SELECT l_orderkey, l_linenumber,
    CASE l_linenumber % 4
      WHEN 0 THEN cast(cast(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR)
      WHEN 1 THEN cast(l_orderkey AS VARCHAR) || '000000000.5'
      WHEN 2 THEN ''
      ELSE '~' || cast(cast(l_quantity AS DECIMAL(10,1)) AS VARCHAR) END AS txt,
    cast(cast(l_quantity AS DECIMAL(10,1)) + 0.5 AS VARCHAR) AS qty_txt
  FROM lineitem)
"""
register("fn_try_decimal", "l_orderkey i, l_linenumber i, txt s, dec d", _decimal_texts, _DEC_SQL.replace("qty_txt, cast(try_cast(qty_txt AS DECIMAL(38,0)) AS DOUBLE) AS num", "1 AS one").replace("SELECT l_orderkey, l_linenumber, txt, cast(try_cast(txt AS DECIMAL(12,2)) AS DOUBLE) AS dec,\n       1 AS one", "SELECT l_orderkey, l_linenumber, txt, cast(try_cast(txt AS DECIMAL(12,2)) AS DOUBLE) AS dec"))
register(
    "fn_try_number",
    "l_orderkey i, l_linenumber i, qty_txt s, num d",
    _decimal_texts,
    "SELECT l_orderkey, l_linenumber, qty_txt, num FROM (" + _DEC_SQL + ")",
)


def _timestamp_texts(spark, d):
    e = _t(spark, d, "events")
    m = F.col("event_id") % 3
    txt = (
        F.when(m == 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(m == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.lit("yesterday"))
    )
    return e.select("event_id", txt.alias("txt")).select("event_id", "txt", try_timestamp("txt", assume_utc=True).alias("parsed"))


register(
    "fn_try_timestamp",
    "event_id i, txt s, parsed t",
    _timestamp_texts,
    """
SELECT event_id, txt, cast(CASE
    WHEN regexp_full_match(txt, '\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}[+-]\\d{2}:\\d{2}')
      THEN try_cast(replace(substr(txt, 1, 19), 'T', ' ') AS TIMESTAMP)
           - to_minutes(cast((CASE WHEN substr(txt, 20, 1) = '-' THEN -1 ELSE 1 END)
                             * (cast(substr(txt, 21, 2) AS INTEGER) * 60 + cast(substr(txt, 24, 2) AS INTEGER)) AS BIGINT))
    ELSE try_cast(txt AS TIMESTAMP) END AS VARCHAR) AS parsed
FROM (
  SELECT event_id, CASE event_id % 3
      WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00'
      WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      ELSE 'yesterday' END AS txt
  FROM events)
""",
)
register(
    "fn_surrogate_key",
    "o_orderkey i, listing_day_key s, nullable_key s",
    lambda spark, d: _t(spark, d, "orders").select(
        "o_orderkey",
        surrogate_key(F.col("o_custkey"), F.col("o_orderdate").cast("date")).alias("listing_day_key"),
        surrogate_key(
            F.col("o_custkey"), F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_orderpriority"))
        ).alias("nullable_key"),
    ),
    "SELECT o_orderkey, md5(cast(o_custkey AS VARCHAR) || '|' || cast(cast(o_orderdate AS DATE) AS VARCHAR)) AS listing_day_key, "
    "md5(cast(o_custkey AS VARCHAR) || '|' || CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END) AS nullable_key FROM orders",
)


def _money_texts(spark, d):
    l = _t(spark, d, "lineitem")
    m = F.col("l_linenumber") % 3
    dec = F.col("l_extendedprice").cast("decimal(14,2)").cast("string")
    txt = (
        F.when(m == 0, F.concat(F.lit("$"), dec, F.lit(" USD")))
        .when(m == 1, F.concat(F.lit("-$"), dec))
        .otherwise(F.concat(dec, F.lit(".5")))
    )
    return l.select("l_orderkey", "l_linenumber", txt.alias("txt")).select(
        "l_orderkey", "l_linenumber", "txt", money("txt", 14, 2).alias("cost")
    )


register(
    "fn_money_parse",
    "l_orderkey i, l_linenumber i, txt s, cost d",
    _money_texts,
    """
SELECT l_orderkey, l_linenumber, txt, cast(try_cast(regexp_replace(txt, '[^0-9.]', '', 'g') AS DECIMAL(14,2)) AS DOUBLE) AS cost FROM (
  SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3
      WHEN 0 THEN '$' || cast(cast(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) || ' USD'
      WHEN 1 THEN '-$' || cast(cast(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR)
      ELSE cast(cast(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) || '.5' END AS txt
  FROM lineitem)
""",
)
register(
    "fn_split_array",
    "listing_snapshot_id s, amenities a, amenity_count i",
    lambda spark, d: P(spark, d).stg_listing_snapshots.select(
        "listing_snapshot_id", "amenities", F.size("amenities").alias("amenity_count")
    ),
    compose(
        "SELECT listing_snapshot_id, to_json(amenities) AS amenities, cast(len(amenities) AS BIGINT) AS amenity_count FROM stg_listing_snapshots",
        "stg_listing_snapshots",
    ),
)
register(
    "fn_bool_parse",
    "s_suppkey i, txt s, flag b",
    lambda spark, d: _t(spark, d, "supplier")
    .select(
        "s_suppkey",
        F.element_at(F.array(F.lit(None).cast("string"), F.lit("TRUE"), F.lit("false"), F.lit("True ")), (F.col("s_suppkey") % 4 + 1).cast("int")).alias("txt"),
    )
    .select("s_suppkey", "txt", parse_bool("txt").alias("flag")),
    "SELECT s_suppkey, txt, lower(txt) = 'true' AS flag FROM (SELECT s_suppkey, [NULL, 'TRUE', 'false', 'True '][s_suppkey % 4 + 1] AS txt FROM supplier)",
)
CODES = ["M", "Q", "Bk", "Bx", "SI", "Zz"]
register(
    "fn_code_decode",
    "s_suppkey i, code s, borough s",
    lambda spark, d: _t(spark, d, "supplier")
    .select("s_suppkey", F.element_at(F.array(*[F.lit(c) for c in CODES]), (F.col("s_suppkey") % 6 + 1).cast("int")).alias("code"))
    .select("s_suppkey", "code", decode("code", STATION_BOROUGHS).alias("borough")),
    "SELECT s_suppkey, code, CASE code "
    + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in STATION_BOROUGHS.items())
    + " ELSE code END AS borough FROM (SELECT s_suppkey, ["
    + ", ".join(q(c) for c in CODES)
    + "][s_suppkey % 6 + 1] AS code FROM supplier)",
)
register_fragment(
    "fn_banding",
    "zip_month_signal_id s, six_month_rent_volatility r, rent_volatility_band s",
    lambda spark, d: P(spark, d).fct_rent_trends,
    "fct_rent_trends",
)
register_fragment(
    "fn_signal_score",
    "neighborhood_scorecard_id s, rent_volatility_band s, permit_count i, recruiter_demo_signal_score i",
    lambda spark, d: P(spark, d, materialize=SHARED_MODELS).mart_neighborhood_scorecard,
    "mart_neighborhood_scorecard",
)
register_fragment(
    "fn_days_between",
    "listing_snapshot_id s, snapshot_date t, days_on_market i",
    lambda spark, d: P(spark, d).fct_listing_history,
    "fct_listing_history",
)
register(
    "check_numeric_quality",
    "invalid_listing_rent_count i",
    lambda spark, d: quality.unparseable(P(spark, d).raw, "listing_snapshots", "rent", "double", "invalid_listing_rent_count"),
    compose(
        "SELECT count(*) FILTER (WHERE try_cast(payload['rent'] AS DOUBLE) IS NULL) AS invalid_listing_rent_count "
        "FROM raw_records WHERE dataset_name = 'listing_snapshots'",
        "raw_records",
    ),
)

# ---------------------------------------------------------------------------
# data-quality checks

register(
    "check_record_counts",
    "dataset_name s, record_count i, latest_ingested_at t",
    lambda spark, d: quality.record_counts(P(spark, d).raw),
    compose(
        "SELECT dataset_name, count(*) AS record_count, cast(max(ingested_at) AS VARCHAR) AS latest_ingested_at FROM raw_records GROUP BY 1",
        "raw_records",
    ),
)
AS_OF = "2001-09-05 12:00:00"
register(
    "check_freshness",
    "max_loaded_at t, age_hours f, freshness_state s",
    lambda spark, d: quality.freshness(P(spark, d).raw, AS_OF, loaded_col="ingested_at"),
    compose(
        "SELECT cast(m AS VARCHAR) AS max_loaded_at, epoch_us(TIMESTAMP '" + AS_OF + "' - m) / 3600000000.0 AS age_hours, "
        "CASE WHEN m IS NULL THEN 'error' WHEN epoch_us(TIMESTAMP '" + AS_OF + "' - m) / 3600000000.0 > 72 THEN 'error' "
        "WHEN epoch_us(TIMESTAMP '" + AS_OF + "' - m) / 3600000000.0 > 36 THEN 'warn' ELSE 'pass' END AS freshness_state "
        "FROM (SELECT max(ingested_at) AS m FROM raw_records)",
        "raw_records",
    ),
)
NOT_NULL_COLS = ("housing_building_id", "postal_code", "borough", "neighborhood_code", "counted_rental_units")
register(
    "check_not_null",
    "column_name s, null_count i",
    lambda spark, d: quality.not_null(P(spark, d).stg_neighborhood_housing, NOT_NULL_COLS),
    compose(
        " UNION ALL ".join(
            f"SELECT {q(c)} AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM stg_neighborhood_housing"
            for c in NOT_NULL_COLS
        ),
        "stg_neighborhood_housing",
    ),
)
register(
    "check_unique",
    "value s, occurrences i",
    lambda spark, d: quality.unique(P(spark, d).stg_permits, "permit_id"),
    compose(
        "SELECT permit_id AS value, count(*) AS occurrences FROM stg_permits WHERE permit_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
        "stg_permits",
    ),
)
register(
    "check_relationships",
    "violation_count i",
    lambda spark, d: (
        lambda p: quality.relationships(p.fct_listing_history, "listing_id", p.dim_listings, "listing_id").agg(
            F.count(F.lit(1)).alias("violation_count")
        )
    )(P(spark, d)),
    compose(
        "SELECT count(*) AS violation_count FROM fct_listing_history h WHERE h.listing_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM dim_listings d WHERE d.listing_id = h.listing_id)",
        "fct_listing_history",
        "dim_listings",
    ),
)

fragment(
    "permits_without_housing",
    "SELECT * FROM stg_permits x WHERE neighborhood_code IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM stg_neighborhood_housing h WHERE h.neighborhood_code = x.neighborhood_code)",
    "stg_permits",
    "stg_neighborhood_housing",
)
# a parent that lacks keys of its children, row by row
register_fragment(
    "check_orphans",
    "permit_id s, neighborhood_code s",
    lambda spark, d: (lambda p: quality.relationships(p.stg_permits, "neighborhood_code", p.stg_neighborhood_housing, "neighborhood_code"))(P(spark, d)),
    "permits_without_housing",
)


def _data_tests_sql() -> str:
    parts = []
    for model, declared in quality.MODEL_TESTS.items():
        for c in declared.get("not_null", ()):
            parts.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'not_null' AS test, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {model}")
        for c in declared.get("unique", ()):
            parts.append(f"SELECT '{model}', '{c}', 'unique', count(*) FROM (SELECT {c} FROM {model} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        for c, parent, pk in declared.get("relationships", ()):
            parts.append(f"SELECT '{model}', '{c}', 'relationships', count(*) FROM {model} x WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = x.{c})")
    return " UNION ALL ".join(parts)


def _data_tests(spark, d):
    p = P(spark, d)
    return quality.data_tests({m: p.raw if m == "raw_records" else getattr(p, m) for m in quality.MODEL_TESTS})


register("data_tests", "model s, column_name s, test s, violations i", _data_tests, compose(_data_tests_sql(), *quality.MODEL_TESTS))
REPORT_CHECKS = (*quality.KNOWN_CHECKS, "create_raw_table")
_DUP_EXAMPLES = (
    "SELECT count(*) AS n, array_to_string(list_sort(list(dataset_name || ':' || record_hash || ':' || run_id)), ', ') AS ex "
    "FROM (SELECT dataset_name, record_hash, run_id FROM raw_records GROUP BY 1, 2, 3 HAVING count(*) > 1 ORDER BY 1, 2, 3 LIMIT 5)"
)
register(
    "quality_report",
    "check_name s, state s, detail s",
    lambda spark, d: quality.quality_report(P(spark, d).raw, bindings.REQUIRED_DATASETS, REPORT_CHECKS),
    compose(
        f"""
SELECT 'raw_record_counts' AS check_name,
       CASE WHEN n = 0 OR e <> '' THEN 'failed' ELSE 'passed' END AS state,
       CASE WHEN n = 0 THEN 'no raw records found' WHEN e <> '' THEN 'empty datasets ' || e ELSE 'passed' END AS detail
FROM (SELECT count(*) AS n, coalesce(array_to_string(list_sort(list(dataset_name) FILTER (WHERE c <= 0)), ', '), '') AS e
      FROM (SELECT dataset_name, count(*) AS c FROM raw_records GROUP BY 1))
UNION ALL
SELECT 'required_dataset_presence',
       CASE WHEN k < {len(bindings.REQUIRED_DATASETS)} THEN 'failed' ELSE 'passed' END,
       CASE WHEN k < {len(bindings.REQUIRED_DATASETS)} THEN 'loaded ' || cast(k AS VARCHAR) || ' of {len(bindings.REQUIRED_DATASETS)} required datasets' ELSE 'passed' END
FROM (SELECT count(DISTINCT dataset_name) AS k FROM raw_records WHERE dataset_name IN ({", ".join(q(n) for n in bindings.REQUIRED_DATASETS)}))
UNION ALL
SELECT 'duplicate_record_hashes', CASE WHEN n > 0 THEN 'failed' ELSE 'passed' END, CASE WHEN n > 0 THEN ex ELSE 'passed' END
FROM ({_DUP_EXAMPLES})
UNION ALL
SELECT 'listing_snapshot_price_quality', CASE WHEN c > 0 THEN 'failed' ELSE 'passed' END,
       CASE WHEN c > 0 THEN cast(c AS VARCHAR) || ' listing snapshots have invalid rent' ELSE 'passed' END
FROM (SELECT count(*) FILTER (WHERE try_cast(payload['rent'] AS DOUBLE) IS NULL) AS c FROM raw_records WHERE dataset_name = 'listing_snapshots')
UNION ALL
SELECT 'create_raw_table', 'not_applicable', ''
""",
        "raw_records",
    ),
)

