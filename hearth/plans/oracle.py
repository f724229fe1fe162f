"""DuckDB oracle: the same bindings and models written as plain SQL.

Each fragment is one named CTE with the fragments it reads; ``compose``
emits ``WITH ... SELECT`` with exactly the fragments a query needs, in
dependency order.  The tables ``region nation customer supplier part orders
lineitem events`` are views the checker registers.
"""

from __future__ import annotations

from collections.abc import Sequence

from hearth.plans.bindings import (
    BOROUGH_BY_REGION,
    BOROUGH_CODE_BY_REGION,
    HOUSING,
    HOUSING_INGESTED_AT,
    INVENTORY,
    LISTINGS,
    PERMITS,
    RENT,
    STATIONS,
    STATIONS_INGESTED_AT,
    WIDE_INGESTED_AT,
)

FRAGMENTS: dict[str, tuple[str, tuple[str, ...]]] = {}


def fragment(name: str, sql: str, *deps: str) -> None:
    FRAGMENTS[name] = (sql.strip(), tuple(deps))


def compose(final_sql: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in FRAGMENTS[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final_sql.strip()
    ctes = ",\n".join(f"{n} AS (\n{FRAGMENTS[n][0]}\n)" for n in order)
    return f"WITH {ctes}\n{final_sql.strip()}"


# ---------------------------------------------------------------------------
# scalar helpers (SQL text builders)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_map(expr: str, mapping: dict, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {k!r} THEN {q(v)}" if isinstance(k, str) else f"WHEN {k} THEN {q(v)}" for k, v in mapping.items())
    tail = f" ELSE {q(default)}" if default is not None else ""
    return f"CASE {expr} {whens}{tail} END".replace("WHEN '", "WHEN '")


def try_date(s: str) -> str:
    t = f"trim({s})"
    return (
        f"CASE WHEN regexp_full_match({t}, '\\d{{4}}-\\d{{2}}-\\d{{2}}([T ].*)?') "
        f"THEN cast(try_strptime(substr({t}, 1, 10), '%Y-%m-%d') AS DATE) "
        f"WHEN regexp_full_match({t}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') "
        f"THEN cast(try_strptime({t}, '%m/%d/%Y') AS DATE) END"
    )


def try_dec(s: str, p: int, sc: int) -> str:
    return f"try_cast({s} AS DECIMAL({p},{sc}))"


def try_num(s: str) -> str:
    return f"try_cast({s} AS DECIMAL(38,0))"


def key(*parts: str) -> str:
    return "md5(" + " || '|' || ".join(f"cast({p} AS VARCHAR)" for p in parts) + ")"


def pl(k: str) -> str:
    return f"payload[{q(k)}]"


def payload(entries: Sequence[tuple[str, str]]) -> str:
    body = ",\n    ".join(f"({q(k)}, cast({v} AS VARCHAR))" for k, v in entries)
    return f"map_from_entries([\n    {body}\n  ])"


def key_part(k: str) -> str:
    cands = [k]
    for alt in (k.lower(), k.replace(" ", "_")):
        if alt not in cands:
            cands.append(alt)
    return "coalesce(" + ", ".join(pl(c) for c in cands) + ", '')"


def record_hash_sql(name: str, dtype: str, url: str, rid: str, pay: str = "payload") -> str:
    return (
        f"sha256(to_json({{'dataset_name': {name}, 'dataset_type': {dtype}, "
        f"'payload': map_from_entries(list_sort(map_entries({pay}))), 'source_row_id': {rid}, 'source_url': {url}}}))"
    )


def envelope(src: str, spec, run: str, ts: str) -> str:
    """Raw-record envelope over a CTE with a ``payload`` column."""
    rid = "concat_ws('|', " + ", ".join(key_part(k) for k in spec.primary_key) + ")"
    name, dtype, url = q(spec.name), q(spec.dataset_type), q(spec.url)
    return f"""
SELECT {name} AS dataset_name, {dtype} AS dataset_type, {url} AS source_url, rid AS source_row_id,
       {record_hash_sql(name, dtype, url, 'rid')} AS record_hash,
       cast({ts} AS TIMESTAMP) AS extracted_at, cast({ts} AS TIMESTAMP) AS ingested_at,
       cast({run} AS VARCHAR) AS run_id, cast(NULL AS VARCHAR) AS original_s3_key, payload
FROM (SELECT *, {rid} AS rid FROM {src})
"""


# ---------------------------------------------------------------------------
# bindings

_BOROUGH = case_map("n.n_regionkey", BOROUGH_BY_REGION)
_BOROUGH_CODE = case_map("n.n_regionkey", BOROUGH_CODE_BY_REGION)

fragment(
    "listings_src",
    f"""
SELECT {payload([
    ("listing_id", "o.o_custkey"),
    ("snapshot_date", "cast(o.o_orderdate AS DATE)"),
    ("address", "c.c_name"),
    ("postal_code", "c.c_nationkey"),
    ("neighborhood", "c.c_mktsegment"),
    ("borough", _BOROUGH),
    ("rent", "CASE WHEN o.o_orderkey % 101 = 0 THEN 'call for price' ELSE cast(cast(o.o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END"),
    ("bedrooms", "o.o_custkey % 4"),
    ("bathrooms", "CASE WHEN o.o_custkey % 3 = 0 THEN '1.5' ELSE '1' END"),
    ("sqft", "o.o_custkey % 25 * 40 + 400"),
    ("property_type", "CASE WHEN o.o_custkey % 4 = 0 THEN 'Studio' ELSE 'Apartment' END"),
    ("amenities", "CASE WHEN starts_with(o.o_orderpriority, '5') THEN '' ELSE replace(lower(o.o_orderpriority), '-', '|') END"),
    ("status", "CASE o.o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'leased' WHEN 'P' THEN 'pending' ELSE 'pending' END"),
    ("listed_date", "cast(date_trunc('month', cast(o.o_orderdate AS DATE)) AS DATE)"),
    ("latitude", "'40.' || lpad(cast(o.o_custkey % 100000 AS VARCHAR), 5, '0')"),
    ("longitude", "'-73.9' || cast(c.c_nationkey AS VARCHAR)"),
])} AS payload,
  o.o_orderdate AS ingested_at,
  'run-' || cast(year(o.o_orderdate) AS VARCHAR) AS run_id
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
""",
)
fragment("listings_raw", envelope("listings_src", LISTINGS, "run_id", "ingested_at"), "listings_src")


def _wide(monthly: str, region: str) -> str:
    attrs = payload([
        ("RegionID", f"{region} + 10000"),
        ("SizeRank", f"{region} + 1"),
        ("RegionName", region),
        ("RegionType", "'zip'"),
        ("StateName", "'NY'"),
    ])
    return f"""
SELECT map_concat({attrs}, map_from_entries(list({{'k': month_key, 'v': val}}))) AS payload
FROM {monthly} GROUP BY {region}
"""


fragment(
    "rent_monthly",
    """
SELECT c.c_nationkey AS region,
       cast(cast(date_trunc('month', cast(o.o_orderdate AS DATE)) AS DATE) AS VARCHAR) AS month_key,
       cast(cast(max(o.o_totalprice) AS DECIMAL(12,2)) AS VARCHAR) AS val
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY 1, 2
""",
)
fragment("rent_wide_src", _wide("rent_monthly", "region"), "rent_monthly")
fragment("rent_wide_raw", envelope("rent_wide_src", RENT, "'run-wide'", q(WIDE_INGESTED_AT)), "rent_wide_src")

fragment(
    "inventory_monthly",
    """
SELECT s.s_nationkey AS region,
       cast(cast(date_trunc('month', cast(l.l_shipdate AS DATE)) AS DATE) AS VARCHAR) AS month_key,
       cast(count(*) AS VARCHAR) AS val
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY 1, 2
""",
)
fragment("inventory_wide_src", _wide("inventory_monthly", "region"), "inventory_monthly")
fragment(
    "inventory_wide_raw", envelope("inventory_wide_src", INVENTORY, "'run-wide'", q(WIDE_INGESTED_AT)), "inventory_wide_src"
)

fragment(
    "stations_src",
    f"""
SELECT {payload([
    ("Complex ID", "s.s_suppkey"),
    ("Is Complex", "CASE WHEN s.s_suppkey % 2 = 0 THEN 'True' ELSE 'false' END"),
    ("Number Of Stations In Complex", "CASE WHEN s.s_suppkey % 7 = 0 THEN '' ELSE cast(s.s_suppkey % 4 + 1 AS VARCHAR) END"),
    ("Stop Name", "s.s_name"),
    ("Display Name", "s.s_name"),
    ("Borough", _BOROUGH_CODE),
    ("CBD", "CASE WHEN s.s_acctbal > 0 THEN 'TRUE' ELSE 'false' END"),
    ("Daytime Routes", "'A C'"),
    ("Structure Type", "'Subway'"),
    ("Latitude", "'40.7' || cast(s.s_suppkey % 1000 AS VARCHAR)"),
    ("Longitude", "'-73.9' || cast(s.s_suppkey % 1000 AS VARCHAR)"),
    ("ADA", "s.s_suppkey % 3"),
    ("ADA Notes", "''"),
])} AS payload
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
""",
)
fragment("stations_raw", envelope("stations_src", STATIONS, "'run-stations'", q(STATIONS_INGESTED_AT)), "stations_src")

fragment(
    "housing_src",
    f"""
SELECT {payload([
    ("project_id", "p_brand"),
    ("project_name", "p_name"),
    ("project_start_date", "DATE '2015-01-01' + cast(p_partkey % 365 AS INTEGER)"),
    ("project_completion_date", "CASE WHEN p_partkey % 3 = 0 THEN '' ELSE cast(DATE '2018-01-01' + cast(p_partkey % 700 AS INTEGER) AS VARCHAR) END"),
    ("building_id", "p_partkey"),
    ("house_number", "p_partkey % 300 + 1"),
    ("street_name", "p_name"),
    ("borough", "'B' || cast(p_partkey % 2 AS VARCHAR)"),
    ("postcode", "CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE cast(p_partkey % 25 AS VARCHAR) END"),
    ("bbl", "p_partkey + 1000000000"),
    ("bin", "p_partkey + 2000000"),
    ("community_board", "p_partkey % 12 + 1"),
    ("neighborhood_tabulation_area", "CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE p_type END"),
    ("latitude", "'40.6' || cast(p_partkey % 1000 AS VARCHAR)"),
    ("longitude", "'-73.8' || cast(p_partkey % 1000 AS VARCHAR)"),
    ("reporting_construction_type", "CASE WHEN p_partkey % 2 = 0 THEN 'New Construction' ELSE 'Preservation' END"),
    ("extended_affordability_status", "'No'"),
    ("counted_rental_units", "CASE WHEN p_size % 9 = 0 THEN NULL ELSE cast(p_size AS VARCHAR) END"),
    ("all_counted_units", "p_size"),
    ("total_units", "p_size"),
])} AS payload
FROM part
""",
)
fragment("housing_raw", envelope("housing_src", HOUSING, "'run-housing'", q(HOUSING_INGESTED_AT)), "housing_src")

fragment(
    "permits_src",
    f"""
SELECT {payload([
    ("job_filing_number", "l.l_orderkey"),
    ("work_permit", "l.l_linenumber"),
    ("sequence_number", "l.l_partkey"),
    ("filing_reason", "l.l_returnflag"),
    ("house_no", "l.l_suppkey"),
    ("street_name", "s.s_name"),
    ("borough", "'B' || cast(s.s_nationkey % 5 AS VARCHAR)"),
    ("zip_code", "s.s_nationkey"),
    ("community_board", "s.s_nationkey % 12 + 1"),
    ("census_tract", "l.l_partkey % 500"),
    ("nta", "CASE WHEN p.p_type = 'ECONOMY' THEN '' ELSE p.p_type END"),
    ("work_type", "l.l_linestatus"),
    ("approved_date", "cast(l.l_shipdate AS DATE) - 30"),
    ("issued_date", "cast(cast(l.l_shipdate AS DATE) AS VARCHAR) || 'T00:00:00.000'"),
    ("expired_date", "''"),
    ("job_description", "'alteration'"),
    ("estimated_job_costs", "'$' || cast(cast(l.l_extendedprice AS DECIMAL(14,2)) AS VARCHAR)"),
    ("permit_status", "'Issued'"),
    ("latitude", "'40.5' || cast(l.l_suppkey % 1000 AS VARCHAR)"),
    ("longitude", "'-74.0' || cast(l.l_suppkey % 1000 AS VARCHAR)"),
])} AS payload,
  cast(cast(l.l_shipdate AS DATE) AS TIMESTAMP) AS ingested_at,
  'run-' || cast(year(l.l_shipdate) AS VARCHAR) AS run_id
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey
""",
)
fragment("permits_raw", envelope("permits_src", PERMITS, "run_id", "ingested_at"), "permits_src")

fragment(
    "raw_records",
    """
SELECT * FROM rent_wide_raw UNION ALL SELECT * FROM inventory_wide_raw UNION ALL SELECT * FROM housing_raw
UNION ALL SELECT * FROM permits_raw UNION ALL SELECT * FROM stations_raw UNION ALL SELECT * FROM listings_raw
""",
    "rent_wide_raw", "inventory_wide_raw", "housing_raw", "permits_raw", "stations_raw", "listings_raw",
)

# ---------------------------------------------------------------------------
# staging


def _wide_stage(raw: str, month_col: str, value_col: str, value_cast: str, id_col: str) -> str:
    return f"""
SELECT {key('region_id', month_col)} AS {id_col}, * FROM (
  SELECT {pl('RegionID')} AS region_id, {try_num(pl('SizeRank'))} AS size_rank, {pl('RegionName')} AS postal_code,
         {pl('RegionType')} AS region_type, {pl('StateName')} AS state_name,
         {try_date("e['key']")} AS {month_col}, {value_cast.format("e['value']")} AS {value_col}, ingested_at, run_id
  FROM (SELECT *, unnest(map_entries(payload)) AS e FROM {raw})
  WHERE regexp_full_match(e['key'], '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
) WHERE {value_col} IS NOT NULL
"""


fragment("stg_rent_prices", _wide_stage("rent_wide_raw", "rent_month", "zori_rent", "try_cast({} AS DECIMAL(12,2))", "rent_price_id"), "rent_wide_raw")
fragment(
    "stg_inventory",
    _wide_stage("inventory_wide_raw", "inventory_month", "active_inventory", "try_cast({} AS DECIMAL(38,0))", "inventory_id"),
    "inventory_wide_raw",
)

fragment(
    "stg_listing_snapshots",
    f"""
SELECT md5(source_row_id || '|' || coalesce(record_hash, '')) AS listing_snapshot_id,
       {pl('listing_id')} AS listing_id,
       {try_date(pl('snapshot_date'))} AS snapshot_date,
       {pl('address')} AS address,
       {pl('postal_code')} AS postal_code,
       {pl('neighborhood')} AS neighborhood,
       {pl('borough')} AS borough,
       {try_dec(pl('rent'), 12, 2)} AS rent,
       {try_num(pl('bedrooms'))} AS bedrooms,
       {try_dec(pl('bathrooms'), 8, 2)} AS bathrooms,
       {try_num(pl('sqft'))} AS sqft,
       {pl('property_type')} AS property_type,
       string_split(coalesce({pl('amenities')}, ''), '|') AS amenities,
       {pl('status')} AS listing_status,
       {try_date(pl('listed_date'))} AS listed_date,
       {try_dec(pl('latitude'), 12, 8)} AS latitude,
       {try_dec(pl('longitude'), 12, 8)} AS longitude,
       ingested_at, run_id
FROM listings_raw
WHERE dataset_name = 'listing_snapshots' AND {pl('listing_id')} IS NOT NULL
""",
    "listings_raw",
)

fragment(
    "stg_permits",
    f"""
SELECT md5(coalesce({pl('job_filing_number')}, '') || '|' || coalesce({pl('work_permit')}, '') || '|' || coalesce({pl('sequence_number')}, '')) AS permit_id,
       {pl('job_filing_number')} AS job_filing_number, {pl('work_permit')} AS work_permit,
       {pl('sequence_number')} AS sequence_number, {pl('filing_reason')} AS filing_reason,
       {pl('house_no')} AS house_number, {pl('street_name')} AS street_name, {pl('borough')} AS borough,
       {pl('zip_code')} AS postal_code, {pl('community_board')} AS community_board,
       {pl('census_tract')} AS census_tract, {pl('nta')} AS neighborhood_code, {pl('work_type')} AS work_type,
       {try_date(pl('approved_date'))} AS approved_date, {try_date(pl('issued_date'))} AS issued_date,
       {try_date(pl('expired_date'))} AS expired_date, {pl('job_description')} AS job_description,
       {try_dec("regexp_replace(" + pl('estimated_job_costs') + ", '[^0-9.]', '', 'g')", 14, 2)} AS estimated_job_cost,
       {pl('permit_status')} AS permit_status,
       {try_dec(pl('latitude'), 12, 8)} AS latitude, {try_dec(pl('longitude'), 12, 8)} AS longitude,
       ingested_at, run_id
FROM permits_raw
WHERE dataset_name = 'nyc_dob_approved_permits' AND {pl('job_filing_number')} IS NOT NULL
""",
    "permits_raw",
)

fragment(
    "stg_neighborhood_housing",
    f"""
SELECT md5(coalesce({pl('project_id')}, '') || '|' || coalesce({pl('building_id')}, '')) AS housing_building_id,
       {pl('project_id')} AS project_id, {pl('project_name')} AS project_name,
       {try_date(pl('project_start_date'))} AS project_start_date,
       {try_date(pl('project_completion_date'))} AS project_completion_date,
       {pl('building_id')} AS building_id, {pl('house_number')} AS house_number, {pl('street_name')} AS street_name,
       {pl('borough')} AS borough, {pl('postcode')} AS postal_code, {pl('bbl')} AS bbl, {pl('bin')} AS bin,
       {pl('community_board')} AS community_board, {pl('neighborhood_tabulation_area')} AS neighborhood_code,
       {try_dec(pl('latitude'), 12, 8)} AS latitude, {try_dec(pl('longitude'), 12, 8)} AS longitude,
       {pl('reporting_construction_type')} AS construction_type,
       {pl('extended_affordability_status')} AS extended_affordability_status,
       {try_num(pl('counted_rental_units'))} AS counted_rental_units,
       {try_num(pl('all_counted_units'))} AS all_counted_units,
       {try_num(pl('total_units'))} AS total_units,
       ingested_at, run_id
FROM housing_raw
WHERE dataset_name = 'nyc_housing_units_by_building' AND {pl('project_id')} IS NOT NULL
""",
    "housing_raw",
)

_STATION_BOROUGHS = "CASE {b} WHEN 'M' THEN 'Manhattan' WHEN 'Q' THEN 'Queens' WHEN 'Bk' THEN 'Brooklyn' WHEN 'Bx' THEN 'Bronx' WHEN 'SI' THEN 'Staten Island' ELSE {b} END".format(
    b=pl("Borough")
)

fragment(
    "stg_transit_access",
    f"""
SELECT {pl('Complex ID')} AS station_complex_id,
       lower({pl('Is Complex')}) = 'true' AS is_complex,
       {try_num(pl('Number Of Stations In Complex'))} AS station_count,
       {pl('Stop Name')} AS stop_name, {pl('Display Name')} AS display_name,
       {pl('Borough')} AS borough_code, {_STATION_BOROUGHS} AS borough,
       lower({pl('CBD')}) = 'true' AS in_cbd,
       {pl('Daytime Routes')} AS daytime_routes, {pl('Structure Type')} AS structure_type,
       {try_dec(pl('Latitude'), 12, 8)} AS latitude, {try_dec(pl('Longitude'), 12, 8)} AS longitude,
       {try_num(pl('ADA'))} AS ada_score, {pl('ADA Notes')} AS ada_notes,
       ingested_at, run_id
FROM stations_raw
WHERE dataset_name = 'mta_subway_stations' AND {pl('Complex ID')} IS NOT NULL
""",
    "stations_raw",
)

# ---------------------------------------------------------------------------
# intermediate

fragment(
    "zip_month_joined",
    """
SELECT coalesce(r.postal_code, i.postal_code) AS postal_code,
       coalesce(r.state_name, i.state_name) AS state_name,
       coalesce(r.rent_month, i.inventory_month) AS signal_month,
       r.zori_rent, i.active_inventory
FROM stg_rent_prices r FULL OUTER JOIN stg_inventory i
  ON r.postal_code = i.postal_code AND r.rent_month = i.inventory_month
""",
    "stg_rent_prices", "stg_inventory",
)

_W = "OVER (PARTITION BY postal_code ORDER BY signal_month ASC NULLS LAST"
fragment(
    "int_zip_month_market_signals",
    f"""
SELECT md5(postal_code || '|' || cast(signal_month AS VARCHAR)) AS zip_month_signal_id,
       postal_code, state_name, signal_month, zori_rent, active_inventory,
       zori_rent - lag(zori_rent) {_W}) AS rent_mom_delta,
       cast(zori_rent AS DOUBLE) / nullif(cast(lag(zori_rent, 12) {_W}) AS DOUBLE), 0.0) - 1.0 AS rent_yoy_pct,
       active_inventory - lag(active_inventory) {_W}) AS inventory_mom_delta,
       stddev_samp(cast(zori_rent AS DOUBLE)) {_W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS six_month_rent_volatility
FROM zip_month_joined
WHERE postal_code IS NOT NULL AND signal_month IS NOT NULL
""",
    "zip_month_joined",
)

fragment(
    "housing_by_area",
    """
SELECT borough, postal_code, neighborhood_code,
       count(DISTINCT housing_building_id) AS housing_projects,
       sum(coalesce(counted_rental_units, 0)) AS affordable_rental_units,
       sum(coalesce(total_units, 0)) AS total_housing_units
FROM stg_neighborhood_housing GROUP BY 1, 2, 3
""",
    "stg_neighborhood_housing",
)
fragment(
    "permits_by_area",
    """
SELECT borough, postal_code, neighborhood_code,
       count(DISTINCT permit_id) AS permit_count,
       sum(coalesce(estimated_job_cost, 0)) AS estimated_development_cost,
       max(issued_date) AS latest_permit_issued_date
FROM stg_permits GROUP BY 1, 2, 3
""",
    "stg_permits",
)
fragment(
    "int_neighborhood_development_signals",
    """
SELECT md5(coalesce(h.postal_code, p.postal_code, '') || '|' || coalesce(h.neighborhood_code, p.neighborhood_code, '')) AS development_signal_id,
       coalesce(h.borough, p.borough) AS borough,
       coalesce(h.postal_code, p.postal_code) AS postal_code,
       coalesce(h.neighborhood_code, p.neighborhood_code) AS neighborhood_code,
       coalesce(h.housing_projects, 0) AS housing_projects,
       coalesce(h.affordable_rental_units, 0) AS affordable_rental_units,
       coalesce(h.total_housing_units, 0) AS total_housing_units,
       coalesce(p.permit_count, 0) AS permit_count,
       coalesce(p.estimated_development_cost, 0) AS estimated_development_cost,
       p.latest_permit_issued_date
FROM housing_by_area h FULL OUTER JOIN permits_by_area p
  ON h.postal_code = p.postal_code AND coalesce(h.neighborhood_code, '') = coalesce(p.neighborhood_code, '')
""",
    "housing_by_area", "permits_by_area",
)
fragment(
    "int_transit_access_by_borough",
    """
SELECT borough,
       count(DISTINCT station_complex_id) AS station_complex_count,
       sum(coalesce(station_count, 1)) AS station_count,
       sum(CASE WHEN ada_score > 0 THEN 1 ELSE 0 END) AS ada_station_complex_count,
       count(*) FILTER (WHERE in_cbd) AS cbd_station_complex_count
FROM stg_transit_access GROUP BY 1
""",
    "stg_transit_access",
)

# ---------------------------------------------------------------------------
# marts

fragment(
    "dim_listings",
    """
SELECT listing_id, address, postal_code, neighborhood, borough, bedrooms, bathrooms, sqft, property_type,
       amenities, listed_date, latitude, longitude, listing_status AS current_status, rent AS current_rent,
       snapshot_date AS latest_snapshot_date
FROM (
  SELECT *, row_number() OVER (PARTITION BY listing_id
         ORDER BY snapshot_date DESC NULLS FIRST, ingested_at DESC NULLS FIRST, listing_snapshot_id ASC NULLS LAST) AS rn
  FROM stg_listing_snapshots
) WHERE rn = 1
""",
    "stg_listing_snapshots",
)
fragment(
    "development_by_zip",
    """
SELECT postal_code, min(neighborhood_code) AS neighborhood_code, min(borough) AS borough,
       sum(housing_projects) AS housing_projects, sum(affordable_rental_units) AS affordable_rental_units,
       sum(permit_count) AS permit_count
FROM int_neighborhood_development_signals GROUP BY 1
""",
    "int_neighborhood_development_signals",
)
fragment(
    "dim_neighborhoods",
    """
SELECT md5(coalesce(l.postal_code, d.postal_code, '') || '|' || coalesce(l.neighborhood, d.neighborhood_code, 'unknown')) AS neighborhood_id,
       coalesce(l.postal_code, d.postal_code) AS postal_code,
       coalesce(l.neighborhood, d.neighborhood_code, 'Unknown') AS neighborhood,
       coalesce(l.borough, d.borough) AS borough,
       d.neighborhood_code,
       coalesce(d.housing_projects, 0) AS housing_projects,
       coalesce(d.affordable_rental_units, 0) AS affordable_rental_units,
       coalesce(d.permit_count, 0) AS permit_count
FROM (SELECT DISTINCT postal_code, neighborhood, borough FROM stg_listing_snapshots WHERE postal_code IS NOT NULL) l
FULL OUTER JOIN development_by_zip d ON l.postal_code = d.postal_code
""",
    "stg_listing_snapshots", "development_by_zip",
)
fragment(
    "fct_listing_history",
    """
SELECT listing_snapshot_id, listing_id, snapshot_date, postal_code, neighborhood, borough, rent, bedrooms,
       bathrooms, sqft, property_type, listing_status,
       date_diff('day', listed_date, snapshot_date) AS days_on_market,
       rent - prev_rent AS rent_change_amount,
       cast(rent AS DOUBLE) / nullif(cast(prev_rent AS DOUBLE), 0.0) - 1.0 AS rent_change_pct,
       ingested_at, run_id
FROM (
  SELECT *, lag(rent) OVER (PARTITION BY listing_id ORDER BY snapshot_date ASC NULLS LAST, listing_snapshot_id ASC NULLS LAST) AS prev_rent
  FROM stg_listing_snapshots WHERE listing_id IS NOT NULL
)
""",
    "stg_listing_snapshots",
)
_VOL = "abs(coalesce(six_month_rent_volatility, 0.0))"
fragment(
    "fct_rent_trends",
    f"""
SELECT zip_month_signal_id, postal_code, state_name, signal_month, zori_rent, active_inventory, rent_mom_delta,
       rent_yoy_pct, inventory_mom_delta, six_month_rent_volatility,
       CASE WHEN {_VOL} >= 150 THEN 'high volatility' WHEN {_VOL} >= 75 THEN 'moderate volatility' ELSE 'stable' END AS rent_volatility_band
FROM int_zip_month_market_signals
""",
    "int_zip_month_market_signals",
)
fragment(
    "mart_affordability",
    """
SELECT md5(postal_code || '|' || cast(signal_month AS VARCHAR)) AS affordability_id, postal_code, signal_month, zori_rent,
       zori_rent * 12 AS annual_rent, cast(zori_rent * 12 AS DOUBLE) / 0.30 AS income_needed_at_30_pct,
       rent_yoy_pct, rent_volatility_band
FROM fct_rent_trends WHERE zori_rent IS NOT NULL
""",
    "fct_rent_trends",
)
fragment(
    "mart_development_activity",
    """
SELECT development_signal_id AS development_activity_id, borough, postal_code, neighborhood_code, housing_projects,
       affordable_rental_units, total_housing_units, permit_count, estimated_development_cost, latest_permit_issued_date,
       CASE WHEN permit_count >= 100 OR estimated_development_cost >= 100000000 THEN 'high development'
            WHEN permit_count >= 25 OR estimated_development_cost >= 25000000 THEN 'moderate development'
            ELSE 'low development' END AS development_activity_band
FROM int_neighborhood_development_signals
""",
    "int_neighborhood_development_signals",
)
fragment(
    "inventory_daily",
    """
SELECT postal_code, neighborhood, borough, snapshot_date,
       count(DISTINCT listing_id) AS listing_count,
       count(*) FILTER (WHERE listing_status = 'active') AS active_listing_count,
       count(*) FILTER (WHERE listing_status = 'leased') AS leased_listing_count,
       cast(sum(cast(rent * 100 AS BIGINT)) AS DOUBLE) / cast(count(rent) AS DOUBLE) / 100.0 AS avg_listing_rent,
       median(cast(rent AS DOUBLE)) AS median_listing_rent,
       avg(cast(days_on_market AS DOUBLE)) AS avg_days_on_market,
       count(*) FILTER (WHERE rent_change_amount <> 0) AS listings_with_price_changes
FROM fct_listing_history GROUP BY 1, 2, 3, 4
""",
    "fct_listing_history",
)
fragment(
    "mart_inventory_churn",
    """
SELECT md5(postal_code || '|' || cast(snapshot_date AS VARCHAR)) AS inventory_churn_id,
       postal_code, neighborhood, borough, snapshot_date, listing_count, active_listing_count, leased_listing_count,
       avg_listing_rent, median_listing_rent, avg_days_on_market, listings_with_price_changes,
       listing_count - lag(listing_count) OVER (PARTITION BY postal_code
            ORDER BY snapshot_date ASC NULLS LAST, neighborhood ASC NULLS LAST, borough ASC NULLS LAST) AS listing_count_delta
FROM inventory_daily
""",
    "inventory_daily",
)
fragment(
    "listing_borough_rents",
    """
SELECT borough, snapshot_date, cast(sum(cast(rent * 100 AS BIGINT)) AS DOUBLE) / cast(count(rent) AS DOUBLE) / 100.0 AS avg_listing_rent,
       median(cast(rent AS DOUBLE)) AS median_listing_rent, count(DISTINCT listing_id) AS listing_count
FROM stg_listing_snapshots GROUP BY 1, 2
""",
    "stg_listing_snapshots",
)
fragment(
    "mart_transit_price_effect",
    """
SELECT md5(r.borough || '|' || cast(r.snapshot_date AS VARCHAR)) AS transit_price_effect_id,
       r.borough, r.snapshot_date, r.avg_listing_rent, r.median_listing_rent, r.listing_count,
       t.station_complex_count, t.station_count, t.ada_station_complex_count, t.cbd_station_complex_count,
       r.avg_listing_rent / nullif(cast(t.station_complex_count AS DOUBLE), 0.0) AS rent_per_station_complex
FROM listing_borough_rents r LEFT JOIN int_transit_access_by_borough t ON r.borough = t.borough
""",
    "listing_borough_rents", "int_transit_access_by_borough",
)
fragment(
    "latest_rent",
    """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY postal_code ORDER BY signal_month DESC NULLS FIRST) AS rn FROM fct_rent_trends
) WHERE rn = 1
""",
    "fct_rent_trends",
)
fragment(
    "latest_churn",
    """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY postal_code
         ORDER BY snapshot_date DESC NULLS FIRST, neighborhood ASC NULLS LAST, borough ASC NULLS LAST) AS rn
  FROM mart_inventory_churn
) WHERE rn = 1
""",
    "mart_inventory_churn",
)
fragment(
    "mart_neighborhood_scorecard",
    """
SELECT md5(n.neighborhood_id || '|' || coalesce(cast(r.signal_month AS VARCHAR), 'no-rent')) AS neighborhood_scorecard_id,
       n.neighborhood_id, n.postal_code, n.neighborhood, n.borough,
       r.signal_month AS latest_rent_month, r.zori_rent, r.rent_yoy_pct, r.six_month_rent_volatility,
       r.rent_volatility_band, r.active_inventory,
       c.listing_count, c.active_listing_count, c.leased_listing_count, c.avg_days_on_market,
       n.housing_projects, n.affordable_rental_units, n.permit_count,
       d.estimated_development_cost, d.development_activity_band,
       CASE WHEN r.rent_volatility_band = 'high volatility' THEN 3
            WHEN r.rent_volatility_band = 'moderate volatility' THEN 2 ELSE 1 END
       + CASE WHEN coalesce(d.permit_count, n.permit_count, 0) >= 50 THEN 2
              WHEN coalesce(d.permit_count, n.permit_count, 0) >= 10 THEN 1 ELSE 0 END AS recruiter_demo_signal_score
FROM dim_neighborhoods n
LEFT JOIN latest_rent r ON n.postal_code = r.postal_code
LEFT JOIN latest_churn c ON n.postal_code = c.postal_code
LEFT JOIN mart_development_activity d ON n.postal_code = d.postal_code
""",
    "dim_neighborhoods", "latest_rent", "latest_churn", "mart_development_activity",
)


# ---------------------------------------------------------------------------
# presentation: same rendering as ``plans.present.checkable``


def present(source: str, columns: str) -> str:
    """``columns``: ``"name kind, ..."`` with kind s (text), d (decimal -> double),
    t (date/timestamp -> text), i (integer -> bigint), f (double), b (boolean),
    a (array -> JSON text)."""
    out = []
    for item in columns.split(","):
        name, kind = item.split()
        if kind == "d":
            out.append(f"cast({name} AS DOUBLE) AS {name}")
        elif kind == "t":
            out.append(f"cast({name} AS VARCHAR) AS {name}")
        elif kind == "i":
            out.append(f"cast({name} AS BIGINT) AS {name}")
        elif kind == "f":
            out.append(f"cast({name} AS DOUBLE) AS {name}")
        elif kind == "a":
            out.append(f"to_json({name}) AS {name}")
        else:
            out.append(name)
    return f"SELECT {', '.join(out)} FROM {source}"
