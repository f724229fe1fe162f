"""Source, sink and stream keys.  Each writes data derived from whole test
tables into a fresh folder under the shared checkpoint folder
(``spark.checkpoint.dir``) and reads it back through the operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.plans import bindings, marts
from hearth.plans.oracle import compose
from hearth.plans.graph import SHARED_MODELS, ModelGraph
from hearth.plans.registry import MODEL_COLUMNS, register, register_fragment
from hearth.schemas import ENVELOPE_KEYS
from hearth.session import ensure_checkpoint_dir, frugal_writes, scratch_path
from hearth.sources.catalog import register_raw_table
from hearth.sources.files import read_csv_rows, read_json_rows, read_normalized
from hearth.sources.key_index import append_indexed, upsert_indexed
from hearth.sources.sinks import (
    EXTRACTS, LANDED_ROWS, TABLE_CODEC, append_audit, extract, materialize, remove_folder, truncate_reload, upsert_partitions, write_normalized,
)
from hearth.streaming.ingest import ingest_available, landed_stream, stream_insert_ignore


def _fresh(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, f"{label}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------------------
# CSV


def _csv_source(spark, d) -> DataFrame:
    s = bindings.table(spark, d, "supplier")
    return s.select(
        F.col("s_suppkey").cast("string").alias("s_suppkey"),
        F.concat(F.col("s_name"), F.lit(', "north"\nwing')).alias("s_name"),
        F.when(F.col("s_suppkey") % 5 == 0, F.lit(None)).otherwise(F.col("s_nationkey").cast("string")).alias("s_nationkey"),
        F.when(F.col("s_suppkey") % 7 == 0, F.lit(""))
        .otherwise(F.concat(F.lit(" "), F.col("s_acctbal").cast("string"), F.lit(" ")))
        .alias("s_acctbal"),
    )


def _scan_csv(spark, d):
    path = _fresh(spark, "csv")
    (
        _csv_source(spark, d)
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return read_csv_rows(spark, path)


def _scan_csv_split(spark, d):
    """The same rows in one file, whose splits are read by as many tasks."""
    path = _fresh(spark, "csv")
    writer = _csv_source(spark, d).repartition(1).write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_csv_rows(spark, path, multiline="split")


_CSV_SQL = """
SELECT cast(s_suppkey AS VARCHAR) AS s_suppkey, s_name || ', "north"' || chr(10) || 'wing' AS s_name,
       CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE cast(s_nationkey AS VARCHAR) END AS s_nationkey,
       CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE ' ' || cast(s_acctbal AS VARCHAR) || ' ' END AS s_acctbal
FROM supplier
"""
register("scan_csv_rows", "s_suppkey s, s_name s, s_nationkey s, s_acctbal s", _scan_csv, _CSV_SQL)
register("scan_csv_split", "s_suppkey s, s_name s, s_nationkey s, s_acctbal s", _scan_csv_split, _CSV_SQL)

# ---------------------------------------------------------------------------
# JSON documents: events in documents of at most 500 rows, three shapes


def _scan_json(spark, d):
    path = _fresh(spark, "json")
    e = bindings.table(spark, d, "events")
    docs = e.groupBy(F.floor(F.col("event_id") / 500).alias("bucket")).agg(
        F.collect_list(F.struct("event_id", "user_id", "event_type", "value")).alias("rows")
    )
    shape = F.col("bucket") % 3
    empty = F.slice(F.col("rows"), 1, 0)
    doc = (
        F.when(shape == 0, F.to_json("rows"))
        .when(shape == 1, F.to_json(F.struct(F.col("rows").alias("records"))))
        .otherwise(F.to_json(F.struct(empty.alias("records"), F.col("rows").alias("data"))))
    )
    docs.select("bucket", doc.alias("value")).write.partitionBy("bucket").text(path)
    rows = read_json_rows(spark, path)
    r = F.col("row")
    return rows.select(
        r.getItem("event_id").alias("event_id"),
        r.getItem("user_id").alias("user_id"),
        r.getItem("event_type").alias("event_type"),
        r.getItem("value").try_cast("double").alias("value"),
    )


register(
    "scan_json_rows",
    "event_id s, user_id s, event_type s, value f",
    _scan_json,
    "SELECT cast(event_id AS VARCHAR) AS event_id, cast(user_id AS VARCHAR) AS user_id, event_type, value FROM events",
)

# ---------------------------------------------------------------------------
# landed JSONL

LANDED_COLS = (
    "dataset_name s, dataset_type s, source_url s, source_row_id s, record_hash s, extracted_at t, ingested_at t, run_id s, payload m"
)


def _land(raw: DataFrame, path: str) -> None:
    """All rows of a run under its day (the bound feeds have one run a year), compressed."""
    write_normalized(raw, path, ingest_date=F.concat(F.right("run_id", F.lit(4)), F.lit("-12-31")), compression="gzip")


def _records(spark, d) -> DataFrame:
    """The records in the order in which they are landed."""
    with bindings.like_rows_together():
        return bindings.raw_records(spark, d)


def _jsonl_roundtrip(spark, d):
    path = _fresh(spark, "landed")
    _land(_records(spark, d), path)
    return read_normalized(spark, path)


register_fragment("sink_jsonl_roundtrip", LANDED_COLS, _jsonl_roundtrip, "raw_records")


def _jsonl_tolerant(spark, d):
    path = _fresh(spark, "jsonl")
    raw = _records(spark, d).withColumn("ingest_date", F.date_format("ingested_at", "yyyy-MM-dd"))
    good = F.to_json(F.struct(*[F.col(c) for c in raw.columns]), {"ignoreNullFields": "false"})
    bad = F.concat(F.lit('{"dataset_name": "broken", "source_row_id": '), F.col("source_row_id"))
    # both lines of a record together: the joins below the records run once, and so do their shuffles
    lines = raw.select(F.explode(F.array(good, bad)).alias("value"))
    with frugal_writes(spark):
        lines.write.option("maxRecordsPerFile", LANDED_ROWS).text(path, compression="gzip")
    return read_normalized(spark, path, file_pattern="part-*")


register_fragment("scan_jsonl_tolerant", LANDED_COLS, _jsonl_tolerant, "raw_records")


def _partitions(spark, d):
    path = _fresh(spark, "table")
    _land(_records(spark, d), path)
    name = f"raw_records_{uuid.uuid4().hex[:12]}"
    counts = register_raw_table(spark, name, path).groupBy("dataset_name", "run_id").agg(F.count(F.lit(1)).alias("record_count"))
    counts = counts.checkpoint(eager=True) if ensure_checkpoint_dir(spark) else counts
    spark.sql(f"DROP TABLE {name}")  # the files stay; nothing is left in the catalog
    return counts


register(
    "raw_table_partitions",
    "dataset_name s, run_id s, record_count i",
    _partitions,
    compose(
        "SELECT dataset_name, run_id, count(*) AS record_count FROM raw_records GROUP BY 1, 2",
        "raw_records",
    ),
)

AUDIT_STAGE = "normalized-stage"


def _audit(spark, d):
    path = _fresh(spark, "audit")
    buffer = bindings.listings_raw(spark, d)
    append_audit(buffer, AUDIT_STAGE, path)
    append_audit(buffer.where(F.col("run_id") >= "run-2000"), AUDIT_STAGE, path)
    return spark.read.parquet(path).select("stage_name", "rows_loaded", "status")


register(
    "load_audit",
    "stage_name s, rows_loaded i, status s",
    _audit,
    compose(
        f"SELECT '{AUDIT_STAGE}' AS stage_name, count(*) AS rows_loaded, 'loaded' AS status FROM listings_raw "
        f"UNION ALL SELECT '{AUDIT_STAGE}', count(*), 'loaded' FROM listings_raw WHERE run_id >= 'run-2000'",
        "listings_raw",
    ),
)

# ---------------------------------------------------------------------------
# streaming pickup

KEY_COLS = "dataset_name s, source_row_id s, record_hash s, run_id s"


def _early(raw: DataFrame) -> DataFrame:
    """A first delivery: four of the feeds, and of the two that grow most what came early."""
    growing = ["listing_snapshots", "nyc_dob_approved_permits"]
    return raw.where(~F.col("dataset_name").isin(growing) | (F.col("ingested_at") < F.lit("1995-01-01").cast("timestamp")))


def _stream_ingest(spark, d):
    base = _fresh(spark, "stream")
    landing, target, ckpt = f"{base}/landing", f"{base}/target", f"{base}/checkpoint"
    raw = _records(spark, d)
    _land(_early(raw), landing)
    ingest_available(landed_stream(spark, landing), target, ckpt)
    _land(raw, landing)  # all feeds; early rows again: matched, so not re-inserted
    ingest_available(landed_stream(spark, landing), target, ckpt)
    ingest_available(landed_stream(spark, landing), target, ckpt)  # nothing new: no change
    return spark.read.parquet(target)


register_fragment("stream_file_ingest", KEY_COLS, _stream_ingest, "raw_records")


def _stream_dedupe(spark, d):
    base = _fresh(spark, "dedupe")
    landing, target, ckpt = f"{base}/landing", f"{base}/target", f"{base}/checkpoint"
    raw = _records(spark, d)
    _land(raw, landing)
    _land(_early(raw), landing)  # same keys twice in one micro-batch
    stream_insert_ignore(landed_stream(spark, landing), target, ckpt, order=["ingested_at", "record_hash"])
    _land(_early(raw), landing)  # and again in a later one
    stream_insert_ignore(landed_stream(spark, landing), target, ckpt, order=["ingested_at", "record_hash"])
    return spark.read.parquet(target)


register_fragment("stream_dedupe", KEY_COLS, _stream_dedupe, "raw_records")

# ---------------------------------------------------------------------------
# merges by the key index


def _append_indexed(spark, d):
    base = _fresh(spark, "indexed")
    root, records = f"{base}/raw", f"{base}/records"
    columns = ["dataset_name", "source_row_id", "record_hash", "run_id"]
    # each append goes over its batch more than once: payloads and hashes are worked out once for all of them
    with frugal_writes(spark):
        bindings.raw_records(spark, d).select(*columns, "ingested_at").write.option("compression", TABLE_CODEC).parquet(records)
    raw = spark.read.parquet(records)
    append_indexed(_early(raw).select(*columns), root, ENVELOPE_KEYS)
    append_indexed(raw.select(*columns), root, ENVELOPE_KEYS)
    append_indexed(raw.select(*columns), root, ENVELOPE_KEYS)  # a replay appends nothing
    remove_folder(spark, records)
    return spark.read.parquet(root)


register_fragment("merge_append_indexed", KEY_COLS, _append_indexed, "raw_records")


def _upsert_moved(spark, d):
    root = _fresh(spark, "indexed") + "/events"
    events = bindings.table(spark, d, "events").select("event_id", "event_type", "value")
    moved = F.col("event_id") % 3 == 0
    old = events.where(F.col("event_id") % 5 != 0)
    new = events.where(moved | (F.col("event_id") % 5 == 0))
    upsert_indexed(old, root, "event_id", "event_type")
    upsert_indexed(new.withColumn("event_type", F.when(moved, F.lit("moved")).otherwise(F.col("event_type"))), root, "event_id", "event_type")
    return spark.read.parquet(root)


register(
    "merge_upsert_moved",
    "event_id i, event_type s, value f",
    _upsert_moved,
    "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'moved' ELSE event_type END AS event_type, value FROM events",
)

# ---------------------------------------------------------------------------
# published extracts

_KIND = {"STRING": "s", "DECIMAL": "f", "INTEGER": "i", "DATETIME": "t"}
_ROUNDED = {"six_month_rent_volatility", "median_listing_rent"}
EXTRACT_KEYS = {
    "extract_scorecard": "neighborhood_scorecard",
    "extract_rent_trends": "rent_trends",
    "extract_affordability": "affordability",
    "extract_development": "development_activity",
    "extract_transit": "transit_price_effect",
}


def _extract_query(dataset: str):
    model, cols = EXTRACTS[dataset]
    shared = SHARED_MODELS if model == "mart_neighborhood_scorecard" else ()
    return lambda spark, d: extract(getattr(ModelGraph(spark, d, materialize=shared), model), cols)


for _key, _dataset in EXTRACT_KEYS.items():
    _model, _cols = EXTRACTS[_dataset]
    _spec = ", ".join(f"{c} {'r' if c in _ROUNDED else _KIND[k]}" for c, k in _cols)
    register_fragment(_key, _spec, _extract_query(_dataset), _model)


# ---------------------------------------------------------------------------
# incremental fact stored as a partitioned table: only recent partitions rewritten

HISTORY_COLS = "listing_snapshot_id s, listing_id s, snapshot_date t, rent d, rent_change_amount d, rent_change_pct f, days_on_market i"


def _upsert_table(spark, d):
    from hearth.plans.queries_ops import OLD_CUTOFF

    base = _fresh(spark, "fct")
    root = f"{base}/fct_listing_history"
    # the staging is read twice by the lag's range split, the model by both upserts: each is written once
    model = ModelGraph(spark, d, materialize=("stg_listing_snapshots",)).fct_listing_history
    model.withColumn("snapshot_month", F.trunc("snapshot_date", "month")).write.parquet(f"{base}/model")
    history = spark.read.parquet(f"{base}/model")
    old = history.where(F.col("snapshot_date") < F.lit(OLD_CUTOFF).cast("date"))
    upsert_partitions(old, root, "listing_snapshot_id", "snapshot_date", "snapshot_month")
    upsert_partitions(history, root, "listing_snapshot_id", "snapshot_date", "snapshot_month")
    return spark.read.parquet(root)


register_fragment("merge_upsert_table", HISTORY_COLS, _upsert_table, "history_upserted")


# ---------------------------------------------------------------------------
# stored models: staging as views, the rest as versioned tables; truncate and reload


def _materialize(spark, d):
    root = _fresh(spark, "models")
    p = ModelGraph(spark, d)
    listings = materialize(p.stg_listing_snapshots, "staging", "stg_listing_snapshots", root)  # a view
    dim = materialize(marts.dim_listings(listings), "marts", "dim_listings", root)  # a table
    return materialize(marts.dim_listings(listings).select(*dim.columns), "marts", "dim_listings", root)  # a second version of it


register_fragment("materialize_models", MODEL_COLUMNS["dim_listings"], _materialize, "dim_listings")


def _reload(spark, d):
    root = _fresh(spark, "reload")
    columns = ["dataset_name", "source_row_id", "record_hash", "run_id"]
    # both loads read the records: payloads and hashes are worked out once
    bindings.raw_records(spark, d).select(*columns, "ingested_at").write.parquet(f"{root}/records")
    raw = spark.read.parquet(f"{root}/records")
    truncate_reload(_early(raw).select(*columns), f"{root}/table")
    return truncate_reload(raw.select(*columns), f"{root}/table")  # nothing of the first load stays


register_fragment("truncate_reload", KEY_COLS, _reload, "raw_records")
