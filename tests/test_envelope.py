from pyspark.sql import functions as F

from hearth.operators.envelope import SourceSpec, record_hash, source_row_id, to_raw_records
from hearth.operators.ordinal import with_dense_index

LISTINGS = SourceSpec("listing_snapshots", "listings", "file://listings.csv", ("listing_id", "snapshot_date"))


def test_hash_ignores_key_order(spark):
    df = spark.createDataFrame([({"b": "2", "a": "1"},), ({"a": "1", "b": "2"},)], "p map<string,string>")
    h = [r[0] for r in df.select(record_hash(F.lit("n"), F.lit("t"), F.lit("u"), F.lit("id"), F.col("p"))).collect()]
    assert h[0] == h[1] and len(h[0]) == 64


def test_key_from_primary_key_and_type(spark):
    df = spark.createDataFrame([("rp-1", "2026-04-30", "3000")], "listing_id string, snapshot_date string, rent string")
    r = to_raw_records(df, LISTINGS, "run-x", "2026-05-01 00:00:00").first()
    assert r["source_row_id"] == "rp-1|2026-04-30"
    assert r["dataset_type"] == "listings"
    assert r["payload"]["rent"] == "3000"
    assert r["extracted_at"] == r["ingested_at"]


def test_key_lookup_fallbacks_and_ordinal(spark):
    rows = [({"complex id": "7"},), ({"Complex_ID": "9"},), ({"other": "x"},), ({"Complex ID": ""},)]
    df = with_dense_index(spark.createDataFrame(rows, "p map<string,string>"), "ord")
    out = df.select(source_row_id(F.col("p"), ["Complex ID"], F.concat(F.lit("stations:"), F.col("ord"))).alias("rid"), "ord")
    got = sorted((r["ord"], r["rid"]) for r in out.collect())
    assert got == [(1, "7"), (2, "9"), (3, "stations:3"), (4, "stations:4")]


def test_dense_index_is_dense_over_partitions(spark):
    df = spark.range(0, 1000, 1, 7)
    idx = with_dense_index(df, "i").collect()
    assert sorted(r["i"] for r in idx) == list(range(1, 1001))
    assert all(r["i"] == r["id"] + 1 for r in idx)


def test_hash_is_sha256_of_compact_sorted_json(spark):
    import hashlib
    import json

    record = {"dataset_name": "n", "dataset_type": "t", "source_url": "u", "source_row_id": "rp-1|2026-04-30",
              "payload": {"rent": "3000", "listing_id": "rp-1", "note": None, "snapshot_date": "2026-04-30"}}
    want = hashlib.sha256(json.dumps(record, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    df = spark.createDataFrame([(record["payload"],)], "p map<string,string>")
    args = [F.lit("n"), F.lit("t"), F.lit("u"), F.lit("rp-1|2026-04-30")]
    general = df.select(record_hash(*args, F.col("p"))).first()[0]
    fast = df.select(record_hash(*args, F.map_from_entries(F.array_sort(F.map_entries("p"))), True)).first()[0]
    assert general == fast == want


def test_latest_version_staging(spark):
    from hearth.plans.staging import stg_rent_prices

    spec = SourceSpec("zillow_zori_zip", "rent_prices", "u", ("RegionID",))
    old = spark.createDataFrame([({"RegionID": "1", "RegionName": "10025", "2026-01-01": "3000"},)], "p map<string,string>")
    new = spark.createDataFrame(
        [({"RegionID": "1", "RegionName": "10025", "2026-01-01": "3000", "2026-02-01": "3100"},)], "p map<string,string>"
    )
    raw = to_raw_records(old, spec, "r1", "2026-02-01 00:00:00", payload=F.col("p")).unionByName(
        to_raw_records(new, spec, "r2", "2026-03-01 00:00:00", payload=F.col("p"))
    )
    assert stg_rent_prices(raw).count() == 3  # every landed version: January twice
    latest = stg_rent_prices(raw, latest_version=True)
    assert sorted(str(r["rent_month"]) for r in latest.collect()) == ["2026-01-01", "2026-02-01"]


def test_ordinal_restarts_per_file(spark):
    import os
    import tempfile

    from hearth.sources.files import read_csv_rows

    d = tempfile.mkdtemp(prefix="hearth-ord-")
    for name, rows in (("a.csv", ["", "k1", ""]), ("b.csv", ["", "", "k2", ""])):
        with open(os.path.join(d, name), "w") as fh:
            fh.write("id,v\n" + "".join(f"{r},x\n" for r in rows))
    spec = SourceSpec("feed", "t", "u", ("id",))
    raw = to_raw_records(read_csv_rows(spark, d), spec, "r", "2026-01-01 00:00:00", ordinal_scope="file")
    ids = sorted(r["source_row_id"] for r in raw.collect())
    assert ids == sorted(["feed:1", "k1", "feed:3", "feed:1", "feed:2", "k2", "feed:4"])
    whole = to_raw_records(read_csv_rows(spark, d), spec, "r", "2026-01-01 00:00:00")
    assert len({r["source_row_id"] for r in whole.collect()}) == 7  # one numbering over both files
