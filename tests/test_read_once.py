"""Work that two steps of a query share is done once, with the columns they read."""

from hearth.operators.windows import with_lags
from hearth.plans import bindings, queries_io
from hearth.plans.graph import SHARED_MODELS, ModelGraph
from hearth.plans.marts import HISTORY_READ, listing_history

SMOKE = "/root/testdata/sf0.001"


def test_reload_works_its_records_out_once(spark, monkeypatch):
    calls, whole = [], bindings.raw_records
    monkeypatch.setattr(bindings, "raw_records", lambda s, d: calls.append(d) or whole(s, d))
    columns = ["dataset_name", "source_row_id", "record_hash", "run_id"]
    assert sorted(queries_io._reload(spark, SMOKE).collect()) == sorted(whole(spark, SMOKE).select(*columns).collect())
    assert len(calls) == 1


def test_shared_listings_keep_the_columns_that_are_read(spark):
    listings = ModelGraph(spark, SMOKE, materialize=SHARED_MODELS).stg_listing_snapshots
    assert listings.columns == list(HISTORY_READ)
    whole = listing_history(ModelGraph(spark, SMOKE).stg_listing_snapshots)
    narrow = listing_history(listings)
    assert [c for c in whole.columns if c in narrow.columns] == narrow.columns
    assert {"bedrooms", "run_id"} == {"bedrooms", "run_id"} & (set(whole.columns) - set(narrow.columns))
    key = "listing_snapshot_id"
    assert sorted(narrow.collect(), key=lambda r: r[key]) == sorted(whole.select(*narrow.columns).collect(), key=lambda r: r[key])


def test_lag_is_written_as_columns(spark):
    rows = [(k, d, d * 10 + (k or 0)) for k in (1, 2, None) for d in range(5)]
    df = spark.createDataFrame(rows, "k int, d int, v int")
    out = with_lags(df, ["k"], ["d"], [("v", "prev")])
    assert any("lag-" in f for f in out.inputFiles())
    assert sorted((r.k or 0, r.d, r.prev) for r in out.collect() if r.d) == sorted((k or 0, d, (d - 1) * 10 + (k or 0)) for k, d, _ in rows if d)
