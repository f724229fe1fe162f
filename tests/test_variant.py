"""Payloads of VARIANT type give what map payloads give, and JSON null is pinned."""

import json

import pytest
from pyspark.sql import functions as F

from hearth.functions import field, has_field, map_of, payload_of, unpivot
from hearth.plans import bindings, staging

from conftest import SMALL_SF

DOCS = [
    {"Complex ID": "5", "a": None, "n": 1.5, "o": {"x": [1, 2]}, "2024-01-01": "7.5", "2024-02-01": None, "b": True, "it's": "q", 'say "x"': "r", "": "empty"},
    {"a": "", "complex id": 7, "list": [], "deep": {"a": {"b": None}}},
    {},
    [1, {"a": 2}],
    "text",
    None,
]


@pytest.fixture(scope="module")
def variants(spark):
    rows = [(i, json.dumps(d)) for i, d in enumerate(DOCS)] + [(9, None)]
    return spark.createDataFrame(rows, "id int, j string").select("id", F.parse_json("j").alias("payload"))


def _value(v):
    return None if v is None else v if isinstance(v, str) else json.dumps(v, separators=(",", ":"))


def test_members_as_text(variants):
    p = payload_of(variants)
    names = ["Complex ID", "a", "n", "o", "b", "it's", 'say "x"', "list", "deep", "complex id"]
    rows = variants.select("id", *[field(p, k).alias(f"f{i}") for i, k in enumerate(names)], *[has_field(p, k).alias(f"h{i}") for i, k in enumerate(names)])
    for r in rows.collect():
        doc = DOCS[r.id] if r.id < len(DOCS) and isinstance(DOCS[r.id], dict) else {}
        for i, k in enumerate(names):
            assert r[f"f{i}"] == _value(doc.get(k)), k
            assert bool(r[f"h{i}"]) == (k in doc), k  # a JSON null is there


def test_no_path_for_a_key_with_both_quotes(variants):
    with pytest.raises(ValueError):
        field(payload_of(variants), "a'\"b")


def test_unpivot_rows(variants):
    got = sorted((r.id, r.k, r.v) for r in unpivot(variants, "payload", key="k", value="v").select("id", "k", F.coalesce("v", F.lit("<null>")).alias("v")).collect())
    expect = sorted((i, k, _value(v) if v is not None else "<null>") for i, d in enumerate(DOCS) if isinstance(d, dict) for k, v in d.items())
    assert got == expect
    months = unpivot(variants, "payload", "^[0-9]{4}-[0-9]{2}-[0-9]{2}$").select("key", "value").collect()
    assert sorted((r.key, r.value) for r in months if r.value) == [("2024-01-01", "7.5")] and len(months) == 2


def test_unpivot_of_a_map_is_the_same(spark, variants):
    maps = variants.select("id", map_of(payload_of(variants)).alias("payload"))
    show = lambda df: sorted((r.id, r.key, r.value is None, r.value or "") for r in unpivot(df, "payload").select("id", "key", "value").collect())
    assert show(maps) == show(variants)
    nulls = maps.where("id = 0").select(has_field("payload", "a")).first()[0]
    assert nulls is False  # a map cannot hold a JSON null


@pytest.mark.parametrize("model, feed", [
    ("stg_rent_prices", "rent_wide_raw"), ("stg_inventory", "inventory_wide_raw"), ("stg_listing_snapshots", "listings_raw"),
    ("stg_permits", "permits_raw"), ("stg_neighborhood_housing", "housing_raw"), ("stg_transit_access", "stations_raw"),
])
def test_staging_models_take_either_kind(spark, model, feed):
    raw = getattr(bindings, feed)(spark, SMALL_SF)
    present = F.map_filter("payload", lambda _, v: v.isNotNull())  # a key without a value is no JSON null
    as_variant = raw.withColumn("payload", F.parse_json(F.to_json(present)))
    build = getattr(staging, model)
    one, other = build(raw), build(as_variant)
    assert one.schema == other.schema
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty() and not one.isEmpty()


def test_variant_unpivot_stays_in_the_jvm(variants):
    plan = unpivot(variants, "payload", "^x")._jdf.queryExecution().executedPlan().toString()
    assert "Generate variant_explode" in plan and "Python" not in plan and "Join" not in plan
