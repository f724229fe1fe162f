"""The driver contract, loading the entry module by file path."""

import importlib.util
import os

from hearth.plans.registry import REGISTRY

from conftest import ROOT


def test_entry_module_by_path(spark):
    spec = importlib.util.spec_from_file_location("entry_by_path", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    queries, oracle = module.queries(), module.oracle_sql()
    assert set(REGISTRY) <= set(oracle) <= set(queries) and len(oracle) >= 92
    without = set(queries) - set(oracle)  # what SQL cannot express, of the optional part alone
    assert not without & set(REGISTRY)
    df = module.entry(spark)
    assert df.columns[:2] == ["zip_month_signal_id", "postal_code"]
    assert df.count() > 0
