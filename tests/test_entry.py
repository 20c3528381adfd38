import importlib
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_and_registry(spark):
    sys.path.insert(0, ROOT)
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.columns == ["season", "syndrome", "avg_relative_cases", "n_months"]
    assert df.count() > 0
    qs, ors = entry.queries(), entry.oracle_sql()
    assert set(ors) <= set(qs)
    assert len(qs) >= 40
