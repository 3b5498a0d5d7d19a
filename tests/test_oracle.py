"""SQL oracle on the smallest data set (the driver runs the full set at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_check import compare

SUBSET = ["conditional_delay", "histogram_by_duration", "histogram_swiss_profile", "histogram_gtfs_profile",
          "total_sample_count", "quality_counters", "response_log", "stop_events", "gtfs_version_asof",
          "station_repair", "official_comparison", "hafas_response_type", "access_log_meta", "surrogate_keys", "fptf_metadata", "fptf_stations",
          "late_samples", "batch_window", "dimension_lookup", "stop_events_versioned", "log_entries", "stream_resume_files"]


@pytest.mark.parametrize("name", SUBSET)
def test_oracle(spark, name):
    res = compare(spark, "/root/testdata/sf0.001", [name], verbose=False)
    assert res[name] == "OK", res[name]


def test_every_query_has_an_oracle():
    from oracle import all_sql
    from punctuo.registry import REGISTRY
    assert set(REGISTRY) == set(all_sql())


def test_oracle_imports_nothing_from_the_library():
    import oracle
    for name in os.listdir(os.path.dirname(oracle.__file__)):
        if name.endswith(".py"):
            with open(os.path.join(os.path.dirname(oracle.__file__), name), encoding="utf-8") as f:
                assert "punctuo" not in f.read()


def test_the_rest_works_without_the_training_data_queries(monkeypatch):
    import sys as _sys

    import __spark_entry__ as E
    from punctuo.registry import REGISTRY
    for name in [m for m in _sys.modules if m.startswith("punctuo.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(_sys.modules, name)
    monkeypatch.setitem(_sys.modules, "punctuo.llm", None)
    assert set(E.queries()) == set(REGISTRY) and set(E.oracle_sql()) <= set(REGISTRY)
