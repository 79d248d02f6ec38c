"""The driver's check in miniature: Spark query vs DuckDB oracle at sf0.001."""

import pytest

from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = ["to_bronze", "quarantine_bad_files", "ingest_report", "quality_report", "build_weather",
         "daily_hour_grid", "interval_features", "daily_features", "append_new_dates", "standardize",
         "assign_cluster", "map_clusters", "estimate_daily", "appliance_profile", "daily_summary",
         "load_bands", "average_attribution", "expand_runs_to_intervals", "format_meter_export",
         "hvac_temperature_response", "clean_esiid", "coerce_kwh", "parse_usage_date", "reconcile_totals",
         "cluster_diagnostics", "day_intervals", "model_metrics", "ingest_incremental", "run_incremental", "run_disaggregate"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert res["status"] == "ok", res


def test_registry_covers_oracles():
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
    own = {n for n in E.queries() if n != "pipeline" and not n.startswith("op")}
    assert own <= set(E.oracle_sql())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["esiid", "usage_date"]
