"""P6 end to end on the smallest driver tables, with a real KMeans fit."""

import pytest
from pyspark.sql import functions as F

from loadsplit.plans import pipeline as PL
from loadsplit.session import local_path
from loadsplit.sources import fixtures as X
from loadsplit.sources.snapshots import Warehouse

SF = "/root/testdata/sf0.001"


def test_run_all_invariants_and_reruns(spark, scratch):
    root = PL._export_dirty(spark, SF, dirty=False)
    wh = scratch("wh")
    station = X.station_view(spark, SF)
    summary = PL.run_all(spark, root, station, wh, layout="export", n_init=2)
    assert summary.count() > 0

    t = lambda name: PL.read_table(spark, wh, name)
    gold, daily = t("gold_estimates"), t("silver_daily")
    assert {r[0] for r in gold.select("appliance").distinct().collect()} == \
        {"baseline", "hvac", "cooking", "washer", "dryer"}
    lo, hi = gold.agg(F.min("confidence"), F.max("confidence")).first()
    assert 0.3 <= lo <= hi <= 1.0
    attributed = gold.groupBy("esiid", "usage_date").agg(F.sum(F.col("estimated_kwh").cast("decimal(18,6)"))
                                                         .cast("double").alias("a"))
    rec = attributed.join(daily, ["esiid", "usage_date"], "full_outer")
    assert rec.where(F.abs(F.coalesce("a", F.lit(0.0)) - F.coalesce("total_kwh", F.lit(0.0))) > 1e-9).count() == 0

    counts = {n: t(n).count() for n in ("bronze", "silver_intervals", "silver_daily", "gold_estimates",
                                        "gold_profile", "gold_summary")}
    assert PL.run_ingest(spark, root, wh, layout="export").first()["rows_loaded"] == 0
    PL.run_features(spark, wh)
    PL.run_disaggregate(spark, wh)
    PL.run_export(spark, wh)
    assert {n: t(n).count() for n in counts} == counts


def _chain(spark, wh, raw):
    PL.ingest_raw(spark, raw, wh).collect()
    PL.run_features(spark, wh)
    PL.run_disaggregate(spark, wh, centroids=X.fixed_centroids(spark))
    PL.run_export(spark, wh)


def test_late_meter_reaches_the_exports_and_old_rows_stay(spark, scratch):
    wh, raw = scratch("wh"), X.raw_meter_view(spark, SF)
    late = raw.where("source_file = '2024/01/20240110.csv'").limit(3) \
        .withColumn("ESIID", F.lit("'late")).withColumn("source_file", F.lit("late.csv"))
    late = spark.createDataFrame(late.collect(), late.schema)
    PL.run_weather(spark, X.station_view(spark, SF), wh)
    _chain(spark, wh, raw)
    gold = lambda: {(r["esiid"], r["usage_date"], r["appliance"]): r["confidence"]
                    for r in PL.read_table(spark, wh, "gold_estimates").collect()}
    before, days = gold(), PL.read_summary(spark, wh).count()
    _chain(spark, wh, raw.unionByName(late))
    after = gold()
    assert all(after[k] == v for k, v in before.items()) and any(k[0] == "late" for k in after)
    total = PL.read_table(spark, wh, "gold_estimates").agg(F.sum("estimated_kwh")).first()[0]
    published = PL.read_summary(spark, wh)
    assert published.count() == days
    assert abs(published.agg(F.sum("total_kwh")).first()[0] - total) < 1e-3
    assert PL.read_table(spark, wh, "gold_profile").count() == len(after)


def test_a_stop_between_the_silver_writes_adds_nothing_twice(spark, scratch, monkeypatch):
    wh = scratch("wh")
    PL.run_weather(spark, X.station_view(spark, SF), wh)
    PL.ingest_raw(spark, X.raw_meter_view(spark, SF), wh).collect()
    monkeypatch.setattr(PL.FT, "daily_features", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
    try:
        PL.run_features(spark, wh)
    except RuntimeError:
        pass
    monkeypatch.undo()
    with pytest.raises(ValueError, match="no table silver_intervals"):
        PL.read_table(spark, wh, "silver_intervals")
    PL.run_features(spark, wh)
    n = PL.read_table(spark, wh, "silver_intervals").count()
    PL.run_features(spark, wh)
    assert PL.read_table(spark, wh, "silver_intervals").count() == n > 0


def test_one_new_day_reads_its_files_only(spark, scratch):
    wh = scratch("wh")
    PL.ingest_raw(spark, X.raw_meter_view(spark, SF), wh).collect()
    day = PL.read_table(spark, wh, "bronze", only=["2024-01-10"])
    assert day.inputFiles() and all("usage_date=2024-01-10" in f for f in day.inputFiles())
    assert day.count() == PL.read_table(spark, wh, "bronze").where("usage_date = '2024-01-10'").count()


def test_model_versions_are_not_overwritten(spark, scratch):
    wh = scratch("wh")
    PL.run_weather(spark, X.station_view(spark, SF), wh)
    _chain(spark, wh, X.raw_meter_view(spark, SF))
    with pytest.raises(ValueError, match="v1"):
        PL.run_disaggregate(spark, wh, version="v1", refit=True, centroids=X.fixed_centroids(spark))
    versions = lambda: {r[0] for r in PL.read_table(spark, wh, "gold_estimates").select("model_version").distinct().collect()}
    assert versions() == {"v1"}
    PL.run_disaggregate(spark, wh, version="v2", centroids=X.fixed_centroids(spark))
    assert versions() == {"v2"}
    head = Warehouse(spark, wh).head()
    PL.run_disaggregate(spark, wh)              # the version in use stays in use
    assert versions() == {"v2"} and Warehouse(spark, wh).head() == head


def _days(spark, lo, hi):
    return X.raw_meter_view(spark, SF).where(f"source_file between '2024/01/202401{lo:02d}.csv' and '2024/01/202401{hi:02d}.csv'")


def test_a_day_whose_scoring_came_late_is_published(spark, scratch):
    wh, cents = scratch("wh"), X.fixed_centroids(spark)
    PL.run_weather(spark, X.station_view(spark, SF), wh)
    _chain(spark, wh, _days(spark, 1, 4))
    PL.ingest_raw(spark, _days(spark, 1, 5), wh).collect()
    PL.run_features(spark, wh)
    PL.run_export(spark, wh)                    # nothing to publish yet
    assert str(PL.read_summary(spark, wh).agg(F.max("usage_date")).first()[0]) == "2024-01-04"
    PL.run_disaggregate(spark, wh, centroids=cents)
    PL.run_export(spark, wh)
    assert str(PL.read_summary(spark, wh).agg(F.max("usage_date")).first()[0]) == "2024-01-05"


def test_later_weather_reaches_silver_gold_and_exports(spark, scratch):
    wh, station = scratch("wh"), X.station_view(spark, SF)
    PL.run_weather(spark, station.where("DATE < timestamp_ntz'2024-01-03'"), wh)
    _chain(spark, wh, _days(spark, 1, 4))
    late = "temp_c is null and usage_date > '2024-01-01'"           # the first hours of all have no reading before them
    blank = PL.read_table(spark, wh, "silver_intervals").where(late).count()
    before, head = PL.read_summary(spark, wh).collect(), Warehouse(spark, wh).head()
    PL.run_weather(spark, station, wh)
    redone = PL.run_features(spark, wh)
    changed = {d for d, p in Warehouse(spark, wh).parts("silver_daily").items() if any(c.startswith(f"c{head + 2}-") for c in p["commits"])}
    assert changed and "2024-01-01" not in changed and redone.count()     # the first day's hours are the same
    PL.run_disaggregate(spark, wh)
    PL.run_export(spark, wh)
    assert blank > PL.read_table(spark, wh, "silver_intervals").where(late).count() == 0
    assert PL.read_summary(spark, wh).collect() != before


def test_a_run_that_stops_leaves_readers_where_they_were(spark, scratch, monkeypatch):
    wh, station, cents = scratch("wh"), X.station_view(spark, SF), X.fixed_centroids(spark)
    export = scratch("export")
    PL.sinks.write_meter_export(_days(spark, 1, 3), export)
    PL.run_all(spark, export, station, wh, layout="export", centroids=cents)
    state = lambda: [PL.read_table(spark, wh, n).count() for n in ("bronze", "silver_intervals", "silver_daily", "gold_estimates")]
    before, head = state(), Warehouse(spark, wh).head()
    more = scratch("export")
    PL.sinks.write_meter_export(_days(spark, 1, 6), more)
    monkeypatch.setattr(PL.E, "daily_summary", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        PL.run_all(spark, more, station, wh, layout="export", centroids=cents)
    monkeypatch.undo()
    assert state() == before and Warehouse(spark, wh).head() == head
    PL.run_all(spark, more, station, wh, layout="export", centroids=cents)
    assert state()[0] == _days(spark, 1, 6).count() and PL.read_table(spark, wh, "bronze", at=head).count() == before[0]


def test_named_exports(spark, scratch):
    wh, out = scratch("wh"), scratch("csv")
    PL.run_weather(spark, X.station_view(spark, SF), wh)
    _chain(spark, wh, _days(spark, 1, 3))
    for _ in range(2):
        PL.run_export(spark, wh, csv_dir=out)
    lines = open(f"{local_path(out)}/daily_summary.csv").read().splitlines()
    assert lines[0].startswith("usage_date,total_kwh") and [x[:10] for x in lines[1:]] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert len(open(f"{local_path(out)}/appliance_profile.csv").read().splitlines()) == 1 + PL.read_table(spark, wh, "gold_profile").count()
