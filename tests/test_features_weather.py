import datetime as dt

from pyspark.sql import functions as F

from loadsplit.functions.numeric import round_half_even
from loadsplit.operators import features as FT
from loadsplit.operators import weather as W
from tests.conftest import ts


def test_ac_proxy_threshold_and_missing_weather(spark):
    iv = spark.createDataFrame([("m", ts("2025-05-01 10:15:00"), 0.5), ("m", ts("2025-05-01 11:15:00"), 0.5),
                                ("m", ts("2025-05-01 12:15:00"), 0.5), ("m", ts("2025-05-01 13:15:00"), 0.5)],
                               "esiid string, interval_start_dt timestamp_ntz, usage_kwh double")
    wx = spark.createDataFrame([(ts("2025-05-01 10:00:00"), 23.0), (ts("2025-05-01 11:00:00"), 23.1),
                                (ts("2025-05-01 12:00:00"), None)], "datetime timestamp_ntz, temp_c double")
    rows = FT.interval_features(iv, wx).orderBy("interval_start_dt").collect()
    assert len(rows) == 4                                   # left join keeps the hour without weather
    assert [r["ac_proxy"] for r in rows] == [False, True, False, False]
    assert rows[3]["temp_c"] is None


def test_zero_total_day_has_null_ratio(spark):
    sv = spark.createDataFrame([("m", ts("2025-05-01 10:15:00"), 0.0, True), ("m", ts("2025-05-02 01:00:00"), None,
                                                                             False)],
                               "esiid string, interval_start_dt timestamp_ntz, usage_kwh double, is_peak boolean")
    rows = {str(r["usage_date"]): r for r in FT.daily_features(sv).collect()}
    assert rows["2025-05-01"]["peak_ratio"] is None and rows["2025-05-01"]["total_kwh"] == 0.0
    assert rows["2025-05-02"]["total_kwh"] == 0.0          # all-null day sums to 0 (pandas)
    assert rows["2025-05-02"]["max_interval_kwh"] is None


def test_last_reading_of_hour_wins(spark):
    r = spark.createDataFrame([(ts("2025-05-01 10:10:00"), 20.0), (ts("2025-05-01 10:50:00"), 21.0)],
                              "reading_ts timestamp_ntz, temp_c double")
    assert W.last_of_hour(r).first()["temp_c"] == 21.0


def test_gap_fill_linear(spark):
    r = spark.createDataFrame([(ts("2025-05-01 10:00:00"), 10.0), (ts("2025-05-01 13:00:00"), 16.0)],
                              "reading_ts timestamp_ntz, temp_c double")
    fused = [x["temp_c"] for x in W.build_weather(r).orderBy("datetime").collect()]
    assert fused == [10.0, 12.0, 14.0, 16.0]
    hourly = W.last_of_hour(r)
    generic = [x["temp_c"] for x in W.interpolate_linear(W.hourly_spine(hourly)).orderBy("datetime").collect()]
    assert generic == [10.0, 12.0, 14.0, 16.0]


def test_daily_grid_fills_edges_within_day(spark):
    wx = spark.createDataFrame([(ts("2025-05-01 05:00:00"), 15.0), (ts("2025-05-01 07:00:00"), 17.0),
                                (ts("2025-05-02 12:00:00"), 30.0)], "datetime timestamp_ntz, temp_c double")
    g = W.daily_hour_grid(wx).orderBy("datetime").collect()
    assert len(g) == 48
    d1 = [x["temp_c"] for x in g[:24]]
    assert d1[0] == 15.0 and d1[5] == 15.0 and d1[6] == 16.0 and d1[7] == 17.0 and d1[23] == 17.0
    assert all(x["temp_c"] == 30.0 for x in g[24:])       # no bleed from the previous day


def test_round_half_even(spark):
    df = spark.createDataFrame([(2.25,), (2.35,), (-0.25,), (0.05,)], "x double")
    out = [r[0] for r in df.select(round_half_even("x", 1)).collect()]
    assert out[0] == 2.2 and out[2] == -0.2
    import numpy as np
    assert out == [float(x) for x in np.round([2.25, 2.35, -0.25, 0.05], 1)]   # pandas' rounding


def test_dedupe_keeps_first_row_of_hour(spark):
    wx = spark.createDataFrame([(ts("2025-05-01 10:30:00"), 2.0), (ts("2025-05-01 10:00:00"), 1.0)],
                               "datetime timestamp_ntz, temp_c double")
    row = W.dedupe_hour(wx).first()
    assert row["temp_c"] == 1.0 and row["datetime"] == dt.datetime(2025, 5, 1, 10)
    assert W.dedupe_hour(wx).select(F.count("*")).first()[0] == 1


def test_stations_fill_independently(spark):
    r = spark.createDataFrame([("a", ts("2025-05-01 10:00:00"), 10.0), ("a", ts("2025-05-01 12:00:00"), 14.0),
                               ("b", ts("2025-05-01 10:30:00"), 0.0), ("b", ts("2025-05-01 13:00:00"), 3.0)],
                              "station string, reading_ts timestamp_ntz, temp_c double")
    out = {(x["station"], x["datetime"].hour): x["temp_c"]
           for x in W.build_weather(r, keys=["station"]).collect()}
    assert out == {("a", 10): 10.0, ("a", 11): 12.0, ("a", 12): 14.0,
                   ("b", 10): 0.0, ("b", 11): 1.0, ("b", 12): 2.0, ("b", 13): 3.0}
    plan = W.build_weather(r, keys=["station"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(station" in plan


def test_weather_joins_by_station_and_fills_across_years(spark):
    from loadsplit.operators import features as FT
    from loadsplit.operators import weather as W
    rows = [("s1", ts("2023-12-31T22:00"), 10.0), ("s1", ts("2024-01-01T02:00"), 14.0), ("s2", ts("2023-12-31T23:00"), 30.0)]
    hours = W.fill_hours(spark.createDataFrame(rows, "station string, datetime timestamp_ntz, temp_c double"), ["station"])
    assert [r["temp_c"] for r in hours.where("station = 's1'").orderBy("datetime").collect()] == [10.0, 11.0, 12.0, 13.0, 14.0]
    m = spark.createDataFrame([("a", "s1", ts("2023-12-31T23:15")), ("b", "s2", ts("2023-12-31T23:15")), ("c", "s2", ts("2024-01-01T00:00"))],
                              "esiid string, station string, interval_start_dt timestamp_ntz")
    got = {r["esiid"]: r["temp_c"] for r in FT.join_weather(m, hours, ["station"]).collect()}
    assert got == {"a": 11.0, "b": 30.0, "c": None}
