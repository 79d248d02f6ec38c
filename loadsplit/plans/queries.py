"""Query registry for the driver: one callable per operator of the survey,
each ``(spark, sf_dir) -> DataFrame`` over views derived from the whole
``events`` table (see ``loadsplit.sources.fixtures``).

Every query builds its own intermediates, so Catalyst can prune columns and
push filters down to the ``events`` scan. Those that read silver several times
(model statistics, scoring, gold) write it once while they are built.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsplit.functions import bands as BF
from loadsplit.functions import calendar as C
from loadsplit.functions import numeric as N
from loadsplit.functions import parsing as P
from loadsplit.operators import attribution as A
from loadsplit.operators import bands as B
from loadsplit.operators import export as E
from loadsplit.operators import features as FT
from loadsplit.operators import ingest as I
from loadsplit.operators import model as M
from loadsplit.operators import quality as Q
from loadsplit.operators import reports as R
from loadsplit.operators import weather as W
from loadsplit.sources import fixtures as X
from loadsplit.session import scratch_path
from loadsplit.sources.meter_csv import read_station_readings
from loadsplit.sources.sinks import read_summary_csv, reset_table, write_csv, write_table

Query = Callable[[SparkSession, str], DataFrame]

LOADED_BEFORE = "2024-01-16"   # days before this count as already loaded (S14, S16, F11)
LOADED_BEFORE_FILE = "2024/01/20240116.csv"
DAY = "2024-01-15"             # the dashboard's selected day (B1)
RANGE = ("2024-01-08", "2024-01-21")  # the dashboard's date range (B2)


# --- shared lazy intermediates -------------------------------------------------

def weather(spark, d) -> DataFrame:
    return W.build_weather(X.station_view(spark, d))


def readings(spark, d) -> DataFrame:
    return read_station_readings(X.station_view(spark, d))


def silver(spark, d, day: str | None = None) -> DataFrame:
    """Silver intervals (of one day). The hourly series is written first: its
    size is then known when the join is planned, before intervals are shuffled."""
    intervals = I.filter_flow(X.meter_view(spark, d, day))
    return FT.interval_features(intervals, cut(weather(spark, d), "weather"))


def daily(spark, d) -> DataFrame:
    return FT.daily_features(silver(spark, d))


def bronze(spark, d, dirty: bool = False) -> DataFrame:
    raw = X.dirty_raw_view(spark, d) if dirty else X.raw_meter_view(spark, d)
    return I.to_bronze(raw).drop("loaded_at")


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Cut the lineage with a Parquet table in the session's shared checkpoint
    folder: later passes (statistics, scoring, per-cluster maxima) re-read it
    instead of recomputing the plan, and a lost executor costs only a re-read.
    (``DataFrame.checkpoint`` would compute the plan twice: once for its
    eager count and once more to write the checkpoint files.)"""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def staged(spark, d) -> DataFrame:
    """Silver intervals written once to the shared folder for the passes below."""
    return cut(silver(spark, d), "silver")


def fitted(spark, d, s: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """Imputed features of the staged silver table and the fitted scaler."""
    return M.fit_features(s if s is not None else staged(spark, d))


def features(spark, d) -> DataFrame:
    return fitted(spark, d)[0]


def zscores(spark, d, s: DataFrame | None = None) -> DataFrame:
    feats, fit = fitted(spark, d, s)
    return M.standardize(feats, stats=fit)


def scored(spark, d, s: DataFrame | None = None) -> DataFrame:
    """Scoring is a literal projection over staged silver: cheaper to redo per
    pass than to write out."""
    return M.assign_cluster(zscores(spark, d, s), X.fixed_centroids(spark))


def mapping(spark, d, sc: DataFrame | None = None) -> DataFrame:
    return M.map_clusters(M.centroids_original_units(sc if sc is not None else scored(spark, d)))


def labeled(spark, d, s: DataFrame | None = None) -> DataFrame:
    sc = scored(spark, d, s)
    clusters = M.cluster_table(sc)                       # D8 + D11 in one pass, k rows
    lab = A.label_appliance(sc, M.map_clusters(clusters))
    return A.confidence(A.max_distance_per_cluster(lab, clusters))


def gold(spark, d, s: DataFrame | None = None) -> DataFrame:
    return A.estimate_daily(labeled(spark, d, s))


def summary(spark, d) -> DataFrame:
    s = staged(spark, d)
    return E.daily_summary(gold(spark, d, s), s)


def bands(spark, d) -> DataFrame:
    return B.load_bands(silver(spark, d))


def _files(spark, d) -> DataFrame:
    return X.file_view(spark, d).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))


def _loaded_files(spark, d) -> DataFrame:
    return _files(spark, d).where(F.col("source_file") < F.lit(LOADED_BEFORE_FILE))


# --- 2.1 sources, parsing, ingest ----------------------------------------------

def q_clean_esiid(spark, d):
    r = X.dirty_raw_view(spark, d)
    return r.select("source_file", F.col("ESIID").alias("raw_esiid"), P.clean_esiid("ESIID").alias("esiid"))


def q_trim_times(spark, d):
    r = I.trim_times(X.raw_meter_view(spark, d))
    return r.select("source_file", F.col("USAGE_START_TIME").alias("interval_start"),
                    F.col("USAGE_END_TIME").alias("interval_end"))


def q_parse_usage_date(spark, d):
    r = X.dirty_raw_view(spark, d)
    return r.select("source_file", F.col("USAGE_DATE").alias("raw_usage_date"),
                    P.parse_usage_date("USAGE_DATE").alias("usage_date"),
                    P.bad_usage_date("USAGE_DATE").alias("bad_date"))


def q_parse_revision_ts(spark, d):
    r = X.raw_meter_view(spark, d)
    return r.select("source_file", F.col("REVISION_DATE").alias("raw_revision_date"),
                    P.parse_revision_ts("REVISION_DATE").alias("revision_date"))


def q_build_interval_start(spark, d):
    r = X.raw_meter_view(spark, d)
    day = P.parse_usage_date("USAGE_DATE")
    return r.select("source_file", day.alias("usage_date"), P.trim_time("USAGE_START_TIME").alias("interval_start"),
                    P.build_interval_start(day, P.trim_time("USAGE_START_TIME")).alias("interval_start_dt"))


def q_coerce_kwh(spark, d):
    r = X.dirty_raw_view(spark, d)
    return r.select("source_file", F.col("USAGE_KWH").alias("raw_kwh"), P.coerce_kwh("USAGE_KWH").alias("usage_kwh"))


def q_to_bronze(spark, d):
    return bronze(spark, d)


def q_read_station_readings(spark, d):
    return readings(spark, d)


def q_filter_flow(spark, d):
    return I.filter_flow(bronze(spark, d)).select("esiid", "interval_start_dt", "usage_kwh", "flow_direction")


def q_new_files_only(spark, d):
    return I.new_files_only(_files(spark, d), _loaded_files(spark, d))


def q_quarantine_bad_files(spark, d):
    return I.quarantine_bad_files(X.dirty_raw_view(spark, d))


def q_ingest_report(spark, d):
    return I.ingest_report(X.dirty_raw_view(spark, d), _loaded_files(spark, d))


# --- 2.2 data quality -----------------------------------------------------------

def q_check_interval_count(spark, d):
    return Q.check_interval_count(bronze(spark, d, dirty=True))


def q_check_null_kwh(spark, d):
    return Q.check_null_kwh(bronze(spark, d, dirty=True))


def q_check_negative_kwh(spark, d):
    return Q.check_negative_kwh(bronze(spark, d, dirty=True))


def q_check_duplicates(spark, d):
    return Q.check_duplicates(bronze(spark, d, dirty=True))


def q_quality_report(spark, d):
    return Q.quality_report(bronze(spark, d, dirty=True))


def q_missing_weather_count(spark, d):
    return Q.missing_weather_count(silver(spark, d))


def q_reconcile_totals(spark, d):
    s = staged(spark, d)
    return Q.reconcile_totals(gold(spark, d, s), FT.daily_features(s))


def q_hvac_temperature_response(spark, d):
    s = staged(spark, d)
    return Q.hvac_temperature_response(gold(spark, d, s), s)


def q_table_stats(spark, d):
    return Q.table_stats(silver(spark, d))


def q_weather_stats(spark, d):
    return Q.weather_stats(weather(spark, d))


def q_summary_stats(spark, d):
    return Q.summary_stats(summary(spark, d))


def q_daily_kwh_range(spark, d):
    return Q.daily_kwh_range(X.meter_view(spark, d))


# --- 2.3 weather ------------------------------------------------------------------

def q_last_of_hour(spark, d):
    return W.last_of_hour(readings(spark, d))


def q_hourly_spine(spark, d):
    return W.hourly_spine(W.last_of_hour(readings(spark, d)))


def q_interpolate_linear(spark, d):
    return W.interpolate_linear(W.hourly_spine(W.last_of_hour(readings(spark, d))))


def q_round_half_even(spark, d):
    r = readings(spark, d)
    return r.select("reading_ts", "temp_c", N.round_half_even("temp_c", 1).alias("temp_c_1dp"))


def q_dedupe_hour(spark, d):
    r = readings(spark, d).select(F.col("reading_ts").alias("datetime"), "temp_c")
    return W.dedupe_hour(r)


def q_daily_hour_grid(spark, d):
    return W.daily_hour_grid(W.last_of_hour(readings(spark, d)))


def q_cooling_load_kw(spark, d):
    return weather(spark, d).select("datetime", "temp_c", N.cooling_load_kw("temp_c").alias("cooling_kw"))


def q_expected_cooling_kwh(spark, d):
    s = silver(spark, d)
    return s.select("esiid", "interval_start_dt", "temp_c",
                    N.expected_cooling_kwh("temp_c", "hour_of_day").alias("expected_cooling_kwh"))


def q_celsius_to_fahrenheit(spark, d):
    return weather(spark, d).select("datetime", "temp_c", N.celsius_to_fahrenheit("temp_c").alias("temp_f"))


# --- 2.4 silver -------------------------------------------------------------------

def _calendar(fn, name):
    def q(spark, d):
        m = X.meter_view(spark, d)
        return m.select("esiid", "interval_start_dt", fn("interval_start_dt").alias(name))
    return q


def q_join_weather(spark, d):
    m = I.filter_flow(X.meter_view(spark, d))
    return FT.join_weather(m, W.dedupe_hour(cut(weather(spark, d), "weather"))).select("esiid", "interval_start_dt", "hour_dt",
                                                                       "temp_c")


def q_ac_proxy(spark, d):
    return silver(spark, d).select("esiid", "interval_start_dt", "temp_c",
                                   FT.ac_proxy("temp_c").alias("ac_proxy"))


def q_interval_features(spark, d):
    return silver(spark, d)


def q_daily_features(spark, d):
    return daily(spark, d)


def q_peak_ratio(spark, d):
    return daily(spark, d).select("esiid", "usage_date", "peak_kwh", "total_kwh", "peak_ratio")


def q_append_new_dates(spark, d):
    dl = daily(spark, d)
    target = dl.where(F.col("usage_date") < F.lit(LOADED_BEFORE).cast("date"))
    return FT.append_new_dates(target, dl)


# --- 2.5 disaggregation -------------------------------------------------------------

def q_cyclical_hour(spark, d):
    return M.cyclical_hour(silver(spark, d)).select("esiid", "interval_start_dt", "hour_of_day", "hour_sin",
                                                    "hour_cos")


def q_ac_proxy_int(spark, d):
    return M.ac_proxy_int(silver(spark, d)).select("esiid", "interval_start_dt", "ac_proxy", "ac_proxy_int")


def q_impute_mean(spark, d):
    return features(spark, d).select("esiid", "interval_start_dt", "temp_raw", "temp_c")


def q_standardize(spark, d):
    return zscores(spark, d).select("esiid", "interval_start_dt", *[f"z_{c}" for c in M.FEATURES])


def q_fit_clusters(spark, d):
    """The centroids depend on the starts; that they are a fixpoint of k-means over all rows does not."""
    z = cut(zscores(spark, d), "zscores")
    return M.clusters_certificate(z, M.fit_clusters(z)[0])


def q_assign_cluster(spark, d):
    return scored(spark, d).select("esiid", "interval_start_dt", "cluster", "distance")


def q_distance_to_centroid(spark, d):
    sc = scored(spark, d).drop("distance")
    return M.distance_to_centroid(sc, X.fixed_centroids(spark)).select("esiid", "interval_start_dt", "cluster",
                                                                      "distance")


def q_centroids_original_units(spark, d):
    return M.centroids_original_units(scored(spark, d))


def q_map_clusters(spark, d):
    return mapping(spark, d)


def q_label_appliance(spark, d):
    sc = scored(spark, d)
    return A.label_appliance(sc, mapping(spark, d, sc)).select("esiid", "interval_start_dt", "cluster", "appliance")


def q_max_distance_per_cluster(spark, d):
    return A.max_distance_per_cluster(scored(spark, d)).select("esiid", "interval_start_dt", "cluster", "distance",
                                                              "max_distance")


def q_confidence(spark, d):
    return labeled(spark, d).select("esiid", "interval_start_dt", "appliance", "distance", "confidence")


def q_estimate_daily(spark, d):
    return gold(spark, d)


def q_cluster_diagnostics(spark, d):
    return A.cluster_diagnostics(labeled(spark, d))


def q_appliance_share(spark, d):
    s = staged(spark, d)
    return A.appliance_share(gold(spark, d, s), FT.daily_features(s))


def q_mean_confidence_by_appliance(spark, d):
    return A.mean_confidence_by_appliance(gold(spark, d))


def q_first_day_estimates(spark, d):
    return A.first_day_estimates(cut(gold(spark, d), "gold"))


def q_model_metrics(spark, d):
    s = staged(spark, d)
    return A.model_metrics(cut(gold(spark, d, s), "gold"), A.training_cost(scored(spark, d, s)))


def q_persist_model(spark, d):
    feats, fit = fitted(spark, d)
    stats = M.scaler_table(spark, fit)
    cents = X.fixed_centroids(spark)
    sc0 = M.assign_cluster(M.standardize(feats, stats=stats), cents)
    base = M.persist_model(spark, scratch_path(spark, "model"), cents, stats, M.label_table(M.cluster_table(sc0)), "v1")
    c2, s2, m2 = M.load_model(spark, base)
    sc = M.assign_cluster(M.standardize(feats, stats=s2), c2)
    return A.estimate_daily(A.confidence(A.max_distance_per_cluster(A.label_appliance(sc, m2), m2)))


# --- 2.6 export -------------------------------------------------------------------

def q_appliance_profile(spark, d):
    return E.appliance_profile(gold(spark, d))


def q_daily_temperature(spark, d):
    return E.daily_temperature(silver(spark, d))


def q_daily_summary(spark, d):
    return summary(spark, d)


def q_daily_summary_with_confidence(spark, d):
    return E.daily_summary_with_confidence(gold(spark, d))


def q_write_table(spark, d):
    path = scratch_path(spark, "gold")
    write_table(gold(spark, d), path, partition_by="usage_date")
    return spark.read.parquet(path).select("esiid", "usage_date", "appliance", "estimated_kwh", "confidence")


def q_reset_table(spark, d):
    path = scratch_path(spark, "silver-daily")
    write_table(daily(spark, d).where(F.col("usage_date") < F.lit(LOADED_BEFORE).cast("date")), path,
                partition_by="usage_date")
    reset_table(spark, path, daily(spark, d), partition_by="usage_date")
    return spark.read.parquet(path).select("esiid", "usage_date", "total_kwh", "peak_kwh", "offpeak_kwh",
                                           "peak_ratio", "max_interval_kwh")


def q_write_csv(spark, d):
    path = scratch_path(spark, "summary-csv")
    write_csv(summary(spark, d), path)
    return read_summary_csv(spark, path)


def q_format_meter_export(spark, d):
    return X.raw_meter_view(spark, d)


def q_expand_runs_to_intervals(spark, d):
    return E.expand_runs_to_intervals(X.runs_view(spark, d))


# --- 2.7 dashboard ------------------------------------------------------------------

def q_day_intervals(spark, d):
    return B.day_intervals(silver(spark, d, DAY), DAY)


def q_date_bounds(spark, d):
    return B.date_bounds(summary(spark, d))


def q_filter_dates(spark, d):
    return B.filter_dates(summary(spark, d), *RANGE)


def q_fill_day_mean_temp(spark, d):
    return B.fill_day_mean_temp(silver(spark, d)).select("esiid", "interval_start_dt", "temp_c")


def _band(name):
    def q(spark, d):
        return bands(spark, d).select("esiid", "interval_start_dt", "usage_kwh", name)
    return q


def q_scale_to_headroom(spark, d):
    s = B.fill_day_mean_temp(silver(spark, d))
    k, h, t = "usage_kwh", "hour_of_day", "temp_c"
    base = BF.band_baseline(k)
    vsum = BF.band_hvac(k, h, t) + BF.band_morning(k, h) + BF.band_cooking(k, h) + BF.band_washer(k, h) \
        + BF.band_dryer(k, h)
    return s.select("esiid", "interval_start_dt", k, BF.scale_to_headroom(k, base, vsum).alias("scale"))


def q_load_bands(spark, d):
    return bands(spark, d)


def q_bands_long(spark, d):
    return B.bands_long(bands(spark, d))


def q_breakdown_long(spark, d):
    return R.breakdown_long(summary(spark, d))


def q_average_attribution(spark, d):
    return R.average_attribution(cut(summary(spark, d), "summary"))


def q_total_metrics(spark, d):
    return R.total_metrics(B.filter_dates(summary(spark, d), *RANGE))


def q_hvac_vs_temperature(spark, d):
    return R.hvac_vs_temperature(summary(spark, d), "F")


def q_days_above_threshold(spark, d):
    return R.days_above_threshold(summary(spark, d), "F")


def q_day_header(spark, d):
    return R.day_header(silver(spark, d), "C")


# --- 2.8 pipelines ------------------------------------------------------------------

def q_build_weather(spark, d):
    return weather(spark, d)


def _pipeline(name):
    def q(spark, d):
        from loadsplit.plans import pipeline as PL
        return getattr(PL, f"demo_{name}")(spark, d)
    return q


QUERIES: dict[str, Query] = {
    # 2.1
    "clean_esiid": q_clean_esiid,
    "trim_times": q_trim_times,
    "parse_usage_date": q_parse_usage_date,
    "parse_revision_ts": q_parse_revision_ts,
    "build_interval_start": q_build_interval_start,
    "coerce_kwh": q_coerce_kwh,
    "to_bronze": q_to_bronze,
    "read_station_readings": q_read_station_readings,
    "filter_flow": q_filter_flow,
    "new_files_only": q_new_files_only,
    "quarantine_bad_files": q_quarantine_bad_files,
    "ingest_report": q_ingest_report,
    # 2.2
    "check_interval_count": q_check_interval_count,
    "check_null_kwh": q_check_null_kwh,
    "check_negative_kwh": q_check_negative_kwh,
    "check_duplicates": q_check_duplicates,
    "quality_report": q_quality_report,
    "missing_weather_count": q_missing_weather_count,
    "reconcile_totals": q_reconcile_totals,
    "hvac_temperature_response": q_hvac_temperature_response,
    "table_stats": q_table_stats,
    "weather_stats": q_weather_stats,
    "summary_stats": q_summary_stats,
    "daily_kwh_range": q_daily_kwh_range,
    # 2.3
    "last_of_hour": q_last_of_hour,
    "hourly_spine": q_hourly_spine,
    "interpolate_linear": q_interpolate_linear,
    "round_half_even": q_round_half_even,
    "dedupe_hour": q_dedupe_hour,
    "daily_hour_grid": q_daily_hour_grid,
    "cooling_load_kw": q_cooling_load_kw,
    "expected_cooling_kwh": q_expected_cooling_kwh,
    "celsius_to_fahrenheit": q_celsius_to_fahrenheit,
    # 2.4
    "hour_of_day": _calendar(C.hour_of_day, "hour_of_day"),
    "day_of_week": _calendar(C.day_of_week, "day_of_week"),
    "is_weekend": _calendar(C.is_weekend, "is_weekend"),
    "is_peak": _calendar(C.is_peak, "is_peak"),
    "hour_floor": _calendar(C.hour_floor, "hour_dt"),
    "join_weather": q_join_weather,
    "ac_proxy": q_ac_proxy,
    "interval_features": q_interval_features,
    "daily_features": q_daily_features,
    "peak_ratio": q_peak_ratio,
    "append_new_dates": q_append_new_dates,
    # 2.5
    "cyclical_hour": q_cyclical_hour,
    "ac_proxy_int": q_ac_proxy_int,
    "impute_mean": q_impute_mean,
    "standardize": q_standardize,
    "fit_clusters": q_fit_clusters,
    "assign_cluster": q_assign_cluster,
    "distance_to_centroid": q_distance_to_centroid,
    "centroids_original_units": q_centroids_original_units,
    "map_clusters": q_map_clusters,
    "label_appliance": q_label_appliance,
    "max_distance_per_cluster": q_max_distance_per_cluster,
    "confidence": q_confidence,
    "estimate_daily": q_estimate_daily,
    "cluster_diagnostics": q_cluster_diagnostics,
    "appliance_share": q_appliance_share,
    "mean_confidence_by_appliance": q_mean_confidence_by_appliance,
    "first_day_estimates": q_first_day_estimates,
    "model_metrics": q_model_metrics,
    "persist_model": q_persist_model,
    # 2.6
    "appliance_profile": q_appliance_profile,
    "daily_temperature": q_daily_temperature,
    "daily_summary": q_daily_summary,
    "daily_summary_with_confidence": q_daily_summary_with_confidence,
    "write_table": q_write_table,
    "reset_table": q_reset_table,
    "write_csv": q_write_csv,
    "format_meter_export": q_format_meter_export,
    "expand_runs_to_intervals": q_expand_runs_to_intervals,
    # 2.7
    "day_intervals": q_day_intervals,
    "date_bounds": q_date_bounds,
    "filter_dates": q_filter_dates,
    "fill_day_mean_temp": q_fill_day_mean_temp,
    "band_baseline": _band("baseline"),
    "band_hvac": _band("hvac"),
    "band_morning": _band("morning"),
    "band_cooking": _band("cooking"),
    "band_washer": _band("washer"),
    "band_dryer": _band("dryer"),
    "scale_to_headroom": q_scale_to_headroom,
    "band_other": _band("other"),
    "load_bands": q_load_bands,
    "bands_long": q_bands_long,
    "breakdown_long": q_breakdown_long,
    "average_attribution": q_average_attribution,
    "total_metrics": q_total_metrics,
    "hvac_vs_temperature": q_hvac_vs_temperature,
    "days_above_threshold": q_days_above_threshold,
    "day_header": q_day_header,
    # 2.8
    "build_weather": q_build_weather,
    "read_meter_csv": _pipeline("read_meter_csv"),
    "run_ingest": _pipeline("run_ingest"),
    "reload_replaced_files": _pipeline("reload_replaced_files"),
    "ingest_incremental": _pipeline("ingest_incremental"),
    "run_features": _pipeline("run_features"),
    "run_disaggregate": _pipeline("run_disaggregate"),
    "run_export": _pipeline("run_export"),
    "run_all": _pipeline("run_all"),
    "run_incremental": _pipeline("run_incremental"),
    "read_snapshot": _pipeline("read_snapshot"),
}
