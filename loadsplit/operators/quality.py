"""Q1-Q10: data-quality checks. Warn only: nothing here drops or alters rows.

Per-file counts use two hash aggregates (file, key) -> file; both combine
map-side, so a file holding a third of all rows is still split across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadsplit import constants as K
from loadsplit.constants import INTERVALS_PER_DAY
from loadsplit.functions.numeric import exact_avg, exact_sum, round_half_up


def _per_file_keys(df: DataFrame) -> DataFrame:
    """One row per (source_file, esiid, interval_start_dt); null keys group together."""
    return df.groupBy("source_file", "esiid", "interval_start_dt").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("usage_kwh").isNull()).alias("n_null"),
        F.count_if(F.col("usage_kwh") < 0).alias("n_neg"),
    )


def file_checks(df: DataFrame) -> DataFrame:
    """Q1-Q4 as numbers: per file rows, null kWh, negative kWh, duplicates."""
    return _per_file_keys(df).groupBy("source_file").agg(
        F.sum("n").alias("n_intervals"),
        F.sum("n_null").alias("null_kwh"),
        F.sum("n_neg").alias("negative_kwh"),
        F.sum(F.col("n") - 1).alias("duplicate_intervals"),
    )


def check_interval_count(df: DataFrame, expected: int = INTERVALS_PER_DAY) -> DataFrame:
    """Q1: files whose row count differs from ``expected``."""
    counts = df.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_intervals"))
    return counts.where(F.col("n_intervals") != expected)


def check_null_kwh(df: DataFrame) -> DataFrame:
    """Q2: null kWh per file (files with at least one)."""
    return (df.groupBy("source_file").agg(F.count_if(F.col("usage_kwh").isNull()).alias("null_kwh"))
            .where(F.col("null_kwh") > 0))


def check_negative_kwh(df: DataFrame) -> DataFrame:
    """Q3: negative kWh per file (files with at least one)."""
    return (df.groupBy("source_file").agg(F.count_if(F.col("usage_kwh") < 0).alias("negative_kwh"))
            .where(F.col("negative_kwh") > 0))


def check_duplicates(df: DataFrame) -> DataFrame:
    """Q4: rows beyond the first per (esiid, interval_start_dt) within a file."""
    return (_per_file_keys(df).groupBy("source_file")
            .agg(F.sum(F.col("n") - 1).alias("duplicate_intervals"))
            .where(F.col("duplicate_intervals") > 0))


def quality_report(df: DataFrame, expected: int = INTERVALS_PER_DAY) -> DataFrame:
    """Q5: Q1-Q4 in one row per file plus the issue text joined by '; '."""
    c = file_checks(df)
    issues = F.concat_ws(
        K.ISSUE_SEPARATOR,
        F.when(F.col("n_intervals") != expected,
               F.format_string(K.ISSUE_INTERVAL_COUNT.format(expected=expected), F.col("n_intervals"))),
        F.when(F.col("null_kwh") > 0, F.format_string(K.ISSUE_NULL_KWH, F.col("null_kwh"))),
        F.when(F.col("negative_kwh") > 0, F.format_string(K.ISSUE_NEGATIVE_KWH, F.col("negative_kwh"))),
        F.when(F.col("duplicate_intervals") > 0, F.format_string(K.ISSUE_DUPLICATES, F.col("duplicate_intervals"))),
    )
    return c.withColumn("issues", issues)


def missing_weather_count(interval_features: DataFrame) -> DataFrame:
    """Q6: silver rows without a temperature."""
    return interval_features.agg(
        F.count(F.lit(1)).alias("n_intervals"),
        F.count_if(F.col("temp_c").isNull()).alias("missing_temp"),
    )


def reconcile_totals(gold: DataFrame, daily: DataFrame) -> DataFrame:
    """Q7: attributed kWh per meter-day against the silver daily total."""
    g = gold.groupBy("esiid", "usage_date").agg(exact_sum("estimated_kwh").alias("attributed_kwh"))
    d = daily.select("esiid", "usage_date", F.col("total_kwh").alias("silver_kwh"))
    j = g.join(d, ["esiid", "usage_date"], "full_outer")
    return j.withColumn(
        "diff_kwh", round_half_up(F.coalesce("attributed_kwh", F.lit(0.0)) - F.coalesce("silver_kwh", F.lit(0.0)), 6))


def hvac_temperature_response(gold: DataFrame, interval_features: DataFrame, step: float = 2.0) -> DataFrame:
    """Q8: mean HVAC kWh per meter-day by daily-temperature bucket, with the
    change from the previous bucket (the response should rise)."""
    day_temp = (interval_features
                .groupBy("esiid", F.to_date("interval_start_dt").alias("usage_date"))
                .agg(exact_avg("temp_c").alias("avg_temp_c"))
                .where(F.col("avg_temp_c").isNotNull()))
    hvac = (gold.groupBy("esiid", "usage_date")
            .agg(exact_sum(F.when(F.col("appliance") == "hvac", F.col("estimated_kwh")).otherwise(F.lit(0.0)))
                 .alias("hvac_kwh")))
    days = day_temp.join(hvac, ["esiid", "usage_date"], "inner")
    buckets = (days.groupBy((F.floor(F.col("avg_temp_c") / step) * step).alias("temp_bucket"))
               .agg(F.count(F.lit(1)).alias("n_days"),
                    round_half_up(exact_avg("hvac_kwh"), 6).alias("mean_hvac_kwh")))
    # one row per bucket: a handful of rows, so a single ordered window is fine
    w = Window.orderBy("temp_bucket")
    prev = F.lag("mean_hvac_kwh").over(w)
    return buckets.withColumn("delta_kwh", round_half_up(F.col("mean_hvac_kwh") - prev, 6))


def table_stats(df: DataFrame, ts_col: str = "interval_start_dt") -> DataFrame:
    """Q9: rows, distinct days, distinct meters."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.to_date(ts_col)).alias("n_days"),
        F.count_distinct("esiid").alias("n_meters"),
    )


def weather_stats(weather: DataFrame) -> DataFrame:
    """Q9 (weather part): count, min and max temperature, time range."""
    return weather.agg(
        F.count(F.lit(1)).alias("n_hours"),
        F.min("temp_c").alias("min_temp_c"),
        F.max("temp_c").alias("max_temp_c"),
        F.min("datetime").alias("first_hour"),
        F.max("datetime").alias("last_hour"),
    )


def summary_stats(summary: DataFrame) -> DataFrame:
    """Q9 (summary part): days and the range of daily mean temperatures."""
    return summary.agg(
        F.count(F.lit(1)).alias("n_days"),
        F.min("avg_temp_c").alias("min_avg_temp_c"),
        F.max("avg_temp_c").alias("max_avg_temp_c"),
    )


def daily_kwh_range(df: DataFrame, day_col: str = "usage_date", kwh_col: str = "usage_kwh") -> DataFrame:
    """Q10: min / max / mean of per-day totals."""
    per_day = df.groupBy(day_col).agg(exact_sum(kwh_col).alias("day_kwh"))
    return per_day.agg(
        F.count(F.lit(1)).alias("n_days"),
        F.min("day_kwh").alias("min_day_kwh"),
        F.max("day_kwh").alias("max_day_kwh"),
        round_half_up(exact_avg("day_kwh"), 6).alias("avg_day_kwh"),
    )
