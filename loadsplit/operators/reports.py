"""Dashboard reports over the daily summary and one day's intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsplit.constants import AC_PROXY_TEMP_C, FAHRENHEIT_AC_THRESHOLD, SUMMARY_APPLIANCE_COLUMNS
from loadsplit.functions.numeric import celsius_to_fahrenheit, exact_avg, exact_sum, round_half_up


def breakdown_long(daily: DataFrame) -> DataFrame:
    """Five ``*_kwh`` columns -> (usage_date, appliance, kwh)."""
    long = daily.unpivot(["usage_date"], list(SUMMARY_APPLIANCE_COLUMNS), "appliance", "kwh")
    return long.withColumn("appliance", F.regexp_replace("appliance", "_kwh$", ""))


def average_attribution(daily: DataFrame) -> DataFrame:
    """Mean kWh per appliance (2 dp) and share of the sum of means (% 1 dp)."""
    per = breakdown_long(daily).groupBy("appliance").agg(round_half_up(exact_avg("kwh"), 6).alias("avg_kwh"))
    total = per.select(exact_sum("avg_kwh")).scalar()
    return (per.select("appliance", round_half_up("avg_kwh", 2).alias("avg_kwh_day"),
                       round_half_up(F.col("avg_kwh") / total * 100, 1).alias("share_pct"))
            .orderBy(F.col("avg_kwh_day").desc(), "appliance"))


def total_metrics(daily: DataFrame) -> DataFrame:
    """Mean / max / min of total_kwh over the selected days."""
    return daily.agg(
        round_half_up(exact_avg("total_kwh"), 6).alias("avg_kwh_day"),
        F.max("total_kwh").alias("max_kwh_day"),
        F.min("total_kwh").alias("min_kwh_day"),
        F.count(F.lit(1)).alias("n_days"),
    )


def display_temp(col, unit: str = "C"):
    """Temperature in the dashboard's unit (W9 for Fahrenheit)."""
    c = F.col(col) if isinstance(col, str) else col
    return celsius_to_fahrenheit(c) if unit.upper().startswith("F") else c


def hvac_vs_temperature(daily: DataFrame, unit: str = "C") -> DataFrame:
    """(display temperature, hvac kWh, date, total) per day."""
    return daily.select("usage_date", display_temp("avg_temp_c", unit).alias("avg_temp_display"),
                        "hvac_kwh", "total_kwh")


def days_above_threshold(daily: DataFrame, unit: str = "C") -> DataFrame:
    """Days whose mean temperature is above 23 C (73.4 F)."""
    thr = FAHRENHEIT_AC_THRESHOLD if unit.upper().startswith("F") else AC_PROXY_TEMP_C
    return daily.agg(F.count_if(display_temp("avg_temp_c", unit) > thr).alias("days_above"),
                     F.count(F.lit(1)).alias("n_days"))


def day_header(intervals: DataFrame, unit: str = "C") -> DataFrame:
    """Per date the total kWh and the mean temperature (either unit)."""
    return intervals.groupBy(F.to_date("interval_start_dt").alias("usage_date")).agg(
        exact_sum("usage_kwh").alias("day_total_kwh"),
        round_half_up(display_temp(exact_avg("temp_c"), unit), 6).alias("avg_temp_display"),
    )
