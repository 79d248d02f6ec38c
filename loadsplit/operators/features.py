"""Silver interval features and the daily rollup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsplit.constants import AC_PROXY_TEMP_C
from loadsplit.functions import calendar as C
from loadsplit.functions.numeric import exact_sum


def join_weather(intervals: DataFrame, weather: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """F5 + F6: left equi-join on the top of the hour (and the station ``keys``,
    which both sides then have); unmatched temp is null.

    Hourly weather is hours x stations. Read from a stored table its size is
    known when the join is planned, and the optimizer's own threshold decides.
    """
    w = weather.select(*keys, F.col("datetime").alias("hour_dt"), F.col("temp_c"))
    return intervals.withColumn("hour_dt", C.hour_floor("interval_start_dt")).join(w, [*keys, "hour_dt"], "left")


def ac_proxy(temp="temp_c"):
    """cooling flag, temp > 23 C; a missing temperature counts as false."""
    t = F.col(temp) if isinstance(temp, str) else temp
    return F.coalesce(t > AC_PROXY_TEMP_C, F.lit(False))


def interval_features(intervals: DataFrame, weather: DataFrame, keys: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """F8: F1-F7 composed, the 9-column silver layout (and the columns named in ``keep``)."""
    j = join_weather(intervals, weather, keys)
    ts = F.col("interval_start_dt")
    return j.select(
        F.col("esiid"),
        ts,
        F.col("usage_kwh").cast("double").alias("usage_kwh"),
        C.hour_of_day(ts).alias("hour_of_day"),
        C.day_of_week(ts).alias("day_of_week"),
        C.is_weekend(ts).alias("is_weekend"),
        C.is_peak(ts).alias("is_peak"),
        F.col("temp_c"),
        ac_proxy("temp_c").alias("ac_proxy"),
        *keep,
    )


def peak_ratio(peak, total):
    """peak / total, null when the total is not positive (no ANSI error)."""
    return F.when(F.col(total) > 0, F.col(peak) / F.col(total))


def daily_features(features: DataFrame) -> DataFrame:
    """F9 + F10: one row per (meter, day); all-null sums are 0 (pandas)."""
    kwh = F.col("usage_kwh")
    peak = F.col("is_peak") if "is_peak" in features.columns else C.is_peak("interval_start_dt")
    daily = features.groupBy("esiid", F.to_date("interval_start_dt").alias("usage_date")).agg(
        F.coalesce(exact_sum(kwh), F.lit(0.0)).alias("total_kwh"),
        F.coalesce(exact_sum(F.when(peak, kwh)), F.lit(0.0)).alias("peak_kwh"),
        F.coalesce(exact_sum(F.when(~peak, kwh)), F.lit(0.0)).alias("offpeak_kwh"),
        F.max(kwh).alias("max_interval_kwh"),
    )
    return daily.select("esiid", "usage_date", "total_kwh", "peak_kwh", "offpeak_kwh",
                        peak_ratio("peak_kwh", "total_kwh").alias("peak_ratio"), "max_interval_kwh")


def append_new_dates(target: DataFrame, df: DataFrame, keys: Sequence[str] = ("esiid", "usage_date")) -> DataFrame:
    """rows of ``df`` whose key is absent from ``target`` (what to append);
    null keys are equal to each other."""
    done = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys]).distinct()
    return df.join(done, [df[k].eqNullSafe(done[f"_t_{k}"]) for k in keys], "left_anti")
