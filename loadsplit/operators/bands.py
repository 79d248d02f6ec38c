"""The dashboard's interval view and rule-based load bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsplit.functions import bands as B
from loadsplit.functions.numeric import exact_avg


def day_intervals(interval_features: DataFrame, date: str) -> DataFrame:
    """B1: one date's intervals ordered by time. On a table partitioned by
    ``usage_date`` the filter prunes partitions; on intervals with a stored
    timestamp its range reaches the scan."""
    ts = F.col("interval_start_dt")
    lo = F.to_timestamp_ntz(F.lit(date))
    hi = F.to_timestamp_ntz(F.date_add(F.lit(date).cast("date"), 1).cast("string"))
    if "usage_date" in interval_features.columns:      # stage table: prune partitions
        interval_features = interval_features.where(F.col("usage_date") == F.lit(date).cast("date"))
    return (interval_features.where((ts >= lo) & (ts < hi))
            .select("esiid", "interval_start_dt", "usage_kwh", "hour_of_day", "temp_c")
            .orderBy("interval_start_dt", "esiid"))


def date_bounds(df: DataFrame, col: str = "usage_date") -> DataFrame:
    """B2: first and last date."""
    return df.agg(F.min(col).alias("date_min"), F.max(col).alias("date_max"))


def filter_dates(df: DataFrame, start: str, end: str, col: str = "usage_date") -> DataFrame:
    """B2: inclusive date range."""
    return df.where(F.col(col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def fill_day_mean_temp(df: DataFrame) -> DataFrame:
    """Null temperature -> mean of that meter-day's temperatures.

    The means are an aggregate (map-side combined, skew-safe) of the meter-days
    that have a null; only the rows with a null are joined to it, all others
    pass by."""
    day = F.to_date("interval_start_dt")
    means = df.groupBy("esiid", day.alias("_day")) \
        .agg(exact_avg("temp_c").alias("_day_temp"), F.count_if(F.col("temp_c").isNull()).alias("_n")).where("_n > 0").drop("_n")
    empty = df.where(F.col("temp_c").isNull()).withColumn("_day", day)
    filled = empty.join(means, empty["esiid"].eqNullSafe(means["esiid"]) & empty["_day"].eqNullSafe(means["_day"]), "left") \
        .withColumn("temp_c", F.col("_day_temp")).select(*[empty[c] if c != "temp_c" else F.col("_day_temp").alias("temp_c") for c in df.columns])
    return df.where(F.col("temp_c").isNotNull()).unionByName(filled)


def load_bands(df: DataFrame, fill_temp: bool = True) -> DataFrame:
    """B3-B11 composed; 11 columns (+ esiid)."""
    if fill_temp:
        df = fill_day_mean_temp(df)
    k, h, t = "usage_kwh", "hour_of_day", "temp_c"
    raw = df.select(
        "esiid", "interval_start_dt", k, h, t,
        B.band_baseline(k).alias("baseline"),
        B.band_hvac(k, h, t).alias("hvac"),
        B.band_morning(k, h).alias("morning"),
        B.band_cooking(k, h).alias("cooking"),
        B.band_washer(k, h).alias("washer"),
        B.band_dryer(k, h).alias("dryer"),
    )
    vsum = F.col("hvac") + F.col("morning") + F.col("cooking") + F.col("washer") + F.col("dryer")
    scale = B.scale_to_headroom(k, "baseline", vsum)
    scaled = raw.select("esiid", "interval_start_dt", k, h, t, "baseline",
                        *[(F.col(b) * scale).alias(b) for b in B.VARIABLE_BANDS])
    other = B.band_other(k, "baseline", *B.VARIABLE_BANDS)
    nulls = F.col(k).isNull()
    return scaled.select(
        "esiid", "interval_start_dt", k, h, t, "baseline",
        *[F.when(~nulls, F.col(b)).alias(b) for b in B.VARIABLE_BANDS],
        F.when(~nulls, other).alias("other"),
    )


def bands_long(bands: DataFrame) -> DataFrame:
    """Seven band columns -> (interval, appliance, kwh)."""
    return bands.unpivot(["esiid", "interval_start_dt"],
                         ["baseline", "hvac", "washer", "dryer", "cooking", "morning", "other"],
                         "appliance", "kwh")
