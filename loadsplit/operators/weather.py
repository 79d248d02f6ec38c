"""Irregular station readings -> gap-free hourly series.

The hourly series is a dimension: its size is hours x stations, independent
of meter volume. Windows are partitioned by station (``keys``) or, for the
per-day grid, by (station, date).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadsplit.functions.calendar import hour_floor
from loadsplit.functions.numeric import round_half_even
from loadsplit.sources.meter_csv import read_station_readings


def last_of_hour(readings: DataFrame, keys: Sequence[str] = (), ts: str = "reading_ts",
                 value: str = "temp_c") -> DataFrame:
    """Last non-null reading of each clock hour (time ties -> larger value)."""
    r = readings.where(F.col(value).isNotNull() & F.col(ts).isNotNull())
    return r.groupBy(*keys, hour_floor(ts).alias("datetime")).agg(
        F.max_by(F.col(value), F.struct(F.col(ts), F.col(value))).alias("temp_c"))


def dedupe_hour(weather: DataFrame, keys: Sequence[str] = (), ts: str = "datetime",
                value: str = "temp_c") -> DataFrame:
    """Floor to the hour and keep the earliest row (ties -> smaller value)."""
    return weather.groupBy(*keys, hour_floor(ts).alias("datetime")).agg(
        F.min_by(F.col(value), F.struct(F.col(ts), F.col(value))).alias("temp_c"))


def hourly_spine(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every hour from the first to the last per station; gaps are null."""
    bounds = hourly.groupBy(*keys).agg(F.min("datetime").alias("lo"), F.max("datetime").alias("hi"))
    spine = bounds.select(*keys, F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias("datetime"))
    return spine.join(hourly, [*keys, "datetime"], "left")


def _fill(df: DataFrame, part: Sequence, value: str, ts: str, backward: bool) -> DataFrame:
    """Time-weighted linear fill of interior gaps, forward carry at the end and
    (optionally) backward carry at the start, within each ``part`` group."""
    v, t = F.col(value), F.col(ts)
    w = Window.partitionBy(*part).orderBy(ts)
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    known_t = F.when(v.isNotNull(), t)
    p_t, p_v = F.last(known_t, ignorenulls=True).over(before), F.last(v, ignorenulls=True).over(before)
    n_t, n_v = F.first(known_t, ignorenulls=True).over(after), F.first(v, ignorenulls=True).over(after)
    out = df.select("*", p_t.alias("_pt"), p_v.alias("_pv"), n_t.alias("_nt"), n_v.alias("_nv"))
    span = F.timestamp_diff("SECOND", F.col("_pt"), F.col("_nt")).cast("double")
    off = F.timestamp_diff("SECOND", F.col("_pt"), t).cast("double")
    slope = (F.col("_nv") - F.col("_pv")) / span
    filled = (F.when(v.isNotNull(), v)
              .when(F.col("_pt").isNotNull() & F.col("_nt").isNotNull(), slope * off + F.col("_pv"))
              .when(F.col("_pt").isNotNull(), F.col("_pv")))
    if backward:
        filled = filled.when(F.col("_nt").isNotNull(), F.col("_nv"))
    return out.withColumn(value, filled).drop("_pt", "_pv", "_nt", "_nv")


def interpolate_linear(df: DataFrame, keys: Sequence[str] = (), value: str = "temp_c",
                       ts: str = "datetime") -> DataFrame:
    """Pandas ``interpolate(method='time')``: interior gaps linear in time,
    trailing gaps carry the last value, leading gaps stay null."""
    return _fill(df, list(keys), value, ts, backward=False)


def daily_hour_grid(weather: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Exactly 24 hours per date; interior linear fill, then forward and
    backward fill at the day edges; values never cross a day boundary."""
    on_hour = weather.where((F.minute("datetime") == 0) & (F.second("datetime") == 0))
    days = weather.select(*keys, F.to_date("datetime").alias("usage_date")).distinct()
    grid = days.select(*keys, "usage_date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    grid = grid.select(*keys, "usage_date",
                       F.make_timestamp_ntz(F.year("usage_date"), F.month("usage_date"),
                                            F.dayofmonth("usage_date"), F.col("hour"), F.lit(0), F.lit(0))
                       .alias("datetime"))
    joined = grid.join(on_hour.select(*keys, "datetime", "temp_c"), [*keys, "datetime"], "left")
    return _fill(joined, [*keys, "usage_date"], "temp_c", "datetime", backward=True)


def fill_hours(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """W2 + W3 in one pass: each observed hour looks ahead to the next one
    (``lead``) and emits itself plus the missing hours in between, with the
    time-weighted linear value. Same result as ``interpolate_linear(
    hourly_spine(...))`` on a series whose ends are observed, without the
    spine join or the global min/max. Windows hold one station's year; a year's
    last hour looks at the first hour of the next year with readings."""
    own = hourly.withColumn("_y", F.year("datetime"))
    w = Window.partitionBy(*keys, "_y").orderBy("datetime")
    firsts = own.groupBy(*keys, "_y").agg(F.min("datetime").alias("_ft"), F.min_by("temp_c", "datetime").alias("_fv"))
    years = Window.partitionBy(*keys).orderBy("_y")      # one row per station and year
    after = firsts.select(*keys, "_y", F.lead("_ft").over(years).alias("_ft"), F.lead("_fv").over(years).alias("_fv"))
    nxt = own.select(*keys, "_y", "datetime", "temp_c",
                     F.lead("datetime").over(w).alias("_nt"), F.lead("temp_c").over(w).alias("_nv")) \
        .join(after, [*keys, "_y"], "left") \
        .select(*keys, "datetime", "temp_c", F.coalesce("_nt", "_ft").alias("_nt"),
                F.when(F.col("_nt").isNull(), F.col("_fv")).otherwise(F.col("_nv")).alias("_nv"))
    last = F.coalesce(F.col("_nt") - F.expr("INTERVAL 1 HOUR"), F.col("datetime"))
    rows = nxt.select(*keys, F.col("datetime").alias("_pt"), F.col("temp_c").alias("_pv"), "_nt", "_nv",
                      F.explode(F.sequence("datetime", last, F.expr("INTERVAL 1 HOUR"))).alias("datetime"))
    span = F.timestamp_diff("SECOND", F.col("_pt"), F.col("_nt")).cast("double")
    off = F.timestamp_diff("SECOND", F.col("_pt"), F.col("datetime")).cast("double")
    value = (F.when(F.col("datetime") == F.col("_pt"), F.col("_pv"))
             .otherwise((F.col("_nv") - F.col("_pv")) / span * off + F.col("_pv")))
    return rows.select(*keys, "datetime", value.alias("temp_c"))


def build_weather(station: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """S12 -> W1 -> W2 -> W3 -> W4; (datetime, temp_c) one row per hour."""
    readings = read_station_readings(station) if "DATE" in station.columns else station
    filled = fill_hours(last_of_hour(readings, keys), keys)
    return filled.select(*keys, "datetime", round_half_even("temp_c", 1).alias("temp_c"))
