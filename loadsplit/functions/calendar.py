"""Calendar attributes of a TIMESTAMP_NTZ. All helpers are time-zone
independent (``date_trunc`` would round-trip through the session zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadsplit.constants import PEAK_END_HOUR, PEAK_START_HOUR


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts))


def day_of_week(ts) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(_c(ts))


def is_weekend(ts) -> Column:
    return day_of_week(ts) >= 5


def is_peak(ts) -> Column:
    h = hour_of_day(ts)
    return (h >= PEAK_START_HOUR) & (h < PEAK_END_HOUR)


def _seconds(t: Column) -> Column:
    """Seconds within the minute, with the fraction (decimal(8,6))."""
    return F.date_part(F.lit("SECOND"), t)


def floor_minutes(ts, minutes: int) -> Column:
    """Floor a naive timestamp to a multiple of ``minutes`` within the hour by
    subtracting a day-time interval (no session time zone involved)."""
    t = _c(ts)
    return t - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(t) % minutes, _seconds(t))


def hour_floor(ts) -> Column:
    """top of the hour, still TIMESTAMP_NTZ."""
    t = _c(ts)
    return t - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(t), _seconds(t))


def second_floor(ts) -> Column:
    t = _c(ts)
    s = _seconds(t)
    return t - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), s - F.floor(s))


def usage_date_of(ts) -> Column:
    return F.to_date(_c(ts))
