"""Rule-based load bands of one interval, as column expressions.

A null kWh gives null bands (the rules are undefined there); a null temperature
counts as not hot.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadsplit import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _pos(x: Column) -> Column:
    return F.greatest(F.lit(0.0), x)


def band_baseline(kwh) -> Column:
    """Fixed floor, never rescaled."""
    k = _c(kwh)
    return F.when(k.isNotNull(), F.least(k, F.lit(K.BAND_BASELINE_CAP)))


def band_hvac(kwh, hour, temp) -> Column:
    """B5."""
    k, h, t = _c(kwh), _c(hour), _c(temp)
    hot = F.coalesce(t > K.BAND_HOT_C, F.lit(False))
    excess = k * (t - K.BAND_HOT_C) / K.BAND_HVAC_SPAN_C
    return (F.when(hot & h.between(*K.BAND_HVAC_DAY_HOURS), _pos(excess * K.BAND_HVAC_DAY_FACTOR))
            .when(hot, _pos(excess * K.BAND_HVAC_NIGHT_FACTOR))
            .otherwise(F.lit(0.0)))


def band_morning(kwh, hour) -> Column:
    """B6."""
    k, h = _c(kwh), _c(hour)
    return F.when(h.between(*K.BAND_MORNING_HOURS) & (k > K.BAND_MORNING_MIN_KWH), _pos(k * K.BAND_MORNING_FACTOR)).otherwise(F.lit(0.0))


def band_cooking(kwh, hour) -> Column:
    """B7."""
    k, h = _c(kwh), _c(hour)
    return (F.when(h.between(*K.BAND_COOKING_EVENING_HOURS), _pos(k * K.BAND_COOKING_EVENING))
            .when(h.between(*K.BAND_COOKING_NOON_HOURS), _pos(k * K.BAND_COOKING_NOON))
            .otherwise(F.lit(0.0)))


def band_washer(kwh, hour) -> Column:
    """B8."""
    k, h = _c(kwh), _c(hour)
    return F.when(h.between(*K.BAND_WASHER_HOURS) & (k > K.BAND_WASHER_MIN_KWH), _pos(k * K.BAND_WASHER_FACTOR)).otherwise(F.lit(0.0))


def band_dryer(kwh, hour) -> Column:
    """B9."""
    k, h = _c(kwh), _c(hour)
    return F.when(h.between(*K.BAND_DRYER_HOURS) & (k > K.BAND_DRYER_MIN_KWH), _pos(k * K.BAND_DRYER_FACTOR)).otherwise(F.lit(0.0))


VARIABLE_BANDS = ("hvac", "morning", "cooking", "washer", "dryer")


def scale_to_headroom(kwh, baseline, variable_sum) -> Column:
    """Factor that shrinks the variable bands into max(0, kWh - baseline)."""
    available = _pos(_c(kwh) - _c(baseline))
    vs = _c(variable_sum)
    return F.when(vs > available, available / F.greatest(vs, F.lit(K.BAND_SCALE_FLOOR))).otherwise(F.lit(1.0))


def band_other(kwh, *bands) -> Column:
    """Unclassified remainder, never negative."""
    total = _c(bands[0])
    for b in bands[1:]:
        total = total + _c(b)
    return _pos(_c(kwh) - total)
