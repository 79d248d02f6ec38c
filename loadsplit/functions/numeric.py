"""Numeric helpers.

Sums and means go through DECIMAL and are cast to DOUBLE last, so the result
does not depend on the order in which partitions are combined (a double sum
does). Spark keeps same-scale decimal additions on a 64-bit fast path, so the
cost over a double sum is small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadsplit import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_decimal(c, scale: int = 6, precision: int = 18) -> Column:
    return _c(c).cast(f"decimal({precision},{scale})")


def exact_sum(c, scale: int = 6) -> Column:
    """Order-independent sum of a column with at most ``scale`` decimals."""
    return F.sum(to_decimal(c, scale)).cast("double")


def exact_avg(c, scale: int = 6) -> Column:
    """Mean as exact decimal sum / count (null on an empty group)."""
    return F.sum(to_decimal(c, scale)).cast("double") / F.count(_c(c))


def round_half_up(c, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d - the same bits in every engine."""
    s = float(10 ** digits)
    return F.floor(_c(c) * s + 0.5) / s


def round_half_even(c, digits: int) -> Column:
    """banker's rounding (pandas ``Series.round``); ``F.round`` is half-up."""
    s = float(10 ** digits)
    return F.rint(_c(c) * s) / s


def celsius_to_fahrenheit(c) -> Column:
    """W9."""
    return _c(c) * 9 / 5 + 32


def cooling_load_kw(temp_c) -> Column:
    """Piecewise cooling load of the simulator, kW."""
    t = _c(temp_c)
    return (
        F.when(t < K.COOLING_KNEE_1_C, F.lit(0.0))
        .when(t < K.COOLING_KNEE_2_C, (t - K.COOLING_KNEE_1_C) / 4.0 * K.COOLING_LIGHT_KW)
        .when(t < K.COOLING_KNEE_3_C,
              K.COOLING_LIGHT_KW + (t - K.COOLING_KNEE_2_C) / 6.0 * K.COOLING_MODERATE_KW)
        .when(t.isNotNull(), F.least(K.COOLING_HEAVY_BASE_KW + (t - K.COOLING_KNEE_3_C) * K.COOLING_HEAVY_SLOPE,
                                     F.lit(K.COOLING_MAX_KW)))
    )  # null temperature -> null (least() would skip the null)


def night_factor(hour) -> Column:
    h = _c(hour)
    return F.when((h < K.NIGHT_END_HOUR) | (h >= K.NIGHT_START_HOUR), F.lit(K.NIGHT_FACTOR)).otherwise(F.lit(1.0))


def expected_cooling_kwh(temp_c, hour) -> Column:
    """Deterministic cooling energy of one 15-minute interval."""
    return cooling_load_kw(temp_c) * night_factor(hour) * K.HOURS_PER_INTERVAL


def hour_sin(hour) -> Column:
    """D1, rounded to 6 places so every engine agrees."""
    return round_half_up(F.sin(_c(hour) * (2 * math.pi / 24)), 6)


def hour_cos(hour) -> Column:
    return round_half_up(F.cos(_c(hour) * (2 * math.pi / 24)), 6)
