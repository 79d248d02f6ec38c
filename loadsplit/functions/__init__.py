"""Column-expression builders. Every function returns a ``Column`` and stays
JVM-side (no Python UDFs), so whole-stage codegen covers them."""

from loadsplit.functions.parsing import (  # noqa: F401
    clean_esiid, trim_time, parse_usage_date, bad_usage_date, parse_revision_ts,
    bad_revision_ts, build_interval_start, coerce_kwh,
)
from loadsplit.functions.calendar import (  # noqa: F401
    hour_of_day, day_of_week, is_weekend, is_peak, hour_floor, floor_minutes, usage_date_of,
)
from loadsplit.functions.numeric import (  # noqa: F401
    round_half_even, round_half_up, exact_sum, exact_avg, celsius_to_fahrenheit,
    cooling_load_kw, expected_cooling_kwh, hour_sin, hour_cos, to_decimal,
)
