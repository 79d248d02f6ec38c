"""Raw meter strings -> typed columns. ANSI mode is on in Spark 4, so
every parse is a ``try_*`` form: bad values become null instead of failing the
job, and the caller decides (row kept, or file quarantined)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadsplit.constants import INTERVAL_START_FORMAT, REVISION_TS_FORMAT, USAGE_DATE_FORMAT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_esiid(c) -> Column:
    """S3: trim, strip every leading apostrophe, trim again."""
    return F.trim(F.regexp_replace(F.trim(_c(c)), r"^'+", ""))


def trim_time(c) -> Column:
    """S4: ' 00:15' -> '00:15' (end time '24:00' stays a string)."""
    return F.trim(_c(c))


def parse_usage_date(c) -> Column:
    """month/day/year, one or two digits -> DATE, null when malformed."""
    return F.try_to_timestamp(_c(c), F.lit(USAGE_DATE_FORMAT)).cast("date")


def bad_usage_date(c) -> Column:
    """S5 error flag: a non-null string that does not parse. (A blank date is
    an error of the row if it has a start time, see ``row_parse_error``.)"""
    return _c(c).isNotNull() & parse_usage_date(c).isNull()


def parse_revision_ts(c) -> Column:
    """month/day/year hour:minute:second -> TIMESTAMP_NTZ, null when malformed."""
    return F.try_to_timestamp(_c(c), F.lit(REVISION_TS_FORMAT)).cast("timestamp_ntz")


def bad_revision_ts(c) -> Column:
    return _c(c).isNotNull() & parse_revision_ts(c).isNull()


def build_interval_start(date_col, time_col) -> Column:
    """Typed date + trimmed hour:minute -> naive timestamp."""
    txt = F.concat_ws(" ", _c(date_col).cast("string"), _c(time_col))
    return F.try_to_timestamp(txt, F.lit(INTERVAL_START_FORMAT)).cast("timestamp_ntz")


def coerce_kwh(c) -> Column:
    """Non-numeric -> null; the row is kept. The reader's words for missing
    numbers (NaN) are null too, and so are infinities, which no sum could hold."""
    x = _c(c).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
