"""Gold exports, the meter-file formatter and run expansion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsplit.constants import HOURS_PER_INTERVAL, INTERVALS_PER_DAY
from loadsplit.functions.numeric import exact_avg, exact_sum, round_half_up


def appliance_profile(gold: DataFrame, by_meter: bool = False, ordered: bool = False) -> DataFrame:
    """kWh (4 dp) and share of the date's total (6 dp) per gold row.

    The denominator is per date over all meters (``by_meter=True``: per
    meter-day). Totals are an aggregate joined back on the date, never a
    window over the date alone. ``ordered`` sorts the result, which puts all
    rows of a date and appliance into one task; tables do without.
    """
    keys = ["esiid", "usage_date"] if by_meter else ["usage_date"]
    totals = gold.groupBy(*keys).agg(exact_sum("estimated_kwh").alias("_day_total"))
    j = gold.join(totals, keys, "inner")
    cols = (["esiid"] if by_meter else []) + [
        "usage_date", "appliance",
        round_half_up("estimated_kwh", 4).alias("estimated_kwh"),
        round_half_up(F.try_divide(F.col("estimated_kwh"), F.when(F.col("_day_total") != 0, F.col("_day_total"))), 6)
        .alias("pct_of_daily_total"),
    ]
    out = j.select(*cols)
    return out.orderBy(*(["esiid"] if by_meter else []), "usage_date", "appliance") if ordered else out


def daily_temperature(interval_features: DataFrame) -> DataFrame:
    """Mean temperature per date."""
    return interval_features.groupBy(F.to_date("interval_start_dt").alias("usage_date")).agg(
        exact_avg("temp_c").alias("temp_c"))


def _appliance_sums(gold: DataFrame, digits: int) -> list:
    out = [round_half_up(exact_sum("estimated_kwh"), digits).alias("total_kwh")]
    for a in ("hvac", "washer", "dryer", "cooking", "baseline"):
        v = F.when(F.col("appliance") == a, F.col("estimated_kwh")).otherwise(F.lit(0.0))
        out.append(round_half_up(exact_sum(v), digits).alias(f"{a}_kwh"))
    return out


def daily_summary(gold: DataFrame, interval_features: DataFrame, ordered: bool = True) -> DataFrame:
    """Per date the total and five appliance sums (4 dp) and the mean
    temperature (2 dp); dates without silver rows drop out (inner join).
    Tables need no order."""
    temps = daily_temperature(interval_features)
    g = gold.groupBy("usage_date").agg(*_appliance_sums(gold, 4))
    out = g.join(temps, "usage_date", "inner").select(*g.columns, round_half_up("temp_c", 2).alias("avg_temp_c"))
    return out.orderBy("usage_date") if ordered else out


def daily_summary_with_confidence(gold: DataFrame) -> DataFrame:
    """E3 without weather, 2 dp, plus mean confidence (3 dp)."""
    return (gold.groupBy("usage_date")
            .agg(*_appliance_sums(gold, 2), round_half_up(exact_avg("confidence"), 3).alias("avg_confidence"))
            .orderBy("usage_date"))


def format_meter_export(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed intervals -> the eight raw export strings (leading
    apostrophe, MM/dd/yyyy, leading-space times, last end ' 24:00', 3 dp)."""
    ts = F.col("interval_start_dt")
    end = ts + F.expr("INTERVAL 15 MINUTES")
    last_slot = (F.hour(ts) == 23) & (F.minute(ts) == 45)
    kwh3 = (F.floor(F.col("usage_kwh").cast("double") * 1000 + 0.5) / 1000).cast("decimal(18,3)")
    return df.select(
        F.concat(F.lit("'"), F.col("esiid")).alias("ESIID"),
        F.date_format("usage_date", "MM/dd/yyyy").alias("USAGE_DATE"),
        F.date_format("revision_date", "MM/dd/yyyy HH:mm:ss").alias("REVISION_DATE"),
        F.concat(F.lit(" "), F.date_format(ts, "HH:mm")).alias("USAGE_START_TIME"),
        F.when(last_slot, F.lit(" 24:00")).otherwise(F.concat(F.lit(" "), F.date_format(end, "HH:mm")))
        .alias("USAGE_END_TIME"),
        kwh3.cast("string").alias("USAGE_KWH"),
        F.col("estimated_actual").alias("ESTIMATED_ACTUAL"),
        F.col("flow_direction").alias("CONSUMPTION_SURPLUSGENERATION"),
        *[F.col(k) for k in keep],
    )


def expand_runs_to_intervals(runs: DataFrame) -> DataFrame:
    """Appliance runs (date, start slot, length, kW) -> kWh per 15-minute
    slot, clipped at slot 96. Each run yields at most 96 rows."""
    last = F.least(F.col("start_slot") + F.col("n_slots"), F.lit(INTERVALS_PER_DAY)) - 1
    valid = (F.col("n_slots") > 0) & (F.col("start_slot") >= 0) & (F.col("start_slot") < INTERVALS_PER_DAY)
    slots = runs.where(valid).select(
        "run_date", F.explode(F.sequence(F.col("start_slot"), last)).alias("slot"), "kw")
    return slots.groupBy("run_date", "slot").agg(
        (exact_sum("kw") * HOURS_PER_INTERVAL).alias("kwh"))

