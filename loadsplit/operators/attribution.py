"""Label intervals, confidence, daily appliance estimates and the
model reports.

Per-cluster values (max distance) are k-row aggregates joined back with a
broadcast hint: the mapping and the per-cluster table have exactly k rows.
A window over ``cluster`` would put every interval into k tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsplit.constants import MIN_CONFIDENCE, MIN_MAX_DISTANCE
from loadsplit.functions.numeric import exact_avg, exact_sum, round_half_up


def label_appliance(scored: DataFrame, mapping: DataFrame) -> DataFrame:
    """Cluster -> appliance. The mapping has k rows (checked by
    ``small_table``), so it is broadcast."""
    from loadsplit.operators.model import small_table
    return scored.join(F.broadcast(small_table(mapping.select("cluster", "appliance"))), "cluster", "left")


def max_distance_per_cluster(scored: DataFrame, clusters: DataFrame | None = None) -> DataFrame:
    """Max distance of each cluster on every row, floored at 1e-9.

    ``clusters`` is the k-row table of ``model.cluster_table`` when it was
    already computed (its ``max_distance_raw``); otherwise one aggregate."""
    if clusters is None:
        m = scored.groupBy("cluster").agg(F.max("distance").alias("max_distance_raw"))
    else:
        m = clusters.select("cluster", "max_distance_raw")
    m = m.select("cluster", F.greatest(F.col("max_distance_raw"), F.lit(MIN_MAX_DISTANCE)).alias("max_distance"))
    return scored.join(F.broadcast(m), "cluster", "left")


def confidence(df: DataFrame) -> DataFrame:
    """max(0.3, 1 - d / max_d), rounded to 6 places; null distance -> null
    (``greatest`` would skip the null and return the floor)."""
    raw = F.lit(1.0) - F.col("distance") / F.col("max_distance")
    conf = F.when(F.col("distance").isNotNull(), F.greatest(F.lit(MIN_CONFIDENCE), raw))
    return df.withColumn("confidence", round_half_up(conf, 6))


def estimate_daily(labeled: DataFrame) -> DataFrame:
    """(meter, day, appliance) -> kWh sum and mean confidence, unrounded."""
    return labeled.groupBy("esiid", F.to_date("interval_start_dt").alias("usage_date"), "appliance").agg(
        exact_sum("usage_kwh").alias("estimated_kwh"),
        exact_avg("confidence").alias("confidence"),
    )


def cluster_diagnostics(labeled: DataFrame) -> DataFrame:
    """Per cluster: size, mean kWh / hour / temperature, cooling share in %."""
    temp = "temp_raw" if "temp_raw" in labeled.columns else "temp_c"
    return labeled.groupBy("cluster", "appliance").agg(
        F.count(F.lit(1)).alias("n_intervals"),
        round_half_up(exact_avg("usage_kwh"), 6).alias("mean_kwh"),
        round_half_up(exact_avg("hour_of_day"), 6).alias("mean_hour"),
        round_half_up(exact_avg(temp), 6).alias("mean_temp_c"),
        round_half_up(exact_avg("ac_proxy_int") * 100, 6).alias("ac_pct"),
    )


def appliance_share(gold: DataFrame, daily: DataFrame) -> DataFrame:
    """Per appliance mean kWh per row and its share of the mean daily total."""
    total_avg = daily.select(exact_avg("total_kwh")).scalar()
    per = gold.groupBy("appliance").agg(exact_avg("estimated_kwh").alias("avg_kwh"))
    return (per.select("appliance", round_half_up("avg_kwh", 6).alias("avg_kwh"),
                       round_half_up(F.col("avg_kwh") / total_avg * 100, 6).alias("share_pct"))
            .orderBy(F.col("avg_kwh").desc(), "appliance"))


def mean_confidence_by_appliance(gold: DataFrame) -> DataFrame:
    """D16."""
    return (gold.groupBy("appliance").agg(round_half_up(exact_avg("confidence"), 6).alias("mean_confidence"))
            .orderBy(F.col("mean_confidence").desc(), "appliance"))


def first_day_estimates(gold: DataFrame) -> DataFrame:
    """Rows of the earliest date, kWh descending."""
    first = gold.select(F.min("usage_date")).scalar()
    return gold.where(F.col("usage_date") == first).orderBy(F.col("estimated_kwh").desc(), "esiid", "appliance")


def training_cost(scored: DataFrame) -> DataFrame:
    """Within-cluster sum of squared distances of a scored frame (exact sum)."""
    d = F.col("distance").cast("decimal(18,6)")
    return scored.agg(round_half_up(F.sum(d * d).cast("double"), 3).alias("training_cost"))


def model_metrics(gold: DataFrame, cost=None) -> DataFrame:
    """Training cost; per appliance mean kWh (3 dp) and % of the sum of
    means (1 dp). ``cost`` is a number (fitted model) or a one-row frame."""
    per = gold.groupBy("appliance").agg(round_half_up(exact_avg("estimated_kwh"), 6).alias("avg_kwh"))
    total = per.select(exact_sum("avg_kwh")).scalar()
    out = per.select("appliance", round_half_up("avg_kwh", 3).alias("avg_kwh"),
                     round_half_up(F.col("avg_kwh") / total * 100, 1).alias("pct"))
    if cost is None:
        return out
    if isinstance(cost, DataFrame):
        return out.withColumn("training_cost", cost.select("training_cost").scalar())
    return out.withColumn("training_cost", F.lit(float(cost)))
