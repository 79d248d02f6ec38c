"""Views derived from the driver's ``events`` table, written twice: as Spark
DataFrames and as DuckDB CTE text for the oracle. Both sides must express the
same binding; keep them next to each other.

Binding (fixed, see FIXTURES.md):

* meter_view: esiid = string(user_id); interval_start_dt = ts floored to
  15 minutes; usage_kwh = decimal(18,6) of value*0.01; flow_direction =
  SurplusGeneration for event_type 'error' else Consumption; estimated_actual =
  E for 'signup' else A; usage_date = date(ts); revision_date = ts to the second.
* file_view: meter_view plus source_file 'yyyy/MM/yyyyMMdd.csv' of usage_date.
* raw_meter_view: file_view formatted back to the eight raw strings (E8).
* dirty_raw_view: raw_meter_view with deterministic malformations.
* station_view: event_type 'view'; DATE = ts; HourlyDryBulbTemperature =
  10 + value % 25.
* runs_view: run_date = date(ts); start_slot = hour*4 + minute div 15;
  n_slots = 1 + event_id % 8; kw = value*0.01.
* fixed_centroids: five literal centroids in standardized feature space.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsplit.functions.calendar import floor_minutes, second_floor

# --- fixed values: literal centroids in z-score space --------------------------
# columns: cluster, usage_kwh, hour_sin, hour_cos, temp_c, ac_proxy_int
FIXED_CENTROIDS = (
    (0, -0.8, 0.0, 0.9, -0.5, -0.6),
    (1, 0.2, 0.7, -0.1, 0.3, 1.2),
    (2, -0.3, -0.9, 0.2, 0.1, -0.4),
    (3, 1.1, 0.4, -0.8, 0.6, 0.9),
    (4, 2.2, -0.3, -0.5, -0.2, -0.1),
)
FEATURES = ("usage_kwh", "hour_sin", "hour_cos", "temp_c", "ac_proxy_int")
METER_COLUMNS = ("esiid", "usage_date", "revision_date", "interval_start_dt", "usage_kwh",
                 "estimated_actual", "flow_direction")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _meter_base(spark: SparkSession, sf_dir: str, day: str | None = None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    if day:  # slots are floored inside their day, so the range can stand on the raw time
        ev = ev.where((F.col("ts") >= F.to_timestamp_ntz(F.lit(day))) &
                      (F.col("ts") < F.to_timestamp_ntz(F.lit(str(dt.date.fromisoformat(day) + dt.timedelta(1))))))
    return ev.select(
        F.col("user_id").cast("string").alias("esiid"),
        F.to_date("ts").alias("usage_date"),
        second_floor("ts").alias("revision_date"),
        floor_minutes("ts", 15).alias("interval_start_dt"),
        (F.col("value") * 0.01).cast("decimal(18,6)").alias("usage_kwh"),
        F.when(F.col("event_type") == "signup", F.lit("E")).otherwise(F.lit("A")).alias("estimated_actual"),
        F.when(F.col("event_type") == "error", F.lit("SurplusGeneration"))
        .otherwise(F.lit("Consumption")).alias("flow_direction"),
        F.concat(F.date_format(F.to_date("ts"), "yyyy/MM/yyyyMMdd"), F.lit(".csv")).alias("source_file"),
        "event_type", "value",
    )


def meter_view(spark: SparkSession, sf_dir: str, day: str | None = None) -> DataFrame:
    return _meter_base(spark, sf_dir, day).select(*METER_COLUMNS)


def file_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _meter_base(spark, sf_dir).select(*METER_COLUMNS, "source_file")


def raw_meter_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadsplit.operators.export import format_meter_export
    return format_meter_export(file_view(spark, sf_dir), keep=("source_file",))


def dirty_raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_meter_view with deterministic malformations: padded apostrophes on
    'signup' rows, one-digit dates on 'purchase' and one-digit hours on 'error'
    rows, ISO or blank dates or bad revisions on large 'click' rows (their
    files fail), and bad / negative / empty / NaN kWh on small rows."""
    from loadsplit.operators.export import format_meter_export
    raw = format_meter_export(_meter_base(spark, sf_dir), keep=("source_file", "event_type", "value"))
    et, v = F.col("event_type"), F.col("value")
    return raw.select(
        F.when(F.col("ESTIMATED_ACTUAL") == "E",
               F.concat(F.lit(" ''"), F.expr("substr(ESIID, 2)"), F.lit(" ")))
        .otherwise(F.col("ESIID")).alias("ESIID"),
        F.when((et == "click") & (v >= 400), F.lit(None))
        .when((et == "click") & (v >= 250),
              F.date_format(F.try_to_timestamp("USAGE_DATE", F.lit("MM/dd/yyyy")), "yyyy-MM-dd"))
        .when(et == "purchase", F.regexp_replace("USAGE_DATE", "(^|/)0", "$1"))
        .otherwise(F.col("USAGE_DATE")).alias("USAGE_DATE"),
        F.when((et == "click") & (v >= 240) & (v < 250), F.lit("02/30/2024 07:40:29"))
        .otherwise(F.col("REVISION_DATE")).alias("REVISION_DATE"),
        F.when(et == "error", F.regexp_replace("USAGE_START_TIME", "^ 0", " "))
        .otherwise(F.col("USAGE_START_TIME")).alias("USAGE_START_TIME"),
        "USAGE_END_TIME",
        F.when((et == "purchase") & (v < 1), F.lit("bad"))
        .when((et == "error") & (v < 1), F.concat(F.lit("-"), F.col("USAGE_KWH")))
        .when((et == "view") & (v < 0.5), F.lit(""))
        .when((et == "view") & (v < 1), F.lit("NaN"))
        .otherwise(F.col("USAGE_KWH")).alias("USAGE_KWH"),
        "ESTIMATED_ACTUAL", "CONSUMPTION_SURPLUSGENERATION", "source_file",
    )


def station_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.where(F.col("event_type") == "view").select(
        F.col("ts").alias("DATE"),
        (F.lit(10.0) + F.col("value") % 25).alias("HourlyDryBulbTemperature"),
    )


def runs_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.to_date("ts").alias("run_date"),
        (F.hour("ts") * 4 + F.floor(F.minute("ts") / 15)).cast("int").alias("start_slot"),
        (F.lit(1) + F.col("event_id") % 8).cast("int").alias("n_slots"),
        (F.col("value") * 0.01).alias("kw"),
    )


def fixed_centroids(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [tuple([int(r[0])] + [float(x) for x in r[1:]]) for r in FIXED_CENTROIDS],
        "cluster int, usage_kwh double, hour_sin double, hour_cos double, temp_c double, ac_proxy_int double",
    )


# --- DuckDB twins (same bindings, one CTE each) ---------------------------------

def _centroid_values() -> str:
    return ", ".join(
        "(" + ", ".join([str(r[0])] + [f"CAST({x!r} AS DOUBLE)" for x in r[1:]]) + ")"
        for r in FIXED_CENTROIDS)


_Q = "'"  # a single quote, to keep the SQL below readable

SQL_VIEWS = {
    "meter_base": """
        SELECT CAST(user_id AS VARCHAR) AS esiid,
               CAST(ts AS DATE) AS usage_date,
               date_trunc('second', ts) AS revision_date,
               time_bucket(INTERVAL 15 MINUTE, ts) AS interval_start_dt,
               CAST(value * 0.01 AS DECIMAL(18,6)) AS usage_kwh,
               CASE WHEN event_type = 'signup' THEN 'E' ELSE 'A' END AS estimated_actual,
               CASE WHEN event_type = 'error' THEN 'SurplusGeneration' ELSE 'Consumption' END AS flow_direction,
               strftime(CAST(ts AS DATE), '%Y/%m/%Y%m%d') || '.csv' AS source_file,
               event_type, value
        FROM events""",
    "meter_view": """
        SELECT esiid, usage_date, revision_date, interval_start_dt, usage_kwh, estimated_actual, flow_direction
        FROM meter_base""",
    "file_view": """
        SELECT esiid, usage_date, revision_date, interval_start_dt, usage_kwh, estimated_actual, flow_direction,
               source_file
        FROM meter_base""",
    "raw_base": f"""
        SELECT {_Q * 4} || esiid AS ESIID,
               strftime(usage_date, '%m/%d/%Y') AS USAGE_DATE,
               strftime(revision_date, '%m/%d/%Y %H:%M:%S') AS REVISION_DATE,
               ' ' || strftime(interval_start_dt, '%H:%M') AS USAGE_START_TIME,
               CASE WHEN hour(interval_start_dt) = 23 AND minute(interval_start_dt) = 45 THEN ' 24:00'
                    ELSE ' ' || strftime(interval_start_dt + INTERVAL 15 MINUTE, '%H:%M') END AS USAGE_END_TIME,
               CAST(CAST(floor(CAST(usage_kwh AS DOUBLE) * 1000 + 0.5) / 1000 AS DECIMAL(18,3)) AS VARCHAR)
                 AS USAGE_KWH,
               estimated_actual AS ESTIMATED_ACTUAL,
               flow_direction AS CONSUMPTION_SURPLUSGENERATION,
               source_file, event_type, value
        FROM meter_base""",
    "raw_meter_view": """
        SELECT ESIID, USAGE_DATE, REVISION_DATE, USAGE_START_TIME, USAGE_END_TIME, USAGE_KWH,
               ESTIMATED_ACTUAL, CONSUMPTION_SURPLUSGENERATION, source_file
        FROM raw_base""",
    "dirty_raw_view": f"""
        SELECT CASE WHEN ESTIMATED_ACTUAL = 'E' THEN ' {_Q * 5} || substr(ESIID, 2) || ' '
                    ELSE ESIID END AS ESIID,
               CASE WHEN event_type = 'click' AND value >= 400 THEN NULL
                    WHEN event_type = 'click' AND value >= 250
                    THEN strftime(strptime(USAGE_DATE, '%m/%d/%Y'), '%Y-%m-%d')
                    WHEN event_type = 'purchase' THEN replace(ltrim(USAGE_DATE, '0'), '/0', '/')
                    ELSE USAGE_DATE END AS USAGE_DATE,
               CASE WHEN event_type = 'click' AND value >= 240 AND value < 250 THEN '02/30/2024 07:40:29'
                    ELSE REVISION_DATE END AS REVISION_DATE,
               CASE WHEN event_type = 'error' AND starts_with(USAGE_START_TIME, ' 0')
                    THEN ' ' || substr(USAGE_START_TIME, 3) ELSE USAGE_START_TIME END AS USAGE_START_TIME,
               USAGE_END_TIME,
               CASE WHEN event_type = 'purchase' AND value < 1 THEN 'bad'
                    WHEN event_type = 'error' AND value < 1 THEN '-' || USAGE_KWH
                    WHEN event_type = 'view' AND value < 0.5 THEN ''
                    WHEN event_type = 'view' AND value < 1 THEN 'NaN'
                    ELSE USAGE_KWH END AS USAGE_KWH,
               ESTIMATED_ACTUAL, CONSUMPTION_SURPLUSGENERATION, source_file
        FROM raw_base""",
    "station_view": """
        SELECT ts AS "DATE", CAST(10.0 AS DOUBLE) + value % 25 AS HourlyDryBulbTemperature
        FROM events WHERE event_type = 'view'""",
    "runs_view": """
        SELECT CAST(ts AS DATE) AS run_date,
               CAST(hour(ts) * 4 + floor(minute(ts) / 15) AS INTEGER) AS start_slot,
               CAST(1 + event_id % 8 AS INTEGER) AS n_slots,
               value * 0.01 AS kw
        FROM events""",
    "fixed_centroids": f"""
        SELECT * FROM (VALUES {_centroid_values()})
          AS t(cluster, usage_kwh, hour_sin, hour_cos, temp_c, ac_proxy_int)""",
}

# dependency order for the WITH clause
VIEW_ORDER = ("meter_base", "meter_view", "file_view", "raw_base", "raw_meter_view", "dirty_raw_view",
              "station_view", "runs_view", "fixed_centroids")
