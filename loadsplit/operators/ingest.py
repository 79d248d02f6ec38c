"""Typed bronze rows, file lineage and the file-level rules.

Per-file decisions (already loaded, quarantined) are aggregates keyed by
``source_file`` joined back with an anti join; a file that holds a large share
of all rows only makes its partial aggregate bigger, never one task's input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadsplit.functions import parsing as P


def to_bronze(raw: DataFrame, loaded_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Eight raw strings (+ source_file) -> the 11-column bronze layout
    (and the columns named in ``keep``)."""
    usage_date = P.parse_usage_date("USAGE_DATE")
    start = P.trim_time("USAGE_START_TIME")
    return raw.select(
        P.clean_esiid("ESIID").alias("esiid"),
        usage_date.alias("usage_date"),
        P.parse_revision_ts("REVISION_DATE").alias("revision_date"),
        start.alias("interval_start"),
        P.trim_time("USAGE_END_TIME").alias("interval_end"),
        P.build_interval_start(usage_date, start).alias("interval_start_dt"),
        P.coerce_kwh("USAGE_KWH").alias("usage_kwh"),
        F.col("ESTIMATED_ACTUAL").alias("estimated_actual"),
        F.col("CONSUMPTION_SURPLUSGENERATION").alias("flow_direction"),
        F.col("source_file"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).alias("loaded_at"),
        *keep,
    )


def trim_times(raw: DataFrame) -> DataFrame:
    """Trim both time strings in place (' 24:00' -> '24:00', never parsed)."""
    return (raw.withColumn("USAGE_START_TIME", P.trim_time("USAGE_START_TIME"))
               .withColumn("USAGE_END_TIME", P.trim_time("USAGE_END_TIME")))


def row_parse_error() -> Column:
    """True when a row would make the whole file fail to parse (S5-S7): a date,
    revision or start time that does not parse, or a start time without a date."""
    start = P.trim_time("USAGE_START_TIME")
    day = P.parse_usage_date("USAGE_DATE")
    bad_start = start.isNotNull() & (day.isNull() | P.build_interval_start(day, start).isNull())
    return P.bad_usage_date("USAGE_DATE") | P.bad_revision_ts("REVISION_DATE") | bad_start


def filter_flow(df: DataFrame, direction: str = "Consumption") -> DataFrame:
    """Keep one flow direction (a pushed-down Parquet filter)."""
    return df.where(F.col("flow_direction") == direction)


def file_status(raw: DataFrame) -> DataFrame:
    """Per source file: row count and whether any row fails to parse."""
    return raw.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_or(row_parse_error()).alias("has_error"),
    )


def quarantine_bad_files(raw: DataFrame) -> DataFrame:
    """Drop every row of a file that has any unparseable date or time.

    The error list is an aggregate (partial aggregation before the shuffle);
    AQE broadcasts it when it is small and falls back to a shuffle join when
    it is not.
    """
    bad = raw.where(row_parse_error()).select("source_file").distinct()
    return raw.join(bad, "source_file", "left_anti")


def new_files_only(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Keep files (rows or a listing) whose ``source_file`` is not yet loaded.

    ``loaded`` can be bronze itself; only its distinct file names are used.
    """
    return files.join(loaded.select("source_file").distinct(), "source_file", "left_anti")


def ingest_report(raw: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """Rows loaded, files loaded, files skipped, files in error - one row."""
    status = file_status(raw)
    if loaded is not None:
        done = loaded.select("source_file").distinct().withColumn("already_loaded", F.lit(True))
        status = status.join(done, "source_file", "left").fillna(False, subset=["already_loaded"])
    else:
        status = status.withColumn("already_loaded", F.lit(False))
    fresh = ~F.col("already_loaded")
    ok = fresh & ~F.col("has_error")
    return status.agg(
        F.coalesce(F.sum(F.when(ok, F.col("n_rows"))), F.lit(0)).cast("long").alias("rows_loaded"),
        F.count_if(ok).alias("files_loaded"),
        F.count_if(F.col("already_loaded")).alias("files_skipped"),
        F.count_if(fresh & F.col("has_error")).alias("files_in_error"),
    )
