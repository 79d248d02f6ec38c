"""Figures of a small hand-written export, through the CSV reader and the daily
rollup: file and row counts, totals, on-peak share, extremes. With
LOADSPLIT_SAMPLE_DIR set to a directory of real exports, the figures measured
"""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from loadsplit.operators import features as FT
from loadsplit.operators import ingest as I
from loadsplit.session import local_path
from loadsplit.sources import meter_csv as S
from tests.conftest import day_rows, write_meter_file

SAMPLE = os.environ.get("LOADSPLIT_SAMPLE_DIR")


def _figures(spark, root):
    bronze = I.to_bronze(S.read_meter_csv(spark, root))
    wx = spark.createDataFrame([], "datetime timestamp_ntz, temp_c double")
    daily = FT.daily_features(FT.interval_features(I.filter_flow(bronze), wx))
    tot = daily.agg(F.sum(F.col("total_kwh").cast("decimal(18,6)")).alias("t"),
                    F.sum(F.col("peak_kwh").cast("decimal(18,6)")).alias("p"), F.max("max_interval_kwh").alias("m")).first()
    lo, hi = daily.orderBy("total_kwh").first(), daily.orderBy(F.col("total_kwh").desc()).first()
    return {"rows": bronze.count(), "files": bronze.select("source_file").distinct().count(),
            "total": round(float(tot["t"]), 3), "peak": round(float(tot["p"]), 3), "max": tot["m"],
            "low": (str(lo["usage_date"]), round(lo["total_kwh"], 3)), "high": (str(hi["usage_date"]), round(hi["total_kwh"], 3))}


def test_hand_written_export(spark, scratch):
    root = local_path(scratch("sample"))
    day = dt.date(2025, 5, 1)
    # 0.1 kWh a slot off peak, 0.2 on peak (06:00 to 20:45, 60 slots), plus 0.001 a slot and day
    for k in range(3):
        write_meter_file(root, day + dt.timedelta(k), day_rows(
            day + dt.timedelta(k), kwh=lambda i, k=k: round((0.2 if 24 <= i < 84 else 0.1) + 0.001 * k, 3)))
    assert _figures(spark, root) == {
        "rows": 288, "files": 3, "total": 47.088, "peak": 36.18, "max": 0.202,
        "low": ("2025-05-01", 15.6), "high": ("2025-05-03", 15.792)}


@pytest.mark.skipif(not SAMPLE or not os.path.isdir(SAMPLE), reason="LOADSPLIT_SAMPLE_DIR not set")
def test_measured_export(spark):
    assert _figures(spark, SAMPLE) == {
        "rows": 5856, "files": 61, "total": 2835.296, "peak": 2460.517, "max": 2.183,
        "low": ("2025-05-05", 28.832), "high": ("2025-06-06", 62.281)}
