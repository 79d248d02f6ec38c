from pyspark.sql import functions as F

from loadsplit.functions import calendar as C
from tests.conftest import ts


def _one(spark, value, expr):
    df = spark.createDataFrame([(ts(value),)], "t timestamp_ntz")
    return df.select(expr(F.col("t")).alias("x")).first()["x"]


def test_sunday_is_6_and_weekend(spark):
    assert _one(spark, "2025-05-04 12:00:00", C.day_of_week) == 6
    assert _one(spark, "2025-05-04 12:00:00", C.is_weekend) is True
    assert _one(spark, "2025-05-05 12:00:00", C.day_of_week) == 0


def test_peak_edges(spark):
    assert _one(spark, "2025-05-01 06:00:00", C.is_peak) is True
    assert _one(spark, "2025-05-01 20:45:00", C.is_peak) is True
    assert _one(spark, "2025-05-01 21:00:00", C.is_peak) is False
    assert _one(spark, "2025-05-01 05:45:00", C.is_peak) is False


def test_floors_keep_ntz(spark):
    assert str(_one(spark, "2024-01-01 10:44:59.999999", lambda c: C.floor_minutes(c, 15))) == "2024-01-01 10:30:00"
    assert str(_one(spark, "2024-01-01 23:59:59.5", C.hour_floor)) == "2024-01-01 23:00:00"
    assert str(_one(spark, "2024-01-01 23:59:59.5", C.second_floor)) == "2024-01-01 23:59:59"
    df = spark.createDataFrame([(ts("2024-01-01 10:44:59"),)], "t timestamp_ntz")
    assert dict(df.select(C.hour_floor("t").alias("h")).dtypes)["h"] == "timestamp_ntz"
