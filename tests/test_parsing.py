from pyspark.sql import functions as F

from loadsplit.functions import parsing as P


def test_clean_esiid_variants(spark):
    df = spark.createDataFrame([("'12",), ("''12",), (" '12 ",), ("12",)], "e string")
    assert [r[0] for r in df.select(P.clean_esiid("e")).collect()] == ["12", "12", "12", "12"]


def test_coerce_kwh_keeps_rows(spark):
    df = spark.createDataFrame([("bad",), ("",), ("0.5",), (None,), ("-0.1",), ("NaN",), ("Infinity",)], "k string")
    out = [r[0] for r in df.select(P.coerce_kwh("k")).collect()]
    assert out == [None, None, 0.5, None, -0.1, None, None]


def test_end_time_24_kept(spark):
    df = spark.createDataFrame([(" 24:00",)], "t string")
    assert df.select(P.trim_time("t")).first()[0] == "24:00"


def test_dates_and_error_flag(spark):
    df = spark.createDataFrame([("05/01/2025",), ("2025-05-01",), (None,)], "d string")
    rows = df.select(P.parse_usage_date("d").alias("d"), P.bad_usage_date("d").alias("bad")).collect()
    assert str(rows[0]["d"]) == "2025-05-01" and rows[0]["bad"] is False
    assert rows[1]["d"] is None and rows[1]["bad"] is True
    assert rows[2]["d"] is None and rows[2]["bad"] is False


def test_one_digit_forms_and_row_errors(spark):
    from loadsplit.operators.ingest import row_parse_error
    rows = [("5/1/2025", "5/2/2025 7:04:09", " 0:15", False), ("05/01/2025", None, " 00:15", False), (None, None, " 00:15", True),
            (None, None, None, False), ("05/32/2025", None, " 00:15", True), ("05/01/2025", "05/02/2025", " 00:15", True),
            ("05/01/2025", None, " 25:00", True)]
    df = spark.createDataFrame(rows, "USAGE_DATE string, REVISION_DATE string, USAGE_START_TIME string, bad boolean")
    got = df.select(F.coalesce(row_parse_error(), F.lit(False)).alias("b"), "bad", P.parse_usage_date("USAGE_DATE").alias("d"),
                    P.build_interval_start(P.parse_usage_date("USAGE_DATE"), P.trim_time("USAGE_START_TIME")).alias("s")).collect()
    assert all(r["b"] == r["bad"] for r in got)
    assert str(got[0]["d"]) == "2025-05-01" and str(got[0]["s"]) == "2025-05-01 00:15:00"


def test_revision_and_interval_start(spark):
    df = spark.createDataFrame([("05/02/2025 07:40:29", "05/01/2025", " 23:45")], "r string, d string, s string")
    row = df.select(P.parse_revision_ts("r").alias("r"),
                    P.build_interval_start(P.parse_usage_date("d"), P.trim_time("s")).alias("s")).first()
    assert str(row["r"]) == "2025-05-02 07:40:29"
    assert str(row["s"]) == "2025-05-01 23:45:00"
    assert dict(df.select(P.parse_revision_ts("r").alias("r")).dtypes)["r"] == "timestamp_ntz"
    assert df.select(F.lit(1)).count() == 1
