"""Schemas of the tables that are read as text or made from rows."""

from pyspark.sql import types as T

from loadsplit.constants import RAW_COLUMNS

RAW_METER = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

WEATHER_RAW = T.StructType([
    T.StructField("datetime", T.StringType()),
    T.StructField("temp_c", T.StringType()),
])

CENTROIDS = T.StructType([
    T.StructField("cluster", T.IntegerType()),
    T.StructField("usage_kwh", T.DoubleType()),
    T.StructField("hour_sin", T.DoubleType()),
    T.StructField("hour_cos", T.DoubleType()),
    T.StructField("temp_c", T.DoubleType()),
    T.StructField("ac_proxy_int", T.DoubleType()),
])
