"""Physical-plan properties: pushdown, pruning, partition pruning."""

import re

from pyspark.sql import functions as F

from loadsplit.operators import bands as B
from loadsplit.plans import queries as Q
from loadsplit.sources import sinks

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_station_filter_and_columns_reach_the_scan(spark):
    plan = _plan(Q.readings(spark, SF))
    assert "EqualTo(event_type,view)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_day_view_prunes_date_partitions(spark, scratch):
    path = scratch("silver")
    silver = Q.silver(spark, SF).withColumn("usage_date", F.to_date("interval_start_dt"))
    sinks.write_table(silver, path, cluster_by=("usage_date", "esiid"))
    day = B.day_intervals(spark.read.parquet(path), "2024-01-15")
    parts = re.findall(r"PartitionFilters: \[[^\]]*\]", _plan(day))
    assert len(parts) == 1 and re.search(r"\(usage_date#\d+ = 2024-01-15\)", parts[0])
    assert day.count() == Q.q_day_intervals(spark, SF).count()
