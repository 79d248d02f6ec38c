"""E5-E7 and the E8 file sink: Parquet stage tables and CSV exports.

Stage tables are Parquet partitioned by ``usage_date`` with dynamic partition
overwrite, so a re-run replaces only the days it recomputes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsplit import schemas


def write_table(df: DataFrame, path: str, partition_by: str | None = "usage_date", mode: str = "append",
                cluster_by: tuple[str, ...] | None = None) -> None:
    """E5: persist a stage; ``mode='overwrite'`` replaces only the partitions
    present in ``df`` (dynamic partition overwrite).

    ``cluster_by`` (e.g. ``("usage_date", "esiid")``) range-partitions the rows
    and sorts them within each task before writing: each date directory gets
    a few large files instead of one per task, a date holding a large share
    of rows is split across several tasks by the second key, and the sort
    tightens Parquet min/max statistics for pushdown on ``esiid``.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def reset_table(spark: SparkSession, path: str, df: DataFrame, partition_by: str | None = "usage_date") -> None:
    """Drop and recreate a stage table from ``df`` (static overwrite)."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header, no index, overwrite (one part file per task)."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """Move one file, over what has the name."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    fs.delete(target, False)
    if not fs.rename(source, target):
        raise OSError(f"cannot write {target}")


def _part_files(spark: SparkSession, folder: str) -> list[str]:
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*")
    return [f.getPath().toString() for f in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []]


def write_named_csv(df: DataFrame, path: str) -> None:
    """E7 as one file of that name, in the order of ``df``: for tables of one row, or
    one an appliance, a date."""
    spark = df.sparkSession
    aside = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    df.coalesce(1).write.option("header", "true").csv(aside)
    for part in _part_files(spark, aside):
        _rename(spark, part, path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(aside)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_meter_files(raw: DataFrame, root: str) -> None:
    """E8 as the files ``YYYY/MM/YYYYMMDD.csv`` named by ``source_file``: one file is
    written by one task, then renamed; a file that is there is replaced. Column
    names and their order are those of ``raw``."""
    spark = raw.sparkSession
    aside = f"{root.rstrip('/')}/.{uuid.uuid4().hex[:8]}.tmp"
    day = F.regexp_extract("source_file", r"^\d{4}/\d{2}/(\d{8})\.csv$", 1)
    rows = raw.withColumn("_day", day).drop("source_file").where("_day <> ''")
    rows.repartition("_day").sortWithinPartitions("_day").write.option("header", "true") \
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").partitionBy("_day").csv(aside)
    folder = spark._jvm.org.apache.hadoop.fs.Path(aside)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in fs.listStatus(folder):  # one a day
        name = found.getPath().getName()
        if name.startswith("_day="):
            d = name[len("_day="):]
            for part in _part_files(spark, f"{aside}/{name}"):
                _rename(spark, part, f"{root.rstrip('/')}/{d[:4]}/{d[4:6]}/{d}.csv")
    fs.delete(folder, True)


def read_summary_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed read of an E7 daily-summary export."""
    from pyspark.sql import types as T
    cols = ["usage_date", "total_kwh", "hvac_kwh", "washer_kwh", "dryer_kwh", "cooking_kwh", "baseline_kwh",
            "avg_temp_c"]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    df = spark.read.option("header", "true").schema(schema).csv(path)
    return df.select(F.col("usage_date").cast("date").alias("usage_date"),
                     *[F.col(c).cast("double").alias(c) for c in cols[1:]])


def write_meter_export(raw: DataFrame, path: str) -> None:
    """E8 sink: one directory per day, ``year=YYYY/month=MM/day=YYYYMMDD``;
    ``source_file`` is rebuilt from the partition values on read."""
    parts = F.regexp_extract("source_file", r"^(\d{4})/(\d{2})/(\d{8})\.csv$", 0)
    out = raw.select(*[c for c in schemas.RAW_METER.fieldNames()],
                     F.regexp_extract(parts, r"^(\d{4})", 1).alias("year"),
                     F.regexp_extract(parts, r"^\d{4}/(\d{2})", 1).alias("month"),
                     F.regexp_extract(parts, r"(\d{8})\.csv$", 1).alias("day"))
    # no repartition by day: a day holding a large share of rows would land in
    # one task; each task writes its own part file per day instead
    (out.write.mode("overwrite").option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .partitionBy("year", "month", "day").csv(path))


def read_meter_export(spark: SparkSession, path: str) -> DataFrame:
    """Read an E8 export written by :func:`write_meter_export`, all strings."""
    from pyspark.sql import types as T
    schema = T.StructType(list(schemas.RAW_METER.fields) + [
        T.StructField("year", T.StringType()), T.StructField("month", T.StringType()),
        T.StructField("day", T.StringType())])
    df = spark.read.option("header", "true").schema(schema).csv(path)
    src = F.concat_ws("/", "year", "month", F.concat("day", F.lit(".csv")))
    return df.select(*schemas.RAW_METER.fieldNames(), src.alias("source_file"))
