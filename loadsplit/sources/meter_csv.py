"""File readers.

Meter exports live at ``<root>/YYYY/MM/YYYYMMDD.csv``. Month folders are listed
inside tasks, so the files of the whole tree never reach the driver. Of each file
to be read its first line is read, also in tasks; files with the same layout are
scanned together with a schema of their own width, and the eight columns are
taken by name. So columns bind by name whatever their order and number, and no
line is shuffled or joined. The paths of the files to be scanned are on the
driver, as they are for every Spark scan.
"""

from __future__ import annotations

import collections
import csv
import functools
import re
import urllib.parse
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsplit import schemas
from loadsplit.constants import METER_FILE_GLOB, METER_PATH_REGEX, RAW_COLUMNS
from loadsplit.session import ship

HEAD_BYTES = 1 << 16     # read at a time until the first line is whole
LISTED = "source_file string, path string, length long, modified timestamp"


def qualified(spark: SparkSession, root: str, encoded: bool = False) -> str:
    """The folder with its scheme, ``file:///...`` for a local one; ``encoded`` as in a URI."""
    home = spark._jvm.org.apache.hadoop.fs.Path(root)
    home = home.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(home)
    name = home.toUri().toString() if encoded else home.toString()
    return re.sub(r"^([A-Za-z0-9+.-]+):/(?!/)", r"\1:///", name).rstrip("/")


def relative_source_file(path: Column, root: str, spark: SparkSession | None = None) -> Column:
    """Path below the data root, e.g. ``2025/05/20250501.csv``; null for a
    file elsewhere."""
    plain = lambda c: F.regexp_replace(c, "^([A-Za-z0-9+.-]+):/+", "$1:/")
    prefix = plain(F.lit(qualified(spark or SparkSession.active(), root, encoded=True) + "/"))
    return F.when(F.startswith(plain(path), prefix), F.substr(plain(path), F.length(prefix) + 1))


# --- listing and headers, in tasks ------------------------------------------------------

def _file_system(name: str):
    """(file system, path in it) for a task's own access; None for a store that only Spark reads."""
    from pyarrow import fs
    scheme, rest = name.split("://", 1)
    try:
        return fs.FileSystem.from_uri(f"{scheme}://{urllib.parse.quote(rest, safe='/:@')}")
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return None


def _list(batches: Iterator[pa.RecordBatch], uri: str) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs
    files, home = _file_system(uri)
    for b in batches:
        for month in b.column(0).to_pylist():
            found = [f for f in files.get_file_info(fs.FileSelector(f"{home}/{month}")) if f.is_file]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{month}/{f.base_name}" for f in found], pa.string()),
                 pa.array([f"{uri}/{month}/{f.base_name}" for f in found], pa.string()),
                 pa.array([f.size for f in found], pa.int64()), pa.array([f.mtime for f in found], pa.timestamp("us", tz="UTC"))],
                ["source_file", "path", "length", "modified"])


def month_folders(spark: SparkSession, root: str) -> list[str]:
    """``YYYY/MM`` below the root: one row a month on the driver."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/[0-9][0-9][0-9][0-9]/[0-9][0-9]")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted("/".join(f.getPath().toString().rsplit("/", 2)[1:]) for f in found if f.isDirectory())


def list_meter_files(spark: SparkSession, root: str) -> DataFrame:
    """Meter files below the root: source_file, path, length, modified."""
    uri = qualified(spark, root)
    if _file_system(uri) is None:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", METER_FILE_GLOB).load(root) \
            .select(relative_source_file(F.col("path"), root, spark).alias("source_file"), "path", "length",
                    F.col("modificationTime").alias("modified"))
    else:
        ship(spark)
        months = month_folders(spark, root)
        dealt = spark.createDataFrame([(m,) for m in months], "month string").repartition(max(1, len(months)))
        files = dealt.mapInArrow(functools.partial(_list, uri=uri), LISTED)
    return files.withColumn("modified", F.date_trunc("MILLISECOND", "modified")).where(F.col("source_file").rlike(METER_PATH_REGEX))


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lines = []
        for path in b.column(b.schema.get_field_index("path")).to_pylist():
            files, name = _file_system(path)
            with files.open_input_stream(name) as f:
                head = b""
                while b"\n" not in head.lstrip() and (more := f.read(HEAD_BYTES)):
                    head += more
            lines.append(head.decode("utf-8-sig", "replace").lstrip().split("\n", 1)[0].rstrip("\r"))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lines, pa.string())], [*b.schema.names, "header"])


def with_headers(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``files`` with ``header``, the first line of each that is not blank."""
    files = files.select("source_file", "path", "length", "modified")
    one = files.select("path").first()
    if one is not None and _file_system(one[0]) is None:  # read through Spark: the line that names the columns
        paths = [r[0] for r in files.select("path").collect()]
        lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("header"))
        named = sum(F.upper("header").contains(c).cast("int") for c in RAW_COLUMNS) >= 2
        return files.join(lines.where(named).groupBy("path").agg(F.min("header").alias("header")), "path", "left")
    ship(spark)
    return files.mapInArrow(_first_lines, T.StructType([*files.schema.fields, T.StructField("header", T.StringType())]))


def header_names(line: str) -> list[str]:
    """Names as they bind: trimmed, upper case, without byte order mark."""
    return [c.lstrip("﻿").strip().upper() for c in next(csv.reader([line]), [])]


def normalize_headers(df: DataFrame) -> DataFrame:
    """Trim and upper-case column names."""
    return df.toDF(*[c.strip().upper() for c in df.columns])


def with_lineage(df: DataFrame, root: str) -> DataFrame:
    """``source_file`` relative to the data root, from the scan's file
    metadata; files outside the expected layout drop out (the load timestamp is
    added by ``to_bronze``)."""
    df = df.withColumn("source_file", relative_source_file(F.col("_metadata.file_path"), root, df.sparkSession))
    return df.where(F.col("source_file").rlike(METER_PATH_REGEX))


# --- rows -----------------------------------------------------------------------------

def read_files(spark: SparkSession, root: str, headed: Iterable[tuple[str, str]]) -> DataFrame:
    """Rows of the files (path, header line) as the eight columns by name,
    source_file and ``missing_columns``, true where the file lacks one of them.
    One scan for each layout (width and places of the eight columns)."""
    layouts = collections.defaultdict(list)
    for path, header in headed:
        names = header_names(header or "")
        layouts[len(names), tuple(names.index(c) if c in names else -1 for c in RAW_COLUMNS)].append(path)
    rows = None
    for (width, places), paths in sorted(layouts.items()):
        schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(max(width, 1))])
        scan = spark.read.schema(schema).option("header", "true").option("enforceSchema", "true").csv(sorted(paths))
        found = with_lineage(scan, root).select(
            *[(F.col(f"c{k}") if k >= 0 else F.lit(None).cast("string")).alias(c) for c, k in zip(RAW_COLUMNS, places)], "source_file",
            F.lit(min(places) < 0).alias("missing_columns"))
        rows = found if rows is None else rows.unionByName(found)
    if rows is None:
        rows = spark.createDataFrame([], schemas.RAW_METER).withColumns(
            {"source_file": F.lit(""), "missing_columns": F.lit(False)})
    return rows


def read_meter_csv(spark: SparkSession, root: str, files: DataFrame | None = None) -> DataFrame:
    """S1 + S2 + S9: all ``YYYY/MM/YYYYMMDD.csv`` below ``root`` (or just ``files`` of
    its listing) as strings bound by name, with ``source_file`` relative to the
    root. A column that a file lacks is null."""
    headed = with_headers(spark, list_meter_files(spark, root) if files is None else files)
    return read_files(spark, root, [(r["path"], r["header"]) for r in headed.collect()]).drop("missing_columns")


def read_weather_csv(spark: SparkSession, path: str) -> DataFrame:
    """``datetime,temp_c`` -> (TIMESTAMP_NTZ, DOUBLE)."""
    df = spark.read.option("header", "true").schema(schemas.WEATHER_RAW).csv(path)
    return df.select(
        F.try_to_timestamp(F.trim("datetime")).cast("timestamp_ntz").alias("datetime"),
        F.col("temp_c").try_cast("double").alias("temp_c"),
    )


def read_station_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw station export; only DATE and dry-bulb are kept (S12 types them)."""
    df = spark.read.option("header", "true").csv(path)
    return df.select("DATE", "HourlyDryBulbTemperature")


def read_station_readings(df: DataFrame) -> DataFrame:
    """Pick DATE and dry-bulb, type them, drop rows with either null.
    Typed columns are used as they are; strings are parsed with ``try_*``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    date = F.col("DATE")
    if isinstance(types["DATE"], (T.TimestampNTZType, T.TimestampType, T.DateType)):
        ts = date.cast("timestamp_ntz")
    else:
        ts = F.try_to_timestamp(date.cast("string")).cast("timestamp_ntz")
    temp = F.col("HourlyDryBulbTemperature")
    temp = temp.cast("double") if isinstance(types["HourlyDryBulbTemperature"], T.NumericType) \
        else temp.cast("string").try_cast("double")
    return df.select(ts.alias("reading_ts"), temp.alias("temp_c")).dropna(subset=["reading_ts", "temp_c"])
