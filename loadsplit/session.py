"""Session construction and the shared scratch location.

The scratch location is the shared folder named by ``spark.checkpoint.dir``.
One is made up only for a local master without the setting; a cluster without
it is an error, as executors cannot read each other's temporary folders.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
}


def get_spark(master: str | None = None, app: str = "loadsplit",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set one only if unset and
    the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="loadsplit-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - a core setting may be read-only at runtime
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/loadsplit/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``scratch_path`` once nothing reads it any more."""
    if not path.startswith(f"{checkpoint_root(spark).rstrip('/')}/loadsplit/"):
        raise ValueError(f"not a scratch folder: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, for
    clusters where it is not installed."""
    sc = spark.sparkContext
    if getattr(sc, "_loadsplit_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="loadsplit-code-"), "loadsplit_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(os.path.join(top, "loadsplit")):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), top))
    sc.addPyFile(path)
    sc._loadsplit_shipped = True


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python-side helpers can test paths."""
    return path[5:] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """False when nothing is at ``path``, or a folder without any file of a
    table yet; every other error of reading it is raised."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
