"""Shared folder for intermediate tables.

Tables that several jobs read are written once and read back, so a lost executor costs a re-read
and not the whole lineage. The folder comes from ``spark.checkpoint.dir``; only a local session
without that setting gets a temporary one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_base: dict[str, str] = {}
_handed_out: dict[str, list[str]] = {}


def shared_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_base:
        _local_base[sc.applicationId] = tempfile.mkdtemp(prefix="speechloom-")
    return _local_base[sc.applicationId]


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing folder name below the shared base."""
    path = f"{shared_base(spark)}/speechloom-{purpose}-{uuid.uuid4().hex}"
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Remove every intermediate folder of this application; call it when its results are stored."""
    for path in _handed_out.pop(spark.sparkContext.applicationId, []):
        discard(spark, path)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return it as a scan of that table."""
    return written_at(df, fresh_dir(df.sparkSession, purpose))


def written_at(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _hadoop_path(spark, path)
    return fs.exists(hadoop_path)


def make_dir(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _hadoop_path(spark, path)
    fs.mkdirs(hadoop_path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that this package wrote and no job reads any more."""
    if "/speechloom-" not in path:
        raise ValueError(f"not an intermediate table: {path}")
    hadoop_path, fs = _hadoop_path(spark, path)
    fs.delete(hadoop_path, True)
