"""The folder for written tables that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_stored: list[str] = []


def work_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a local session without one gets a temporary folder, a cluster an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="gridlake-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return f"file://{_own[0]}"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: it is made once, and survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    _stored.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop client, for what Spark's readers and writers don't do: listing, renaming, deleting."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def clear_stored(spark: SparkSession) -> int:
    """Remove the tables that ``stored`` wrote in this session; returns how many. Call it when no result is still to be read."""
    gone = list(_stored)
    for path in gone:
        files, where = file_system(spark, path)
        files.delete(where, True)
        _stored.remove(path)
    return len(gone)
