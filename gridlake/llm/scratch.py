"""Written tables that cut lineage, in the folder that driver and executors share.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Where that is unset, a local session gets a
temporary folder of its own (removed when Python exits); a cluster session gets an error, since a machine-local
folder would not be seen by other executors. Tables written here are needed until the query that reads them has
run; ``clear_scratch`` removes all that this session wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridlake.sources.workspace import new_folder

_written: list[str] = []


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: later plans start from the files, and survive lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    _written.append(path)
    again = spark.read.schema(df.schema).parquet(path)
    again._scratch_path = path
    return again


def settled(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """Save what ``build`` gives, and remove the tables that were written on the way."""
    before = set(_written)
    done = saved(build(), name)
    for path in [x for x in _written if x not in before and x != done._scratch_path]:
        _remove(done.sparkSession, path)
    return done


def dropped(df: DataFrame) -> None:
    """Remove the files of a table from ``saved`` that no later plan reads."""
    _remove(df.sparkSession, df._scratch_path)


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    if path in _written:
        _written.remove(path)


def clear_scratch(spark: SparkSession) -> int:
    """Remove every table written here by this session; returns how many. Call it when no result is still to be read."""
    gone = list(_written)
    for path in gone:
        _remove(spark, path)
    return len(gone)
