"""Writing tables: partitioned, sharded and with partitions replaced, on plain Parquet.

Here each partition is replaced on its own, so readers may see some replaced and some not. Replaced ranges, merges and
compaction that take effect at once are in ``releases``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.indicators import shard

SERVING_PARTITIONS = ("event_date", "aoi_id", "resolution_km")
_SORTED_BY = ("product_id", "metric_id", "grid_id")


_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def streamed_writes(spark: SparkSession, files: int = 16) -> Iterator[None]:
    """Writes of partition folders inside stream rows into up to ``files`` open files a task.

    By default Spark first sorts each task's rows by folder, so that a task that writes one large folder holds all its
    rows. A task with more folders sorts what comes after the first ``files`` of them.
    """
    before = spark.conf.get(_OPEN_FILES, None)
    spark.conf.set(_OPEN_FILES, files)
    try:
        yield
    finally:
        spark.conf.unset(_OPEN_FILES) if before is None else spark.conf.set(_OPEN_FILES, before)


def write_monthly(df: DataFrame, out: str, day: str = "date") -> None:
    """Product, year and month folders."""
    dated = df.withColumns({"year": F.year(day), "month": F.month(day)})
    with streamed_writes(df.sparkSession):
        dated.repartition("product", "year", "month").write.mode("overwrite").partitionBy("product", "year", "month").parquet(out)


def write_sharded(df: DataFrame, target: str, shards: int = 32, max_records: int = 2_000_000) -> None:
    """One file or more for each day and shard of cells; days already there and in the data are replaced, others stay."""
    staged = df.withColumn("_shard", shard(F.col("grid_id"), shards)).repartition(shards, "event_date", "_shard").drop("_shard")
    writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    with streamed_writes(df.sparkSession):
        writer.option("maxRecordsPerFile", max_records).partitionBy("event_date").parquet(target)


def write_snapshot(df: DataFrame, target: str, max_records: int = 2_000_000, partitions: Sequence[str] = SERVING_PARTITIONS) -> None:
    writer = df.repartition(*partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    with streamed_writes(df.sparkSession):
        writer.option("maxRecordsPerFile", max_records).partitionBy(*partitions).parquet(target)


def upsert_partitions(df: DataFrame, table: str, partitions: Sequence[str]) -> None:
    """Create a partitioned table, or replace the partitions that the data has; sorted inside each file.

    An existing table is written by its path, so that the overwrite mode belongs to this write and not to the session.
    """
    spark = df.sparkSession
    ordered = df.repartition(*partitions).sortWithinPartitions(*partitions, *[c for c in _SORTED_BY if c in df.columns])
    writer = ordered.write.option("compression", "zstd").partitionBy(*partitions)
    if spark.catalog.tableExists(table):
        where = spark.sql("DESCRIBE TABLE EXTENDED " + table).where("col_name = 'Location'").first().data_type
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(where)
        spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
    else:
        writer.format("parquet").saveAsTable(table)


def write_report(report: DataFrame, path: str) -> None:
    report.select("value").coalesce(1).write.mode("overwrite").text(path)
