"""Incremental ingest as a stream: files that have arrived since the last run are read once and written idempotently.

The checkpoint knows the files seen; a run takes what is there (``availableNow``) in batches of bounded size and ends. Rows
are written to one partition for each source file, overwritten as a whole: a batch that is replayed after a failure
writes the same partitions again, and a file of the same year and name that arrives in another folder replaces the rows of the
earlier one. (The stream knows files by path: one overwritten in place isn't noticed.)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.model import EFFORT_SCHEMA

_PARTS = ("year", "source")


@dataclass(frozen=True)
class Ingested:
    """``rows`` read in ``batches`` micro-batches of this run."""

    rows: int
    batches: int


def with_source(rows: DataFrame) -> DataFrame:
    """Rows of files with ``year`` (of the folder that holds the file) and ``source`` (path below the year, which names the file)."""
    path = F.col("_metadata.file_path")
    return rows.withColumns({"year": F.regexp_extract(path, r"/(\d{4})/[^/]*$", 1).try_cast("int"), "source": F.regexp_extract(path, r"/([^/]*)$", 1)})


def write_batch(rows: DataFrame, target: str) -> None:
    """Overwrite the partitions of the files that the rows come from; others stay. The same rows again change nothing."""
    rows.repartition(*_PARTS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*_PARTS).parquet(target)


def ingest_available(spark: SparkSession, source: str, target: str, checkpoint: str, schema: T.StructType = EFFORT_SCHEMA, files_per_batch: int = 1000) -> Ingested:
    """Read the CSV files below ``source`` that no earlier run with this checkpoint has read, and write them to ``target``.

    A file with only a header has no row and writes nothing. Values that can't be read are null.
    """
    files = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", files_per_batch)
    stream = with_source(files.csv(source, header=True)).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = stream.foreachBatch(lambda rows, _: write_batch(rows, target)).start()
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"] > 0]
    return Ingested(sum(p["numInputRows"] for p in progress), len(progress))
