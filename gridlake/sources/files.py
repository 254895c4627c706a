"""Reading files: partitioned scans, CSV, rasters, listings and their bookkeeping."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from datetime import date

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.indicators import date_from_name
from gridlake.model import EFFORT_SCHEMA, PRODUCTS
from gridlake.operators.clean import drop_missing
from gridlake.operators.spine import date_spine


def scan_months(spark: SparkSession, root: str, product: str, start: date, end: date) -> DataFrame:
    """Rows of one product from the product/year/month folders that a range of dates touches; other folders aren't read."""
    first, last = start.year * 12 + start.month, end.year * 12 + end.month
    years = F.col("year").between(start.year, end.year)  # pruned even where the month's arithmetic is not
    months = (F.col("year") * 12 + F.col("month")).between(first, last)
    return spark.read.parquet(root).where((F.col("product") == product) & years & months)


def read_effort_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Effort files with a header and the fixed columns; a file with only a header has no row."""
    return spark.read.schema(EFFORT_SCHEMA).csv(list(paths) if not isinstance(paths, str) else paths, header=True)


def ingest_recursive(spark: SparkSession, root: str) -> DataFrame:
    """All CSV files below a folder, with the year taken from the folder that holds each."""
    rows = spark.read.schema(EFFORT_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").csv(root, header=True)
    return rows.withColumn("year", F.regexp_extract("_metadata.file_path", r"/(\d{4})/[^/]*$", 1).try_cast("int"))


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, name, bytes, modified) of every file below a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def fingerprint(spark: SparkSession, roots: Sequence[str]) -> tuple:
    """What changes when files below these folders come, go or are written anew: their number, bytes, newest time and a sum of hashes."""
    own = [F.xxhash64("path", "bytes", "modified").cast("decimal(38,0)"), F.col("bytes")]
    found = [listing(spark, root).agg(F.count("*"), F.sum(own[1]), F.max("modified"), F.sum(own[0])).first() for root in roots]
    return tuple(tuple(row) for row in found)


_HASHED_BYTES = 8 << 20


def arrow_path(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a path as Spark prints it, and the path there. Percent signs in names stand for themselves."""
    scheme, host, plain = re.fullmatch(r"(?s)(?:([a-zA-Z][\w+.-]*):)?(?://([^/]*))?(.*)", path).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem(), plain
    store, prefix = fs.FileSystem.from_uri(f"{scheme}://{host or ''}/")
    return store, f"{prefix.rstrip('/')}{plain}"


def with_digests(found: DataFrame) -> DataFrame:
    """A listing with ``sha256`` of each file's content, read in tasks a few megabytes at a time: memory doesn't depend on a file's size."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path in batch.column("path").to_pylist():
                store, name = arrow_path(path)
                own = hashlib.sha256()
                with store.open_input_stream(name) as stream:
                    while part := stream.read(_HASHED_BYTES):
                        own.update(part)
                out.append(own.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, "sha256"])

    schema = ", ".join(f"`{n}` {kind}" for n, kind in found.dtypes)
    return found.mapInArrow(digest, f"{schema}, sha256 string")


def file_manifest(spark: SparkSession, root: str, run_id: str, pattern: str = "*.parquet") -> DataFrame:
    """(run_id, product, event_date, file, bytes, sha256) of files below product folders, dated by their folder or name.

    Files are hashed as streams. In a store that only Spark's readers can open they are hashed by Spark as one value,
    which can't exceed 2 GB.
    """
    found = listing(spark, root, pattern).select("path", "name", "bytes")
    try:
        arrow_path(root)
        # Listed files are few bytes each; dealt one by one, large ones are hashed side by side.
        hashed = with_digests(found.repartition("path"))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
        hashed = content.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    day = F.nullif(F.regexp_extract("path", r"event_date=(\d{4}-\d{2}-\d{2})", 1), F.lit("")).try_cast("date")
    return hashed.select(
        F.lit(run_id).alias("run_id"),
        F.nullif(F.regexp_extract("path", "product=([^/]+)", 1), F.lit("")).alias("product"),
        F.coalesce(day, date_from_name(F.col("name"))).alias("event_date"),
        F.col("name").alias("file"),
        "bytes",
        "sha256",
    )


def file_count_violations(manifest: DataFrame, products: Sequence[str], start: date, end: date) -> DataFrame:
    """Product days in the range that don't have exactly one file."""
    wanted = date_spine(manifest.sparkSession, start, end).withColumn("product", F.explode(F.array(*[F.lit(p) for p in products])))
    counted = manifest.groupBy("product", "event_date").agg(F.count("*").alias("files"))
    return wanted.join(counted, ["product", "event_date"], "left").select("product", "event_date", F.coalesce("files", F.lit(0)).alias("files")).where("files <> 1")


def file_inventory(spark: SparkSession, root: str, by: str) -> DataFrame:
    """Files and bytes for each value of a partition folder (``by``=value) and format, and the ratio of CSV to Parquet bytes."""
    kind = F.lower(F.element_at(F.split("name", r"\."), -1))
    files = listing(spark, root).select(F.regexp_extract("path", f"{by}=([^/]+)", 1).alias(by), kind.alias("format"), "bytes").where(F.col("format").isin("csv", "parquet"))
    counted = files.groupBy(by, "format").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    size = lambda name: F.sum(F.when(F.col("format") == name, F.col("bytes")))
    ratio = counted.groupBy(by).agg(F.try_divide(size("csv"), size("parquet")).alias("csv_to_parquet"))
    return counted.join(ratio, by)


def pending_files(found: DataFrame, done: DataFrame, overwrite: bool = False) -> DataFrame:
    """Listed files not converted yet: no record of the same name whose conversion is as new as the file."""
    if overwrite:
        return found
    records = done.select("name", F.col("modified").alias("_done")).groupBy("name").agg(F.max("_done").alias("_done"))
    return found.join(records, "name", "left").where(F.col("_done").isNull() | (F.col("modified") > F.col("_done"))).drop("_done")


def raster_to_rows(rasters: DataFrame, sentinels: Sequence[float] = ()) -> DataFrame:
    """Rows (date, lat, lon, value, quality_level) of dense rasters with ``lat``, ``lon`` and ``values`` (and ``quality``) arrays; missing values dropped."""
    quality: Column = F.col("quality")[F.col("i")][F.col("j")].cast("short") if "quality" in rasters.columns else F.lit(None).cast("short")
    lines = rasters.select("*", F.posexplode("values").alias("i", "line"))
    cells = lines.select("*", F.posexplode("line").alias("j", "value"))
    rows = cells.select("date", F.col("lat")[F.col("i")].alias("lat"), F.col("lon")[F.col("j")].alias("lon"), "value", quality.alias("quality_level"))
    return drop_missing(rows, "value", sentinels)


def with_product_metadata(df: DataFrame, column: str = "metric_value") -> DataFrame:
    """Add each row's unit, variable and time of day; the column keeps the reference system and missing policy as metadata, which Parquet stores."""
    spec = F.create_map(*[x for p in PRODUCTS for x in (F.lit(p.id), F.struct(F.lit(p.unit).alias("unit"), F.lit(p.column).alias("variable"), F.lit(p.period).alias("period")))])
    info = {"crs": "EPSG:4326", "resolution": "4km", "missing": "null, NaN, infinity and fill values removed"}
    own = spec[F.col("product")]
    return df.withColumns({"unit": own["unit"], "variable": own["variable"], "period": own["period"]}).withMetadata(column, info)
