"""Staged releases of a partitioned table on plain Parquet: replaced ranges, merges and compaction that readers never see half done.

    <root>/data/batch=<id>/<partition>=<value>/...   files, written beside each other and never changed
    <root>/releases/<number>-<id>/                    a release: one row a file, with its partition, bytes and rows
    <root>/current                                    the pointer, which names the release in force

A write goes to a batch folder of its own. Its files and those that stay make the next release, which is checked as a reader
would see it; renaming one small file then makes it current. Whatever fails before that leaves the old release in force, and
what a failed write left is not part of any release (``expire`` removes it). Partitions that don't change are named again, not
rewritten. One writer at a time: a writer whose base is no longer current gives up.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.grid import morton
from gridlake.sources.workspace import file_system

_SORTED_BY = ("product_id", "metric_id", "grid_id")
Check = Callable[[DataFrame], DataFrame]


class ReleaseError(RuntimeError):
    """A release was not made current."""


@dataclass(frozen=True)
class Release:
    number: int
    manifest: str
    schema: str


class ReleasedTable:
    """A table below ``root`` with the given partition columns; ``event_date`` must be one where ranges are replaced."""

    def __init__(self, spark: SparkSession, root: str, partitions: Sequence[str]):
        self.spark, self.root, self.partitions = spark, root.rstrip("/"), list(partitions)

    # ---- reading -----------------------------------------------------------------------------------------------

    def current(self) -> Release | None:
        files, where = file_system(self.spark, f"{self.root}/current")
        if not files.exists(where):
            return None
        stream = files.open(where)
        try:
            return Release(**json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _must(self) -> Release:
        release = self.current()
        if release is None:
            raise ReleaseError(f"{self.root} has no release")
        return release

    def _schema(self, release: Release) -> T.StructType:
        return T.StructType.fromJson(json.loads(release.schema))

    def files(self, release: Release | None = None) -> DataFrame:
        """The partition columns, ``file`` (below data/), ``bytes`` and ``rows`` of each file of a release, the current one by default."""
        release = release or self._must()
        return self.spark.read.schema(_manifest_schema(self._schema(release), self.partitions)).parquet(f"{self.root}/releases/{release.manifest}")

    def read(self, where: Column | str | None = None, release: Release | None = None) -> DataFrame:
        """The rows of a release. ``where`` is on partition columns: only files of partitions that it keeps are named to Spark."""
        release = release or self._must()
        return self._rows(self.files(release) if where is None else self.files(release).where(where), self._schema(release))

    def _rows(self, files: DataFrame, schema: T.StructType) -> DataFrame:
        names = [f"{self.root}/data/{r.file}" for r in files.select("file").collect()]  # names of the asked partitions' files
        if not names:
            return self.spark.createDataFrame([], schema)
        # Typed by the release, so no footer is read for the schema; the batch is a folder above the partitions.
        whole = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
        return self.spark.read.schema(whole).option("basePath", f"{self.root}/data").parquet(*names).select(*schema.names)

    # ---- writing -----------------------------------------------------------------------------------------------

    def _staged(self, df: DataFrame, sorted_by: Sequence[Column | str], extra: Sequence[str] = (), **options: str | int) -> DataFrame:
        """Write a batch; its manifest. ``extra``: columns that deal the rows but aren't kept."""
        batch, seen = uuid.uuid4().hex, Observation()
        kept = [c for c in df.columns if c not in extra]
        dealt = df.repartition(*self.partitions, *extra).sortWithinPartitions(*self.partitions, *extra, *sorted_by)
        out = f"{self.root}/data/batch={batch}"
        counted = dealt.select(*kept).observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.option("compression", "zstd").options(**options).partitionBy(*self.partitions).parquet(out)
        schema = T.StructType([df.schema[c] for c in kept])
        found, where = file_system(self.spark, out)
        manifest = _manifest_schema(schema, self.partitions)
        if not any(s.isDirectory() for s in found.listStatus(where)):
            return self.spark.createDataFrame([], manifest)
        read = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.StringType())])).option("basePath", f"{self.root}/data").parquet(out)
        # Counts come from the footers; no column is read.
        files = read.select(*self.partitions, _file_name().alias("file"), F.col("_metadata.file_size").alias("bytes"))
        files = files.groupBy(*self.partitions, "file", "bytes").agg(F.count("*").alias("rows")).select(*manifest.names)
        if (files.agg(F.sum("rows")).first()[0] or 0) != seen.get["rows"]:
            raise ReleaseError("the files written hold other rows than were given")
        return files

    def _release(self, files: DataFrame, schema: T.StructType, base: Release | None, check: Check | None) -> Release:
        number = base.number + 1 if base else 1
        release = Release(number, f"{number}-{uuid.uuid4().hex}", json.dumps(json.loads(schema.json())))
        files.write.parquet(f"{self.root}/releases/{release.manifest}")
        if check is not None:
            broken = check(self.read(release=release))
            first = broken.first()
            if first is not None:
                raise ReleaseError(f"release {number} is not made current: {first.asDict()}")
        if self.current() != base:
            raise ReleaseError("another release was made current meanwhile")
        self._point(release)
        return release

    def _point(self, release: Release) -> None:
        """Make a release current by renaming a file over the pointer, which is one step on a file system with atomic renames."""
        jvm = self.spark._jvm
        files, new = file_system(self.spark, f"{self.root}/.current-{uuid.uuid4().hex}")
        stream = files.create(new, False)
        stream.write(bytearray(json.dumps(release.__dict__).encode()))
        stream.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(new, jvm.org.apache.hadoop.fs.Path(f"{self.root}/current"), how)

    def _order(self, df: DataFrame) -> list[str]:
        return [c for c in _SORTED_BY if c in df.columns and c not in self.partitions]

    def publish(self, df: DataFrame, check: Check | None = None, **options: str | int) -> Release:
        """A release of these rows alone. ``check`` gets the table as readers will see it and gives what is wrong with it; any row stops the release."""
        return self._release(self._staged(df, self._order(df), **options), df.schema, self.current(), check)

    def _same_columns(self, df: DataFrame, base: Release) -> DataFrame:
        schema = self._schema(base)
        if sorted(schema.names) != sorted(df.columns):
            raise ValueError(f"the table has the columns {schema.names}, the rows {df.columns}")
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])

    def merge(self, batch: DataFrame, check: Check | None = None, **options: str | int) -> Release:
        """Partitions that the batch has replace the current ones as a whole; others stay. Without a release, the batch is the first."""
        base = self.current()
        if base is None:
            return self.publish(batch, check, **options)
        rows = self._same_columns(batch, base)
        new = self._staged(rows, self._order(rows), **options)
        kept = _without(self.files(base), new.select(*self.partitions).distinct(), self.partitions)
        return self._release(kept.unionByName(new), self._schema(base), base, check)

    def replace_range(self, new: DataFrame, start: date, end: date, check: Check | None = None, **options: str | int) -> Release:
        """The new rows replace all that the dates from ``start`` to ``end`` held; a date without new rows is empty then. Rows outside the range are refused."""
        if "event_date" not in self.partitions:
            raise ValueError("ranges are replaced in tables partitioned by event_date")
        base = self._must()
        rows = self._same_columns(new, base)
        staged = self._staged(rows, self._order(rows), **options)
        inside = F.coalesce(F.col("event_date").between(F.lit(start), F.lit(end)), F.lit(False))
        if not staged.where(~inside).isEmpty():
            raise ReleaseError("new rows lie outside the range")
        return self._release(self.files(base).where(~inside).unionByName(staged), self._schema(base), base, check)

    # ---- maintenance -------------------------------------------------------------------------------------------

    def bins(self, target_bytes: int, small_bytes: int | None = None) -> DataFrame:
        """Small files of the current release that are to become one: ``file``, its partition and ``bin``. From the manifest alone.

        In each partition small files (below half of the target by default) are packed in order of their names until the
        target is reached; a bin of one file stays as it is.
        """
        small = self.files().where(F.col("bytes") < (target_bytes // 2 if small_bytes is None else small_bytes))
        upto = Window.partitionBy(*self.partitions).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
        packed = small.withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(upto), F.lit(0)) / F.lit(target_bytes)))
        return packed.withColumn("_files", F.count("*").over(Window.partitionBy(*self.partitions, "bin"))).where("_files > 1").drop("_files")

    def compact(self, target_bytes: int = 256 << 20, small_bytes: int | None = None, check: Check | None = None, **options: str | int) -> Release:
        """Rewrite small files of each partition as files of about the target size; rows, partitions and large files stay.

        Rows with a grid cell are sorted along the Morton curve of row and column, so that a row group covers a compact
        box and its statistics exclude it from queries of other boxes. Files hold at least one bin.
        """
        base = self._must()
        schema, bins = self._schema(base), self.bins(target_bytes, small_bytes).select("file", "bin")
        names = [f"{self.root}/data/{r.file}" for r in bins.select("file").collect()]
        if not names:
            return base
        whole = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
        rows = self.spark.read.schema(whole).option("basePath", f"{self.root}/data").parquet(*names)
        rows = rows.select(*schema.names, _file_name().alias("file"))
        cells = {"grid_row", "grid_col"} <= set(schema.names)
        order = [morton(F.col("grid_row"), F.col("grid_col"))] if cells else self._order(rows)
        staged = self._staged(rows.join(bins, "file").drop("file"), order, extra=["bin"], **options)
        kept = self.files(base).join(bins.select("file"), "file", "left_anti")
        return self._release(kept.unionByName(staged), schema, base, check)

    def expire(self, keep: int = 2) -> int:
        """Remove all but the last releases and the batches that they don't name; returns how many folders went. Run it while nobody writes."""
        current = self._must()
        found, where = file_system(self.spark, f"{self.root}/releases")
        names = [s.getPath().getName() for s in found.listStatus(where)]
        made = sorted((n for n in names if int(n.split("-")[0]) <= current.number), key=lambda n: (int(n.split("-")[0]), n == current.manifest))
        kept = [*made[max(0, len(made) - keep) :]]
        batch = F.regexp_extract("file", "^(batch=[^/]+)", 1)
        used = {r[0] for r in self.spark.read.parquet(*[f"{self.root}/releases/{n}" for n in kept]).select(batch).distinct().collect()}
        gone = [f"releases/{n}" for n in names if n not in kept]
        _, data = file_system(self.spark, f"{self.root}/data")
        gone += [f"data/{s.getPath().getName()}" for s in found.listStatus(data) if s.getPath().getName() not in used]
        for name in gone:
            found.delete(file_system(self.spark, f"{self.root}/{name}")[1], True)
        return len(gone)


def _file_name() -> Column:
    """The name of a row's file below data/, as the file system has it; Spark gives it percent-encoded."""
    return F.url_decode(F.replace(F.regexp_extract("_metadata.file_path", r"/data/(batch=.*)$", 1), F.lit("+"), F.lit("%2B")))


def _manifest_schema(schema: T.StructType, partitions: Sequence[str]) -> T.StructType:
    own = [T.StructField(c, schema[c].dataType) for c in partitions]
    return T.StructType([*own, T.StructField("file", T.StringType()), T.StructField("bytes", T.LongType()), T.StructField("rows", T.LongType())])


def _without(files: DataFrame, gone: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The files of partitions that aren't in ``gone``; a null partition value equals another."""
    other = gone.select(*[F.col(c).alias(f"_{c}") for c in partitions])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in partitions]
    return files.join(other, on=same, how="left_anti")
