"""Data-quality operators: profiles, verdicts, violations and reports, all as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from gridlake.functions.indicators import shard
from gridlake.model import LEVELS, MAP_KEYS, PUBLISHED, RESOLUTIONS_KM, STATUS_CLASSES
from gridlake.operators.spine import date_spine


class QualityError(RuntimeError):
    """A strict check failed."""


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _invalid(column: str) -> Column:
    return F.col(column).isNull() | F.isnan(F.col(column).cast("double"))


def profile(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row: rows, distinct and null keys, first, last and number of days, and each metric's invalid rows, least and greatest value."""
    return df.agg(
        F.count("*").alias("output_rows"),
        F.countDistinct(F.struct(*keys)).alias("distinct_key_rows"),
        F.count_if(_any([F.col(k).isNull() for k in keys])).alias("null_key_rows"),
        F.min("event_date").alias("min_event_date"),
        F.max("event_date").alias("max_event_date"),
        F.countDistinct("event_date").alias("observed_day_count"),
        *[x for m in metrics for x in (F.count_if(_invalid(m)).alias(f"{m}_invalid"), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"))],
    )


def verdict(profiled: DataFrame, groups: Sequence[Sequence[str]], start: date, end: date) -> DataFrame:
    """Add the checks and ``passed``: rows, unique and present keys, every day, and in each group a metric with values."""
    rows = F.col("output_rows")
    held = [_any([rows - F.col(f"{m}_invalid") > 0 for m in group]) for group in groups]
    checks = {
        "has_rows": rows > 0,
        "duplicate_key_rows": rows - F.col("distinct_key_rows"),
        "missing_day_count": F.lit((end - start).days + 1) - F.col("observed_day_count"),
        "groups_passed": reduce(lambda a, b: a & b, held),
    }
    passed = F.col("has_rows") & (F.col("duplicate_key_rows") == 0) & (F.col("null_key_rows") == 0) & (F.col("missing_day_count") == 0) & F.col("groups_passed")
    return profiled.withColumns(checks).withColumn("passed", passed)


def observed_profile(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], shards: int = 32) -> tuple[DataFrame, Observation]:
    """The rows, dealt by day and shard of cells and sorted by key, and what ``profile`` asks of them, gathered while they are written.

    Repeated keys stand next to each other in the order that the write wants anyway, so they are counted without a shuffle.
    """
    seen = Observation()
    dealt = df.withColumn("_shard", shard(F.col("grid_id"), shards)).repartition("event_date", "_shard")
    key = Window.partitionBy("event_date", "_shard", *[k for k in keys if k != "event_date"]).orderBy("grid_id")
    marked = dealt.withColumn("_again", F.row_number().over(key) > 1)
    metric = [x for m in metrics for x in (F.count_if(_invalid(m)).alias(f"{m}_invalid"), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"))]
    watched = marked.observe(
        seen,
        F.count(F.lit(1)).alias("output_rows"),
        F.count_if("_again").alias("_again"),
        F.count_if(_any([F.col(k).isNull() for k in keys])).alias("null_key_rows"),
        F.min("event_date").alias("min_event_date"),
        F.max("event_date").alias("max_event_date"),
        F.size(F.collect_set("event_date")).cast("long").alias("observed_day_count"),  # a date for each day of the run
        *metric,
    )
    return watched.select(*df.columns), seen


def observed_row(spark: SparkSession, seen: Observation, like: DataFrame) -> DataFrame:
    """The profile that a finished write has gathered, in the columns of ``profile``; no row is read. ``like``: a profile, for the types."""
    got = dict(seen.get)
    got["distinct_key_rows"] = got["output_rows"] - got.pop("_again")
    return spark.createDataFrame([tuple(got[c] for c in like.columns)], like.schema)


def write_judged(df: DataFrame, path: str, keys: Sequence[str], metrics: Sequence[str], groups: Sequence[Sequence[str]], start: date, end: date) -> DataFrame:
    """Write a daily table by day and give its ``verdict``, both in one pass over the rows.

    Rows, repeated and null keys, days and the metrics' invalid rows, least and greatest values come from the write
    itself. Write the report and call ``gate`` on what comes back. An empty table writes nothing and fails.
    """
    watched, seen = observed_profile(df, keys, metrics)
    writer = watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.partitionBy("event_date").parquet(path)
    return verdict(observed_row(df.sparkSession, seen, profile(df, keys, metrics)), groups, start, end)


def report_json(judged: DataFrame, **tags: str) -> DataFrame:
    """The verdict as one JSON document a row, in a column ``value``."""
    return judged.select(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in tags.items()], "*")).alias("value"))


def gate(judged: DataFrame, strict: bool = True) -> DataFrame:
    """Pass a verdict on; when strict, raise on one that failed. Write the report first."""
    if strict and not judged.where("not passed").isEmpty():
        raise QualityError("quality check failed: " + judged.where("not passed").toJSON().first())
    return judged


def unexplained(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows with a NaN, a null not marked no_data, or a value marked no_data or without a source."""
    bad = []
    for value, source in pairs:
        none = F.coalesce(F.col(source) == "no_data", F.lit(False))
        bad.append(F.coalesce(F.isnan(value), F.lit(False)) | (F.col(value).isNull() & ~none) | (F.col(value).isNotNull() & (F.col(source).isNull() | none)))
    return df.where(_any(bad))


def missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(_any([_invalid(c) for c in columns]))


def require_rows(**tables: DataFrame) -> DataFrame:
    """(dataset, nonempty) for each table; reads one row of each at most."""
    first = next(iter(tables.values())).sparkSession
    flags = [first.range(1).select(F.lit(name).alias("dataset")).join(df.limit(1).select(F.lit(1).alias("_one")), how="left", on=F.lit(True)) for name, df in tables.items()]
    return reduce(DataFrame.union, flags).select("dataset", F.col("_one").isNotNull().alias("nonempty"))


def expected_scopes(spark: SparkSession, area_id: str, start: date, end: date) -> DataFrame:
    """Every date, published metric and resolution of an area."""
    specs = F.array(*[F.struct(F.lit(p).alias("product_id"), F.lit(m).alias("metric_id")) for p, m, _ in PUBLISHED])
    days = date_spine(spark, start, end).withColumns({"aoi_id": F.lit(area_id), "resolution_km": F.explode(F.array(*[F.lit(k) for k in RESOLUTIONS_KM]))})
    return days.select("event_date", "aoi_id", F.inline(specs), "resolution_km")


def omitted_scopes(published: DataFrame, area_id: str, start: date, end: date) -> DataFrame:
    """Expected scopes that the map table lacks."""
    expected = expected_scopes(published.sparkSession, area_id, start, end)
    return expected.join(published.select(*expected.columns).distinct(), expected.columns, "left_anti").withColumn("reason", F.lit("incomplete_metric_scope"))


def degraded_report(published: DataFrame, area_id: str, start: date, end: date) -> DataFrame:
    """Published and omitted scopes of each metric and resolution."""
    expected = expected_scopes(published.sparkSession, area_id, start, end)
    seen = published.select(*expected.columns).distinct().withColumn("_seen", F.lit(1))
    joined = expected.join(seen, expected.columns, "left").groupBy("aoi_id", "product_id", "metric_id", "resolution_km")
    return joined.agg(F.count("_seen").alias("published_scopes"), (F.count("*") - F.count("_seen")).alias("omitted_scopes"))


@dataclass(frozen=True)
class Contract:
    """A table's unique key, columns that are never null or NaN, allowed classes and ranges."""

    key: Sequence[str]
    required: Sequence[str] = ()
    classes: tuple[tuple[str, Sequence[str]], ...] = ()
    ranges: tuple[tuple[str, float, float], ...] = ()


MAP_CONTRACT = Contract(
    MAP_KEYS, ("metric_value", "relative_score"), (("display_level", LEVELS),), (("relative_score", 0.0, 100.0), ("data_coverage", 0.0, 1.0))
)
STATUS_CONTRACT = Contract(("event_date", "aoi_id", "resolution_km", "status_class"), ("cell_count", "cell_ratio"), (("status_class", STATUS_CLASSES),), (("cell_ratio", 0.0, 1.0),))


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """(rule, violations) for each rule; the key needs a shuffle, all else one pass."""
    rules = {"key_not_null": _any([F.col(k).isNull() for k in contract.key])}
    rules |= {f"required_{c}": _invalid(c) for c in contract.required}
    rules |= {f"class_{c}": ~F.coalesce(F.col(c).isin(list(allowed)), F.lit(False)) for c, allowed in contract.classes}
    rules |= {f"range_{c}": ~F.coalesce(F.col(c).between(low, high), F.lit(False)) for c, low, high in contract.ranges}
    wide = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    cells = ", ".join(f"'{name}', {name}" for name in rules)
    one_pass = wide.selectExpr(f"stack({len(rules)}, {cells}) as (rule, violations)")
    repeated = df.groupBy(*contract.key).count().where("count > 1").agg(F.count("*").alias("violations"))
    return one_pass.union(repeated.select(F.lit("key_unique").alias("rule"), "violations"))


def reconcile(**layers: DataFrame) -> DataFrame:
    """Rows of each day in each layer, 0 where a layer lacks the day."""
    tagged = [df.select("event_date", F.lit(name).alias("_layer")) for name, df in layers.items()]
    counted = reduce(DataFrame.union, tagged).groupBy("event_date").pivot("_layer", list(layers)).count()
    return counted.select("event_date", *[F.coalesce(name, F.lit(0)).alias(f"{name}_rows") for name in layers])


def coverage_report(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Pixels, valid and missing ones, and their shares."""
    counted = df.groupBy(*by).agg(F.count("*").alias("total_pixels"), F.count_if(~_invalid(value)).alias("valid_pixels"))
    missing_pixels = F.col("total_pixels") - F.col("valid_pixels")
    ratios = {name: F.try_divide(F.col(name.replace("_ratio", "_pixels")), F.col("total_pixels")) for name in ("valid_ratio", "missing_ratio")}
    return counted.withColumn("missing_pixels", missing_pixels).withColumns(ratios)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, least, exact quartiles and greatest value of each column; one row a column."""
    long = df.selectExpr(f"stack({len(columns)}, {', '.join(f"'{c}', cast({c} as double)" for c in columns)}) as (metric, value)").where("value is not null")
    quartile = lambda q: F.expr(f"percentile(value, {q})")
    return long.groupBy("metric").agg(
        F.count("*").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("stddev"),
        F.min("value").alias("min"),
        *[quartile(q).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)],
        F.max("value").alias("max"),
    )


def dates_per_year(**tables: DataFrame) -> DataFrame:
    """Distinct days of each dataset and year."""
    tagged = [df.select(F.lit(name).alias("dataset"), "event_date") for name, df in tables.items()]
    return reduce(DataFrame.union, tagged).groupBy("dataset", F.year("event_date").alias("year")).agg(F.countDistinct("event_date").alias("days"))
