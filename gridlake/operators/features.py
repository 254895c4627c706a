"""Derived indicators of filled cells, roll-up to coarser cells, and the long metric table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.grid import coarse, coarse_grid_id
from gridlake.functions.indicators import coverage, derived_source, pressure, productivity
from gridlake.model import ENVIRONMENT, KEYS, PUBLISHED, RESOLUTIONS_KM

PRODUCTIVE = ("chlor_a", "poc", "nflh")


def daily_means(df: DataFrame, metrics: Sequence[str] = PRODUCTIVE) -> DataFrame:
    return df.groupBy("event_date", "aoi_id").agg(*[F.avg(m).alias(f"avg_{m}") for m in metrics])


def with_pressure(df: DataFrame) -> DataFrame:
    value = pressure(F.col("fishing_hours"), F.col("ocean_productivity_score"))
    return df.withColumn("sustainability_pressure", value).withColumn(
        "sustainability_pressure_source", derived_source(F.col("sustainability_pressure"), "fishing_hours_source", "ocean_productivity_score_source")
    )


def with_indicators(filled: DataFrame, tiled: bool = False) -> DataFrame:
    """Add productivity, pressure, their sources and data_coverage.

    The daily means are windows over the dealing of ``gap_fill`` by area and day; of ``tiled`` rows they are a
    grouping with partial sums, joined back (one row an area and day).
    """
    if tiled:
        filled = filled.join(daily_means(filled), ["event_date", "aoi_id"])
        score = productivity({m: F.col(f"avg_{m}") for m in PRODUCTIVE})
    else:
        day = Window.partitionBy("event_date", "aoi_id")
        score = productivity({m: F.avg(m).over(day) for m in PRODUCTIVE})
    scored = filled.withColumn("ocean_productivity_score", score).withColumn(
        "ocean_productivity_score_source", derived_source(F.col("ocean_productivity_score"), *[f"{m}_source" for m in PRODUCTIVE])
    )
    return with_pressure(scored).withColumn("data_coverage", coverage([f"{m}_source" for m in ENVIRONMENT]))


def feature_columns(df: DataFrame) -> DataFrame:
    values = [column for _, _, column in PUBLISHED]
    return df.select(*KEYS, *values, *[f"{v}_source" for v in values], "data_coverage")


def _rolled_source(metric: str, partly: str) -> Column:
    return F.when(F.count(metric) == 0, "no_data").when(F.bool_and(F.coalesce(F.col(f"{metric}_source") == "observed", F.lit(False))), "observed").otherwise(partly)


def multi_resolution(fine: DataFrame, kms: Sequence[int] = RESOLUTIONS_KM) -> DataFrame:
    """Cells of every resolution: means of metrics and coverage, sums of hours, pressure from the rolled values. One shuffle for all."""
    staged = fine.withColumn("resolution_km", F.explode(F.array(*[F.lit(k) for k in kms])))
    staged = staged.withColumns({c: coarse(F.col(c), F.col("resolution_km")) for c in ("grid_row", "grid_col")})
    means = ("chlor_a", "sea_temperature_celsius", "ocean_productivity_score")
    rolled = staged.groupBy("event_date", "aoi_id", "resolution_km", "grid_row", "grid_col").agg(
        *[F.avg(m).alias(m) for m in means],
        F.sum("fishing_hours").alias("fishing_hours"),
        F.avg("data_coverage").alias("data_coverage"),
        *[_rolled_source(m, "derived_with_fill" if m.startswith("ocean") else "contains_filled").alias(f"{m}_source") for m in means],
        F.when(F.bool_and(F.col("fishing_hours_source") == "observed"), "observed").otherwise("zero_filled").alias("fishing_hours_source"),
    )
    return with_pressure(rolled).withColumn("grid_id", coarse_grid_id(F.col("resolution_km"), F.col("grid_row"), F.col("grid_col")))


def long_metrics(wide: DataFrame) -> DataFrame:
    """One row for each published metric of a cell, from one pass over the wide table."""
    cells = ", ".join(f"'{p}', '{m}', {c}, {c}_source" for p, m, c in PUBLISHED)
    keys = "event_date", "aoi_id", "resolution_km", "grid_id", "grid_row", "grid_col", "data_coverage"
    return wide.selectExpr(*keys, f"stack({len(PUBLISHED)}, {cells}) as (product_id, metric_id, metric_value, value_source)")
