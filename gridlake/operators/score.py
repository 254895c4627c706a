"""Publish complete metric-days and rank their cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.indicators import display_level
from gridlake.model import SCOPE
from gridlake.operators.features import long_metrics, multi_resolution
from gridlake.operators.rank import ranked

TIE_DIGITS = 9
#: Cells of a metric-day that one task may sort; larger ones are ranked in ranges.
TASK_CELLS = 200_000
#: Added before rounding: means of values with few digits often lie halfway between two roundings, where noise would decide.
OFF_HALVES = 1.234e-11


METRIC_DAY = ("event_date", "aoi_id", "product_id", "metric_id")


def _invalid() -> Column:
    return F.col("metric_value").isNull() | F.isnan("metric_value")


def complete_scopes(df: DataFrame) -> DataFrame:
    """Drop a metric-day of an area at every resolution when any of its values is null or NaN."""
    day = Window.partitionBy(*METRIC_DAY)
    return df.withColumn("_bad", F.sum(_invalid().cast("int")).over(day)).where("_bad = 0").drop("_bad")


def _comparable() -> Column:
    return F.round(F.col("metric_value") + F.lit(OFF_HALVES), TIE_DIGITS)


def _scored(df: DataFrame, rank: Column, cells: Column) -> DataFrame:
    idle = (F.col("product_id") == "GFW") & (F.col("metric_value") <= 0)
    score = F.when(idle, 0.0).when(cells == 1, 100.0).otherwise(rank)
    return df.withColumn("relative_score", score).withColumn("display_level", display_level(F.col("relative_score")))


def relative_score(df: DataFrame) -> DataFrame:
    """Add relative_score, 0 to 100 by rank inside date, area, metric and resolution, and display_level.

    Cells without fishing score 0 but stay in the ranking; a cell alone scores 100. Values are compared after
    rounding to 9 digits, so that noise in the last bits of a mean can't break a tie. A task sorts a whole scope; for
    scopes beyond ``TASK_CELLS`` take ``relative_score_in_ranges``.
    """
    scope = Window.partitionBy(*SCOPE).orderBy(_comparable())
    cells = F.count("*").over(scope.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return _scored(df, F.percent_rank().over(scope) * 100.0, cells)


def _in_ranges(df: DataFrame, gated: bool) -> DataFrame:
    holes = {"_holes": (_invalid().cast("int"), METRIC_DAY)}
    placed = ranked(df, SCOPE, _comparable(), ["grid_id"], holes if gated else {})
    if gated:
        placed = placed.where("_holes = 0").drop("_holes")
    rank = F.try_divide(F.col("rank") - 1, F.col("group_rows") - 1) * 100.0
    return _scored(placed, rank, F.col("group_rows")).drop("rank", "group_rows")


def relative_score_in_ranges(df: DataFrame) -> DataFrame:
    """``relative_score`` for scopes of any size: a task holds a range of values, never a scope (see ``rank``)."""
    return _in_ranges(df, gated=False)


def map_metric_in_ranges(fine: DataFrame) -> DataFrame:
    """``map_metric`` for scopes of any size. The gate counts the holes of a range with its rows, so it needs no pass of its own."""
    return _in_ranges(long_metrics(multi_resolution(fine)), gated=True)


def map_metric(fine: DataFrame) -> DataFrame:
    """The whole map table of fine features: rolled up, long, scored and complete.

    The gate drops whole scopes, so it may follow the ranking; then both use one sort, in the partitions of the roll-up.
    """
    return complete_scopes(relative_score(long_metrics(multi_resolution(fine))))
