"""Queries over the serving tables. Each returns a lazy DataFrame; filters on date, area and resolution prune partitions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.model import AREAS, PUBLISHED, RESOLUTIONS_KM, SCORE_COLUMNS, SCOPE

MOST_CELLS = 500_000
TREND_DAYS = (15, 30, 90)


def _checked(aoi: str | None = None, product: str | None = None, metric: str | None = None, resolution: int | None = None) -> list[Column]:
    """Conditions for the arguments given; ValueError for one that isn't published."""
    if aoi is not None and aoi not in AREAS:
        raise ValueError(f"unknown area: {aoi}")
    if not any(product in (None, p) and metric in (None, m) for p, m, _ in PUBLISHED):
        raise ValueError(f"unknown product and metric: {product}, {metric}")
    if resolution is not None and resolution not in RESOLUTIONS_KM:
        raise ValueError(f"resolution must be one of {RESOLUTIONS_KM}")
    given = {"aoi_id": aoi, "product_id": product, "metric_id": metric, "resolution_km": resolution}
    return [F.col(name) == value for name, value in given.items() if value is not None]


def _where(df: DataFrame, conditions: list[Column]) -> DataFrame:
    for condition in conditions:
        df = df.where(condition)
    return df


def availability(cells: DataFrame, aoi: str | None = None, product: str | None = None, metric: str | None = None, resolution: int | None = None) -> DataFrame:
    """Cells of each published scope, sorted."""
    return _where(cells, _checked(aoi, product, metric, resolution)).groupBy(*SCOPE).agg(F.count("*").alias("cells")).orderBy(*SCOPE)


def daily_grid(cells: DataFrame, day: date, aoi: str, product: str, metric: str, resolution: int, most: int = 100_000) -> DataFrame:
    """The cells of one scope by row and column, with ``value`` for the map: one row more than ``most`` tells that there are too many."""
    if not 1 <= most <= MOST_CELLS:
        raise ValueError(f"between 1 and {MOST_CELLS} cells can be asked for")
    scope = _where(cells.where(F.col("event_date") == F.lit(day)), _checked(aoi, product, metric, resolution))
    columns = "grid_id", "grid_row", "grid_col", "relative_score", "display_level", "value_source", "data_coverage"
    return scope.select(*columns, F.col("relative_score").alias("value"), "resolution_km").orderBy("grid_row", "grid_col").limit(most + 1)


def daily_summary(daily: DataFrame, day: date, aoi: str, product: str, metric: str, resolution: int) -> DataFrame:
    """The dashboard row of one day, its ``average`` being the metric's mean score."""
    _checked(aoi, product, metric, resolution)
    row = _where(daily.where(F.col("event_date") == F.lit(day)), _checked(aoi, resolution=resolution))
    return row.withColumn("average", F.col(SCORE_COLUMNS[metric]))


def summary_components(summary: DataFrame) -> DataFrame:
    """The three high-cell shares as percent and text; one that is not available is left out rather than shown as 0."""
    parts = {"high_productivity": "high_productivity_cell_ratio", "high_activity": "high_activity_cell_ratio", "high_pressure": "high_pressure_cell_ratio"}
    cells = ", ".join(f"'{name}', {column} * 100" for name, column in parts.items())
    stacked = summary.selectExpr("event_date", "aoi_id", "resolution_km", f"stack({len(parts)}, {cells}) as (component, percent)").where("percent is not null")
    return stacked.withColumn("text", F.format_string("%.1f%%", "percent"))


def trend(daily: DataFrame, day: date, aoi: str, product: str, metric: str, resolution: int, window: int | None = 30) -> DataFrame:
    """The metric's mean score on each day around a date (15, 30 or 90 days to either side), or on all days (None)."""
    if window is not None and window not in TREND_DAYS:
        raise ValueError(f"the window must be one of {TREND_DAYS} or None")
    _checked(aoi, product, metric, resolution)
    rows = _where(daily, _checked(aoi, resolution=resolution))
    if window is not None:
        rows = rows.where(F.col("event_date").between(F.lit(day - timedelta(days=window)), F.lit(day + timedelta(days=window))))
    return rows.select("event_date", F.col(SCORE_COLUMNS[metric]).alias("value")).where("value is not null").orderBy("event_date")


def status_by_scope(status: DataFrame, day: date, aoi: str, resolution: int) -> DataFrame:
    """The status classes of one day; no row means that the scope isn't available."""
    rows = _where(status.where(F.col("event_date") == F.lit(day)), _checked(aoi, resolution=resolution))
    return rows.select("status_class", "cell_count", "cell_ratio", "fishing_hours_total", "productivity_score_avg", "fishing_score_avg").orderBy("status_class")


def asof_date(available: DataFrame, preferred: date) -> DataFrame:
    """The preferred date if there are cells for it, else the latest before it, else the last of all."""
    earlier = F.max(F.when(F.col("event_date") <= F.lit(preferred), F.col("event_date")))
    return available.agg(F.coalesce(earlier, F.max("event_date")).alias("event_date"))


#: Narrow tables for serving: columns of each, without audit columns.
SERVING_COLUMNS = {
    "map_metric": ("event_date", "aoi_id", "product_id", "metric_id", "resolution_km", "grid_id", "grid_row", "grid_col", "metric_value", "relative_score", "display_level", "value_source", "data_coverage"),
    "status_distribution": ("event_date", "aoi_id", "resolution_km", "status_class", "cell_count", "cell_ratio", "fishing_hours_total", "productivity_score_avg", "fishing_score_avg"),
}


def serving_view(df: DataFrame, name: str, start: date, end: date) -> DataFrame:
    """One serving table in a range of dates; the dashboard table has all its columns."""
    return df.where(F.col("event_date").between(F.lit(start), F.lit(end))).select(*SERVING_COLUMNS.get(name, df.columns))
