"""Dashboard tables from the map table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.indicators import day_number, status_class
from gridlake.model import SCOPE, SCORE_COLUMNS

DAY = ("event_date", "aoi_id", "resolution_km")


def _of(metric: str, value: Column) -> Column:
    return F.when(F.col("metric_id") == metric, value)


def _share(metric: str, condition: Column) -> Column:
    """Share of a metric's cells that meet a condition; null where the metric was not published."""
    return F.avg(_of(metric, F.when(condition, 1.0).otherwise(0.0)))


def pressure_p90(exact: bool) -> Column:
    """The 90th percentile of pressure: a value of the table, exact or to one in 1000 ranks (bounded memory)."""
    value = "case when metric_id = 'sustainability_pressure' then metric_value end"
    return F.expr(f"percentile_disc(0.9) within group (order by {value})" if exact else f"percentile_approx({value}, 0.9, 1000)")


def daily_base(cells: DataFrame, exact_p90: bool = False) -> DataFrame:
    value, score = F.col("metric_value"), F.col("relative_score")
    means = {"chlor_a_avg": "chlor_a", "sea_temperature_avg": "sea_temperature", "ocean_productivity_avg": "ocean_productivity_score", "sustainability_pressure_avg": "sustainability_pressure"}
    return (
        cells.groupBy(*DAY)
        .agg(
            F.countDistinct("grid_id").alias("cell_count"),
            F.avg("data_coverage").alias("data_coverage"),
            *[F.avg(_of(m, value)).alias(name) for name, m in means.items()],
            pressure_p90(exact_p90).alias("sustainability_pressure_p90"),
            F.sum(_of("fishing_hours", value)).alias("fishing_hours_total"),
            _share("fishing_hours", value > 0).alias("active_cell_ratio"),
            _share("fishing_hours", score >= 80).alias("high_activity_cell_ratio"),
            _share("ocean_productivity_score", score >= 80).alias("high_productivity_cell_ratio"),
            _share("sustainability_pressure", score >= 80).alias("high_pressure_cell_ratio"),
            *[F.avg(_of(m, score)).alias(name) for m, name in SCORE_COLUMNS.items()],
        )
        .fillna({"fishing_hours_total": 0.0, "active_cell_ratio": 0.0, "high_activity_cell_ratio": 0.0})
    )


def share_of_total() -> Column:
    """A row's part of all areas' fishing hours on its day and resolution; 0 when there are none."""
    total = F.sum("fishing_hours_total").over(Window.partitionBy("event_date", "resolution_km"))
    return F.when(total > 0, F.col("fishing_hours_total") / total).otherwise(0.0)


def trailing_7d(column: str) -> Column:
    """Mean over the last seven calendar days of the area and resolution, nulls left out."""
    return F.avg(column).over(Window.partitionBy("aoi_id", "resolution_km").orderBy(day_number(F.col("event_date"))).rangeBetween(-6, 0))


def dashboard_daily(cells: DataFrame, exact_p90: bool = False) -> DataFrame:
    return daily_base(cells, exact_p90).withColumns(
        {
            "share_of_all_fishing_hours": share_of_total(),
            "fishing_hours_7d_avg": trailing_7d("fishing_hours_total"),
            "sustainability_pressure_7d_avg": trailing_7d("sustainability_pressure_avg"),
        }
    )


def metric_pairs(cells: DataFrame) -> DataFrame:
    """Cells that have both a productivity and a fishing score, from one grouping instead of a self-join."""
    score = F.col("relative_score")
    both = cells.where(F.col("metric_id").isin("ocean_productivity_score", "fishing_hours")).groupBy(*DAY, "grid_id")
    return both.agg(
        F.max(_of("ocean_productivity_score", score)).alias("productivity_score"),
        F.max(_of("fishing_hours", score)).alias("fishing_score"),
        F.max(_of("fishing_hours", F.col("metric_value"))).alias("fishing_hours"),
    ).where("productivity_score is not null and fishing_score is not null")


def status_distribution(cells: DataFrame) -> DataFrame:
    """Cells, hours and mean scores of each status class, and its share of the scope's cells."""
    classed = metric_pairs(cells).withColumn("status_class", status_class(F.col("productivity_score"), F.col("fishing_score"), F.col("fishing_hours")))
    counted = classed.groupBy(*DAY, "status_class").agg(
        F.count("*").alias("cell_count"),
        F.sum("fishing_hours").alias("fishing_hours_total"),
        F.avg("productivity_score").alias("productivity_score_avg"),
        F.avg("fishing_score").alias("fishing_score_avg"),
    )
    return counted.withColumn("cell_ratio", F.col("cell_count") / F.sum("cell_count").over(Window.partitionBy(*DAY)))


def metric_summary(cells: DataFrame) -> DataFrame:
    """Mean and highest score, cells and coverage of each metric's day, area and resolution."""
    return cells.groupBy(*SCOPE).agg(
        F.avg("relative_score").alias("average_score"), F.max("relative_score").alias("maximum_score"), F.count("*").alias("cell_count"), F.avg("data_coverage").alias("data_coverage")
    )
