"""Every date and cell of an area, whether observed or not."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.grid import fine_grid_id
from gridlake.model import CELLS_PER_DEGREE, KEYS, Area


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    days = (end - start).days + 1
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("event_date"))


def extent(area: Area) -> tuple[int, int, int, int]:
    """First and last row and column whose cells start inside the area (its south and east edges start no cell)."""
    row = [int((90.0 - lat) * CELLS_PER_DEGREE) for lat in (area.max_lat, area.min_lat)]
    col = [int((lon + 180.0) * CELLS_PER_DEGREE) for lon in (area.min_lon, area.max_lon)]
    return row[0], row[1] - 1, col[0], col[1] - 1


def _with_cells(df: DataFrame, area: Area) -> DataFrame:
    r0, r1, c0, c1 = extent(area)
    rows = df.withColumn("_row", F.explode(F.sequence(F.lit(r0), F.lit(r1))))
    cells = rows.withColumn("_col", F.explode(F.sequence(F.lit(c0), F.lit(c1))))
    # A generated id, not a constant: windows by area and day then see that rows dealt by both are in place.
    cells = cells.withColumn("aoi_id", F.explode(F.array(F.lit(area.id))))
    cells = cells.withColumns({"grid_row": F.col("_row").cast("short"), "grid_col": F.col("_col").cast("short")})
    return cells.withColumn("grid_id", fine_grid_id(F.col("grid_row"), F.col("grid_col"))).drop("_row", "_col")


def cell_spine(spark: SparkSession, area: Area) -> DataFrame:
    return _with_cells(spark.range(1), area).select("aoi_id", "grid_id", "grid_row", "grid_col")


def backbone(spark: SparkSession, area: Area, start: date, end: date, window: int = 1) -> DataFrame:
    """All cells on all dates, from window - 1 days before the start. Dates are dealt to tasks and cells made there; nothing is joined."""
    return _with_cells(date_spine(spark, start - timedelta(days=window - 1), end), area).select(*KEYS)
