"""Constants and schemas of the daily grid: products, areas, published metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

VERSION = "1.0.0"
CELLS_PER_DEGREE = 24
FINE_KM = 4
RESOLUTIONS_KM = (4, 16, 32)
FILL_WINDOW_DAYS = 3


@dataclass(frozen=True)
class Product:
    id: str
    column: str
    low: float
    high: float
    unit: str
    period: str
    needs_quality: bool = False


# Raster products with their value column, valid range (both ends included), unit and time of day.
PRODUCTS = (
    Product("CHL", "chlor_a", 0.000999, 100.0, "mg m^-3", "day"),
    Product("NFLH", "nflh", -5.0, 50.0, "mW cm^-2 um^-1 sr^-1", "day"),
    Product("POC", "poc", 0.0, 5000.0, "mg m^-3", "day"),
    Product("SST", "sst", -2.0, 45.0, "degree_C", "day", True),
    Product("NSST", "nsst", -2.0, 45.0, "degree_C", "night", True),
    Product("SST4", "sst4", -2.0, 45.0, "degree_C", "night_preferred", True),
)


@dataclass(frozen=True)
class Area:
    id: str
    min_lat: float
    max_lat: float
    min_lon: float
    max_lon: float


# The two published areas, and three of our own for tests and benchmarks.
AREAS = {
    a.id: a
    for a in (
        Area("taiwan", 20.0, 27.0, 118.0, 124.0),
        Area("northwest_pacific", 15.0, 35.0, 105.0, 135.0),
        Area("probe", 24.0, 25.0, 120.0, 121.0),
        Area("corner", 24.0, 24.5, 120.0, 120.5),
        Area("wide", 20.0, 30.0, 118.0, 128.0),
    )
}

# Published metrics as (product, metric, value column).
PUBLISHED = (
    ("CHL", "chlor_a", "chlor_a"),
    ("SST", "sea_temperature", "sea_temperature_celsius"),
    ("PRODUCTIVITY", "ocean_productivity_score", "ocean_productivity_score"),
    ("SUSTAINABILITY", "sustainability_pressure", "sustainability_pressure"),
    ("GFW", "fishing_hours", "fishing_hours"),
)
#: Score column of the dashboard for each metric.
SCORE_COLUMNS = {metric: f"{metric}_avg" if metric.endswith("_score") else f"{metric}_score_avg" for _, metric, _ in PUBLISHED}

STATUS_CLASSES = tuple(f"{p}_productivity_{f}_fishing" for p in ("high", "low") for f in ("high", "low"))
LEVELS = ("very_low", "low", "medium", "high", "very_high")

CELL = ("event_date", "aoi_id", "grid_row", "grid_col")
KEYS = ("event_date", "aoi_id", "grid_id", "grid_row", "grid_col")
MAP_KEYS = ("event_date", "aoi_id", "product_id", "metric_id", "resolution_km", "grid_id")
SCOPE = ("event_date", "aoi_id", "product_id", "metric_id", "resolution_km")

#: Metrics that are gap-filled, as they stand in the filled table.
ENVIRONMENT = ("chlor_a", "poc", "nflh", "sea_temperature_celsius")

EFFORT_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("cell_ll_lat", T.DoubleType()),
        T.StructField("cell_ll_lon", T.DoubleType()),
        T.StructField("flag", T.StringType()),
        T.StructField("geartype", T.StringType()),
        T.StructField("hours", T.DoubleType()),
        T.StructField("fishing_hours", T.DoubleType()),
        T.StructField("mmsi_present", T.LongType()),
    ]
)
