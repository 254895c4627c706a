"""The layers of one area and range of dates, from source rows to dashboard tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from gridlake.model import AREAS, FILL_WINDOW_DAYS
from gridlake.operators import daily, dashboard, features, fill, score, spine

# The source rows in terms of the TPC-H-like tables; the same text runs on Spark and on the oracle. $R, $C and $M place
# the points: they overshoot the area by a cell on each side, so that clipping has something to do.
OBSERVATIONS = """
SELECT CAST(ts AS DATE) AS date,
       CASE event_type WHEN 'click' THEN 'CHL' WHEN 'view' THEN 'POC' WHEN 'signup' THEN 'NFLH' WHEN 'purchase' THEN 'SST4' ELSE 'SST' END AS product,
       CAST(90 AS DOUBLE) - (($R + (event_id*37 + user_id) % $M) + CAST(0.5 AS DOUBLE)) / CAST(24 AS DOUBLE) AS lat,
       (($C + (event_id*101 + user_id*7) % $M) + CAST(0.5 AS DOUBLE)) / CAST(24 AS DOUBLE) - CAST(180 AS DOUBLE) AS lon,
       CAST(value AS FLOAT) AS value,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 3 AS SMALLINT) END AS quality_level
FROM {events}
"""
EFFORT = """
SELECT CAST(DATE '2024-01-01' + CAST(l_orderkey % 30 AS INT) AS STRING) AS date,
       CAST(90 AS DOUBLE) - (($R + (l_orderkey*13 + l_linenumber*5) % $M) + CAST(0.5 AS DOUBLE)) / CAST(24 AS DOUBLE) - CAST(0.005 AS DOUBLE) AS cell_ll_lat,
       (($C + (l_partkey*7 + l_suppkey) % $M) + CAST(0.5 AS DOUBLE)) / CAST(24 AS DOUBLE) - CAST(180 AS DOUBLE) - CAST(0.005 AS DOUBLE) AS cell_ll_lon,
       l_returnflag AS flag, l_linestatus AS geartype,
       l_quantity AS hours,
       CASE WHEN l_tax > CAST(0.07 AS DOUBLE) THEN l_quantity + 1 ELSE LEAST(l_quantity, l_quantity * l_discount * 10) END AS fishing_hours,
       CAST(l_linenumber AS BIGINT) AS mmsi_present
FROM {lineitem}
"""
RASTERS = """
SELECT vec_id, DATE '2024-01-01' + CAST(vec_id % 30 AS INT) AS date, embedding FROM {embeddings}
"""
START, END = date(2024, 1, 1), date(2024, 1, 30)
#: Row and column of the first point, and the number of rows and columns, for each area of ours.
PLACES = {"probe": (1559, 7199, 26), "corner": (1559, 7199, 26), "wide": (1439, 7151, 242)}


def placed(sql: str, area: str) -> str:
    for name, value in zip(("$R", "$C", "$M"), PLACES[area], strict=True):
        sql = sql.replace(name, str(value))
    return sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class Layers:
    """Each method is one layer as a lazy DataFrame."""

    spark: SparkSession
    sf_dir: str
    area_id: str = "probe"
    start: date = START
    end: date = END
    window: int = FILL_WINDOW_DAYS
    #: First day whose source rows are used: the start, or up to window - 1 days before it where the fill is to look back.
    since: date | None = None
    #: Cells along a tile's side for the neighbours' means; areas of fewer cells than a tile are dealt whole.
    tile: int = fill.TILE
    #: Cells of a metric-day that a task may sort; larger ones are ranked in ranges.
    task_cells: int = score.TASK_CELLS

    @property
    def area(self):
        return AREAS[self.area_id]

    @property
    def sources(self) -> list[str]:
        return [f"{self.sf_dir.rstrip('/')}/{name}.parquet" for name in ("events", "lineitem")]

    @property
    def cells_a_day(self) -> int:
        """Known from the area's edges, since every day has all its cells."""
        r0, r1, c0, c1 = spine.extent(self.area)
        return (r1 - r0 + 1) * (c1 - c0 + 1)

    @property
    def tiled(self) -> bool:
        return self.cells_a_day > self.tile**2

    def observations(self) -> DataFrame:
        return self.spark.sql(placed(OBSERVATIONS, self.area_id), events=table(self.spark, self.sf_dir, "events"))

    def effort(self) -> DataFrame:
        return self.spark.sql(placed(EFFORT, self.area_id), lineitem=table(self.spark, self.sf_dir, "lineitem"))

    def rasters(self) -> DataFrame:
        """8 x 8 rasters with fill values and NaN in fixed places."""
        vectors = self.spark.sql(RASTERS, embeddings=table(self.spark, self.sf_dir, "embeddings"))
        cell = "case when (8 * i + j + vec_id) % 11 = 0 then -32767D when (8 * i + j + vec_id) % 13 = 0 then double('nan') else cast(embedding[8 * i + j] as double) end"
        steps = "sequence(0, 7)"
        return vectors.selectExpr(
            "date",
            f"transform({steps}, i -> 25D - (i + 0.5D) / 24D) as lat",
            f"transform({steps}, j -> 120D + (j + 0.5D) / 24D) as lon",
            f"transform({steps}, i -> transform({steps}, j -> {cell})) as values",
        )

    def clean(self) -> DataFrame:
        return daily.clean_observations(self.observations(), [self.area], self.since or self.start, self.end)

    def clean_effort(self) -> DataFrame:
        return daily.clean_effort(self.effort(), [self.area], self.since or self.start, self.end)

    def grid(self) -> DataFrame:
        return daily.daily_grid(self.clean())

    def effort_grid(self) -> DataFrame:
        return daily.effort_grid(self.clean_effort())

    def backbone(self) -> DataFrame:
        return spine.backbone(self.spark, self.area, self.start, self.end, self.window)

    def joined(self) -> DataFrame:
        return fill.observed_backbone(self.backbone(), self.grid())

    def filled(self) -> DataFrame:
        return fill.gap_fill(fill.zero_fill(self.joined(), self.effort_grid()), self.window, tile=self.tile if self.tiled else None)

    def features(self) -> DataFrame:
        return fill.between(features.feature_columns(features.with_indicators(self.filled(), self.tiled)), self.start, self.end)

    def cells(self) -> DataFrame:
        return (score.map_metric_in_ranges if self.cells_a_day > self.task_cells else score.map_metric)(self.features())

    def dashboard(self) -> DataFrame:
        return dashboard.dashboard_daily(self.cells(), exact_p90=True)

    def status(self) -> DataFrame:
        return dashboard.status_distribution(self.cells())


def together(parts: Iterable[Layers]) -> DataFrame:
    """The map table of several areas in one; dashboards built on it see all areas of a day."""
    return reduce(DataFrame.unionByName, [x.cells() for x in parts])
