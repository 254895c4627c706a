"""Stored serving tables: a job writes map, dashboard and status once; queries read the partitions that they ask for.

Each table is a ``ReleasedTable``: readers see a whole release, the old one or the new one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridlake.operators import dashboard
from gridlake.plans.layers import Layers
from gridlake.sources import files
from gridlake.sources.releases import ReleasedTable
from gridlake.sources.sinks import SERVING_PARTITIONS
from gridlake.sources.workspace import new_folder

_stored: dict[tuple, tuple[str, tuple]] = {}
_SUMMARY_PARTITIONS = ("aoi_id", "resolution_km")


def publish(x: Layers, root: str) -> None:
    """Release the three serving tables of an area and range of dates below a folder; partitions already there are replaced.

    The map is computed once and written; dashboard and status are made from what was written.
    """
    held = Published(x.spark, root)
    held.tables["map_metric"].merge(x.cells())
    cells = held.cells()
    held.tables["dashboard_daily"].merge(dashboard.dashboard_daily(cells, exact_p90=True))
    held.tables["status_distribution"].merge(dashboard.status_distribution(cells))


class Published:
    """The tables below a folder, with the columns in the order that serving names them; partition columns prune."""

    def __init__(self, spark: SparkSession, root: str):
        own = {"map_metric": SERVING_PARTITIONS, "dashboard_daily": _SUMMARY_PARTITIONS, "status_distribution": _SUMMARY_PARTITIONS}
        self.tables = {name: ReleasedTable(spark, f"{root}/{name}", partitions) for name, partitions in own.items()}

    def cells(self) -> DataFrame:
        return self.tables["map_metric"].read()

    def dashboard(self) -> DataFrame:
        return self.tables["dashboard_daily"].read()

    def status(self) -> DataFrame:
        return self.tables["status_distribution"].read()


def published(x: Layers) -> Published:
    """The stored tables of these layers, written on first use in a session and again when files of the source tables have changed."""
    key = (x.spark.sparkContext.applicationId, x.sf_dir, x.area_id, x.start, x.end, x.window)
    now = files.fingerprint(x.spark, x.sources)
    root, seen = _stored.get(key, (None, None))
    if seen != now:
        root = root or new_folder(x.spark, "serving")
        publish(x, root)
        _stored[key] = (root, now)
    return Published(x.spark, root)
