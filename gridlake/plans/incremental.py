"""Late data: after rows have arrived, changed or gone, only the days that they can reach are made again.

The state of the source rows is kept as one checksum for each day (``reconcile.checksums``) of observations and of effort. A
run compares it with the rows of now. A day whose observations differ makes the days of the fill window after it
differ (cells, neighbours and the area's mean all look back so far); one whose effort differs, itself. These days are
computed from their own history and merged into the released map; weekly means are remade from the map. Partitions of
other days are named again, not rewritten.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators import dashboard, reconcile
from gridlake.plans.layers import Layers
from gridlake.sources.releases import ReleasedTable
from gridlake.sources.sinks import SERVING_PARTITIONS

WEEK_DAYS = 7
_OBSERVED = ("event_date", "product", "grid_row", "grid_col", "metric_value")
_EFFORT = ("event_date", "grid_row", "grid_col", "hours", "fishing_hours", "mmsi_present")


@dataclass(frozen=True)
class Refreshed:
    """The days whose rows differ, and the days that were made again because of them."""

    changed: tuple[date, ...]
    remade: tuple[date, ...]


def source_state(x: Layers) -> DataFrame:
    """(event_date, part, rows, total, parity) of the clean source rows that the layers use, history days (``since``) included."""
    parts = [reconcile.checksums(df, columns).withColumn("part", F.lit(name)) for name, df, columns in (("observations", x.clean(), _OBSERVED), ("effort", x.clean_effort(), _EFFORT))]
    return parts[0].unionByName(parts[1])


def reached(changed: Iterable[date], days: int, start: date, end: date) -> set[date]:
    """The days from ``start`` to ``end`` that look back ``days`` days (their own included) to a changed one."""
    return {d + timedelta(days=k) for d in changed for k in range(days) if start <= d + timedelta(days=k) <= end}


def spans(days: Iterable[date]) -> list[tuple[date, date]]:
    """Runs of consecutive days."""
    out: list[tuple[date, date]] = []
    for d in sorted(days):
        if out and d - out[-1][1] == timedelta(days=1):
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


def refresh(x: Layers, root: str) -> Refreshed:
    """Bring the map, the dashboard and the state below ``root`` up to the source rows of now; the first run makes all days.

    A run that fails is repeated as a whole: the state is released last. Days that lose all their rows are remade too (from
    their neighbours in time) and days that end incomplete leave the map.
    """
    cells = ReleasedTable(x.spark, f"{root}/map_metric", SERVING_PARTITIONS)
    days = ReleasedTable(x.spark, f"{root}/dashboard", ["event_date"])
    known = ReleasedTable(x.spark, f"{root}/state", ["part"])
    state = source_state(x)
    if known.current() is None:
        cells.publish(x.cells())
        days.publish(dashboard.dashboard_daily(cells.read(), exact_p90=True))
        known.publish(state)
        every = tuple(x.start + timedelta(days=k) for k in range((x.end - x.start).days + 1))
        return Refreshed(every, every)
    differ = reconcile.changed_days(known.read(), state, ["part", "event_date"]).collect()  # a row a day at most
    changed = {p: {r["event_date"] for r in differ if r["part"] == p} for p in ("observations", "effort")}
    redo = reached(changed["observations"], x.window, x.start, x.end) | reached(changed["effort"], 1, x.start, x.end)
    for first, last in spans(redo):
        # The span looks back over its window, but not beyond the rows that the whole run would use.
        since = max(x.since or x.start, first - timedelta(days=x.window - 1))
        cells.replace_range(replace(x, start=first, end=last, since=since).cells(), first, last)
    weekly = reached(redo, WEEK_DAYS, x.start, x.end)
    for first, last in spans(weekly):
        back = F.col("event_date").between(F.lit(first - timedelta(days=WEEK_DAYS - 1)), F.lit(last))
        made = dashboard.dashboard_daily(cells.read(back), exact_p90=True)
        days.replace_range(made.where(F.col("event_date") >= F.lit(first)), first, last)
    if differ:
        known.publish(state)
    return Refreshed(tuple(sorted(changed["observations"] | changed["effort"])), tuple(sorted(redo)))
