"""The registered queries read whole tables."""

from __future__ import annotations

from datetime import date

from gridlake.model import KEYS, Area
from gridlake.operators import features, fill, score, spine
from gridlake.plans.layers import Layers, table

SF = "/root/testdata/sf0.001"


def test_effort_is_whole_lineitem(spark):
    lines = table(spark, SF, "lineitem")
    effort = Layers(spark, SF).effort()
    assert effort.count() == lines.count()
    total = lines.selectExpr("sum(l_quantity) as hours", "sum(l_linenumber) as present").first()
    got = effort.selectExpr("sum(hours) as hours", "sum(mmsi_present) as present").first()
    assert (got.hours, got.present) == (total.hours, total.present)


def test_observations_are_all_events(spark):
    assert Layers(spark, SF).observations().count() == table(spark, SF, "events").count()


def test_a_metric_without_rows_for_days(spark):
    """NFLH is seen on days 1 and 5 only: with a window of 3, day 4 has none and what needs it is not published."""
    area, days = Area("patch", 24.0, 24.0 + 4 / 24, 120.0, 120.0 + 4 / 24), [date(2024, 1, d) for d in range(1, 6)]
    bones = spine.backbone(spark, area, days[0], days[-1])
    seen = bones.selectExpr(*KEYS, "1D as chlor_a", "2D as poc", "case when day(event_date) in (1, 5) then 3D end as nflh", "20D as sea_temperature_celsius")
    hours = bones.selectExpr("event_date", "aoi_id", "grid_row", "grid_col", "1D as fishing_hours")
    filled = fill.gap_fill(fill.zero_fill(fill.observed_backbone(bones, seen), hours), 3).cache()
    sources = {r.event_date.day: r.nflh_source for r in filled.collect()}
    assert sources == {1: "observed", 2: "grid_3d_mean", 3: "grid_3d_mean", 4: "no_data", 5: "observed"}
    cells = score.map_metric(features.feature_columns(features.with_indicators(filled)))
    published = {}
    for r in cells.select("metric_id", "event_date").distinct().collect():
        published.setdefault(r.metric_id, set()).add(r.event_date.day)
    assert published["ocean_productivity_score"] == published["sustainability_pressure"] == {1, 2, 3, 5}
    assert published["chlor_a"] == published["fishing_hours"] == {1, 2, 3, 4, 5}
