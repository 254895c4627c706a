"""Every registered query of the grid engine, each with the oracle SQL that gives the same rows.

Doubles are rounded to 6 digits and smallints widened on both sides, so that results compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions import grid as G
from gridlake.functions import indicators as I
from gridlake.model import AREAS, ENVIRONMENT, KEYS, PRODUCTS, PUBLISHED, SCORE_COLUMNS
from gridlake.operators import checks, clean, daily, dashboard, features, fill, score, spine
from gridlake.plans import scaled, serving  # noqa: F401  (scaled registers its own queries)
from gridlake.plans.layers import END, START, Layers, together
from gridlake.plans.layers_sql import NUDGE, over, rounded
from gridlake.plans.publish import published
from gridlake.plans.registry import ORACLES, QUERIES, Query, register
from gridlake.sources import files, sinks
from gridlake.sources.releases import ReleasedTable
from gridlake.sources.workspace import new_folder

DAY = date(2024, 1, 20)
PROBE = AREAS["probe"]
TEMPERATURE = "sea_temperature_celsius"

_SQL_KEYS = "event_date aoi_id grid_id grid_row grid_col"


# ---- projections and filters -------------------------------------------------------------------------------------

_CLEAN = "event_date product aoi_id"


@register(rounded("FROM conformed", "lat lon metric_value", "event_date product quality_level"))
def conform_observations(x: Layers) -> DataFrame:
    return clean.conform(x.observations()).select("event_date", "product", "quality_level", "lat", "lon", "metric_value")


@register(rounded("FROM conformed WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-12'", "lat lon metric_value", "event_date product"))
def filter_dates(x: Layers) -> DataFrame:
    return clean.in_dates(clean.conform(x.observations()), date(2024, 1, 8), date(2024, 1, 12)).select("event_date", "product", "lat", "lon", "metric_value")


@register(rounded("FROM clipped", "lat lon metric_value", _CLEAN))
def clip_aoi(x: Layers) -> DataFrame:
    return clean.clip_areas(clean.conform(x.observations()), [PROBE]).select("event_date", "product", "aoi_id", "lat", "lon", "metric_value")


@register(rounded("FROM ranged", "lat lon metric_value", _CLEAN))
def filter_valid_range(x: Layers) -> DataFrame:
    rows = clean.clip_areas(clean.in_dates(clean.conform(x.observations()), START, END), [PROBE])
    return clean.valid_range(rows).select("event_date", "product", "aoi_id", "lat", "lon", "metric_value")


@register(over("SELECT event_date, product, quality_level, round(metric_value, 6) AS metric_value FROM conformed WHERE product NOT IN ('SST', 'NSST', 'SST4') OR quality_level <= 1"))
def filter_quality(x: Layers) -> DataFrame:
    return clean.valid_quality(clean.conform(x.observations())).select("event_date", "product", "quality_level", "metric_value")


@register(rounded("FROM effort_valid", "lat lon hours fishing_hours", "event_date mmsi_present"))
def filter_effort(x: Layers) -> DataFrame:
    return clean.valid_effort(clean.conform_effort(x.effort()))


@register("SELECT product, count(*) AS n, round(sum(value::DOUBLE), 4) AS total FROM (" + over("SELECT * FROM observations") + ") WHERE NOT (isnan(value) OR isinf(value)) AND value <> 0 GROUP BY product")
def drop_missing(x: Layers) -> DataFrame:
    kept = clean.drop_missing(x.observations(), "value", [0.0])
    return kept.groupBy("product").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("double")), 4).alias("total"))


@register(over("SELECT event_date, product, round(metric_value, 2) AS metric_value, round(lat, 3) AS lat FROM clipped"))
def round_metrics(x: Layers) -> DataFrame:
    rows = clean.clip_areas(clean.conform(x.observations()), [PROBE])
    return clean.round_columns(clean.round_columns(rows, 2, ["metric_value"]), 3, ["lat"]).select("event_date", "product", "metric_value", "lat")


@register(over("SELECT event_date, grid_id, round(chlor_a, 6) AS chlor_a, '1.0.0' AS pipeline_version, true AS stamped FROM grid"))
def audit_columns(x: Layers) -> DataFrame:
    stamped = (F.col("updated_at_utc") <= F.current_timestamp()) & (F.col("updated_at_utc") > F.lit("2024-01-01").cast("timestamp"))
    return clean.audited(x.grid()).select("event_date", "grid_id", "chlor_a", "pipeline_version", stamped.alias("stamped"))


@register(over("SELECT event_date, aoi_id, product_id, metric_id, resolution_km, grid_id, display_level, value_source, round(relative_score, 6) AS relative_score FROM cells WHERE event_date BETWEEN DATE '2024-01-18' AND DATE '2024-01-20'"))
def serving_projection(x: Layers) -> DataFrame:
    view = serving.serving_view(x.cells(), "map_metric", date(2024, 1, 18), DAY)
    return view.select("event_date", "aoi_id", "product_id", "metric_id", "resolution_km", "grid_id", "display_level", "value_source", "relative_score")


# ---- scalar functions --------------------------------------------------------------------------------------------


@register(over("SELECT DISTINCT round(lat, 6) AS lat, round(lon, 6) AS lon, grid_row, grid_col FROM clean"))
def grid_index(x: Layers) -> DataFrame:
    return x.clean().select(F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "grid_row", "grid_col").distinct()


@register(over("SELECT DISTINCT grid_id, printf('r%02dkm_%04d_%04d', 16, grid_row - grid_row % 4, grid_col - grid_col % 4) AS coarse_id FROM clean"))
def grid_id(x: Layers) -> DataFrame:
    snapped = [G.coarse(F.col(c), 16) for c in ("grid_row", "grid_col")]
    return x.clean().select("grid_id", G.coarse_grid_id(F.lit(16), *snapped).alias("coarse_id")).distinct()


@register(over("SELECT round(cell_ll_lat + 0.005, 6) AS lat, round(cell_ll_lon + 0.005, 6) AS lon, count(*) AS n FROM effort GROUP BY 1, 2"))
def cell_centre(x: Layers) -> DataFrame:
    centre = [F.round(G.cell_centre(F.col(f"cell_ll_{c}")), 6).alias(c) for c in ("lat", "lon")]
    return x.effort().select(*centre).groupBy("lat", "lon").agg(F.count("*").alias("n"))


@register(over("SELECT km, grid_row - grid_row % (km // 4) AS coarse_row, grid_col - grid_col % (km // 4) AS coarse_col, count(*) AS n FROM clean, (SELECT CAST(unnest([4, 16, 32]) AS INT) AS km) GROUP BY 1, 2, 3"))
def coarse_snap(x: Layers) -> DataFrame:
    rows = x.clean().withColumn("km", F.explode(F.array(F.lit(4), F.lit(16), F.lit(32))))
    snapped = [G.coarse(F.col(f"grid_{c}"), F.col("km")).alias(f"coarse_{c}") for c in ("row", "col")]
    return rows.select("km", *snapped).groupBy("km", "coarse_row", "coarse_col").agg(F.count("*").alias("n"))


@register(over("SELECT DISTINCT grid_id, round(90 - grid_row / 24.0, 6)::DOUBLE AS north, round(90 - (grid_row + resolution_km / 4) / 24.0, 6)::DOUBLE AS south, round(grid_col / 24.0 - 180, 6)::DOUBLE AS west, round((grid_col + resolution_km / 4) / 24.0 - 180, 6)::DOUBLE AS east FROM wide"))
def cell_bounds(x: Layers) -> DataFrame:
    cells = features.multi_resolution(x.features())
    edges = G.cell_bounds(F.col("grid_row"), F.col("grid_col"), F.col("resolution_km"))
    return cells.select("grid_id", *[F.round(c, 6).alias(name) for name, c in edges.items()]).distinct()


@register(rounded("FROM (SELECT *, coalesce(sst4, nsst, sst) AS sea_temperature_celsius FROM grid)", "sst sst4 sea_temperature_celsius", _SQL_KEYS))
def temperature_priority(x: Layers) -> DataFrame:
    return x.grid().select(*KEYS, "sst", "sst4", I.temperature().alias(TEMPERATURE))


@register(over("SELECT event_date, grid_id, round(CASE WHEN abs(poc) > 1e-12 THEN chlor_a / poc END, 6) AS ratio FROM grid"))
def safe_ratio(x: Layers) -> DataFrame:
    return x.grid().select("event_date", "grid_id", I.safe_ratio(F.col("chlor_a"), F.col("poc")).alias("ratio"))


def _features(*columns: str) -> Callable[[Layers], DataFrame]:
    return lambda x: x.features().select("event_date", "aoi_id", "grid_id", *columns)


@register(rounded("FROM features", "ocean_productivity_score", "event_date aoi_id grid_id ocean_productivity_score_source"))
def productivity(x: Layers) -> DataFrame:
    return _features("ocean_productivity_score", "ocean_productivity_score_source")(x)


@register(rounded("FROM features", "sustainability_pressure fishing_hours", "event_date aoi_id grid_id sustainability_pressure_source"))
def pressure(x: Layers) -> DataFrame:
    return _features("sustainability_pressure", "fishing_hours", "sustainability_pressure_source")(x)


@register(rounded("FROM features", "data_coverage", "event_date aoi_id grid_id"))
def data_coverage(x: Layers) -> DataFrame:
    return _features("data_coverage")(x)


@register(over("SELECT metric_id, resolution_km, display_level, count(*) AS cells FROM cells GROUP BY ALL"))
def display_level(x: Layers) -> DataFrame:
    return x.cells().groupBy("metric_id", "resolution_km", "display_level").agg(F.count("*").alias("cells"))


@register(over("SELECT event_date, aoi_id, resolution_km, grid_id, status_class FROM classed"))
def status_class(x: Layers) -> DataFrame:
    named = I.status_class(F.col("productivity_score"), F.col("fishing_score"), F.col("fishing_hours"))
    return dashboard.metric_pairs(x.cells()).select("event_date", "aoi_id", "resolution_km", "grid_id", named.alias("status_class"))


@register(over("SELECT grid_id, 1::BIGINT AS shards, count(*) AS rows, true AS in_range FROM grid GROUP BY grid_id"))
def hash_shard(x: Layers) -> DataFrame:
    """Each cell is in one of 8 shards on all its days."""
    sharded = x.grid().withColumn("shard", I.shard(F.col("grid_id"), 8))
    return sharded.groupBy("grid_id").agg(F.countDistinct("shard").alias("shards"), F.count("*").alias("rows"), F.bool_and(F.col("shard").between(0, 7)).alias("in_range"))


@register(over("SELECT DISTINCT event_date, CAST(event_date - DATE '1970-01-01' AS INT) AS day_number, CAST(event_date - 6 AS DATE) AS week_before FROM conformed"))
def day_number(x: Layers) -> DataFrame:
    return clean.conform(x.observations()).select("event_date", I.day_number(F.col("event_date")).alias("day_number"), F.date_add("event_date", -6).alias("week_before")).distinct()


_PARTS = {"high_productivity": "high_productivity_cell_ratio", "high_activity": "high_activity_cell_ratio", "high_pressure": "high_pressure_cell_ratio"}


@register(over(" UNION ALL ".join(f"SELECT event_date, aoi_id, resolution_km, '{n}' AS component, round({c} * 100, 6) AS percent, printf('%.1f%%', {c} * 100) AS text FROM dashboard WHERE {c} IS NOT NULL" for n, c in _PARTS.items())))
def summary_components(x: Layers) -> DataFrame:
    return serving.summary_components(x.dashboard())


# ---- spines and joins --------------------------------------------------------------------------------------------


@register(over("SELECT d.event_date, count(c.product) AS observations FROM days d LEFT JOIN conformed c USING (event_date) WHERE d.event_date >= DATE '2024-01-01' GROUP BY 1"))
def date_spine(x: Layers) -> DataFrame:
    seen = clean.conform(x.observations()).groupBy("event_date").agg(F.count("*").alias("n"))
    return spine.date_spine(x.spark, START, END).join(seen, "event_date", "left").select("event_date", F.coalesce("n", F.lit(0)).alias("observations"))


@register(over("SELECT c.aoi_id, c.grid_id, c.grid_row, c.grid_col, count(g.event_date) AS observed_days FROM cells4 c LEFT JOIN grid g USING (grid_id) GROUP BY ALL"))
def cell_spine(x: Layers) -> DataFrame:
    days = x.grid().groupBy("grid_id").agg(F.count("*").alias("n"))
    return spine.cell_spine(x.spark, PROBE).join(days, "grid_id", "left").select("aoi_id", "grid_id", "grid_row", "grid_col", F.coalesce("n", F.lit(0)).alias("observed_days"))


@register(over("SELECT b.*, g.event_date IS NOT NULL AS observed FROM backbone b LEFT JOIN grid g USING (event_date, aoi_id, grid_id)"))
def complete_backbone(x: Layers) -> DataFrame:
    seen = x.grid().select("event_date", "aoi_id", "grid_id", F.lit(True).alias("_seen"))
    return x.backbone().join(seen, ["event_date", "aoi_id", "grid_id"], "left").select(*KEYS, F.coalesce("_seen", F.lit(False)).alias("observed"))


@register(rounded("FROM joined", " ".join(ENVIRONMENT), _SQL_KEYS))
def backbone_observed(x: Layers) -> DataFrame:
    return x.joined()


_NEAR = {f"{m}_cell_mean": f"{m}_near" for m in ENVIRONMENT}


@register(rounded("FROM near", " ".join(_NEAR.values()), "event_date aoi_id grid_row grid_col"))
def neighbor_mean(x: Layers) -> DataFrame:
    means = fill.neighbour_means(fill.trailing_cell_means(x.joined(), ENVIRONMENT, x.window), _NEAR)
    return means.select("event_date", "aoi_id", "grid_row", "grid_col", *_NEAR.values())


@register(rounded("FROM filled", "chlor_a poc", _SQL_KEYS))
def join_metrics(x: Layers) -> DataFrame:
    filled = x.filled()
    return fill.join_metrics([filled.select(*KEYS, "chlor_a"), filled.select(*KEYS, "poc")])


@register(rounded("FROM filled", "fishing_hours", _SQL_KEYS + " fishing_hours_source"))
def zero_fill_effort(x: Layers) -> DataFrame:
    return fill.zero_fill(x.backbone(), x.effort_grid())


@register(over("SELECT * FROM pairs").replace("SELECT * FROM pairs", "SELECT event_date, aoi_id, resolution_km, grid_id, round(productivity_score, 6) AS productivity_score, round(fishing_score, 6) AS fishing_score, round(fishing_hours, 6) AS fishing_hours FROM pairs"))
def metric_pair_join(x: Layers) -> DataFrame:
    return dashboard.metric_pairs(x.cells())


_WITHHELD = "(metric_id = 'chlor_a' AND event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-07') OR (resolution_km = 32 AND event_date = DATE '2024-01-10')"


@register(over(f"SELECT s.*, 'incomplete_metric_scope' AS reason FROM scopes s ANTI JOIN (SELECT * FROM cells WHERE NOT ({_WITHHELD})) c USING (event_date, aoi_id, product_id, metric_id, resolution_km)"))
def omitted_scopes(x: Layers) -> DataFrame:
    """Of a map that lacks one metric on three days, and one resolution on another."""
    return checks.omitted_scopes(x.cells().where(f"not ({_WITHHELD})"), x.area_id, START, END)


@register(over("SELECT coalesce(max(event_date) FILTER (event_date <= DATE '2024-01-13'), max(event_date)) AS event_date FROM cells WHERE metric_id = 'ocean_productivity_score'"))
def asof_date(x: Layers) -> DataFrame:
    return serving.asof_date(x.cells().where("metric_id = 'ocean_productivity_score'"), date(2024, 1, 13))


# ---- aggregations ------------------------------------------------------------------------------------------------

_COLUMNS = " ".join(p.column for p in PRODUCTS)


@register(rounded("FROM grid", _COLUMNS, _SQL_KEYS))
def silver_daily_grid(x: Layers) -> DataFrame:
    return x.grid()


@register(rounded("FROM effort_grid", "presence_hours fishing_hours", _SQL_KEYS + " vessel_presence_count"))
def silver_effort_grid(x: Layers) -> DataFrame:
    return x.effort_grid()


@register(over("SELECT event_date, aoi_id, " + ", ".join(f"round(avg({m}), 6) AS avg_{m}" for m in features.PRODUCTIVE) + " FROM filled GROUP BY ALL"))
def daily_aoi_means(x: Layers) -> DataFrame:
    return features.daily_means(x.filled())


_VALUES = [c for _, _, c in PUBLISHED]


@register(rounded("FROM wide", " ".join([*_VALUES, "data_coverage"]), "event_date aoi_id resolution_km grid_id grid_row grid_col"))
def multi_resolution(x: Layers) -> DataFrame:
    rolled = features.multi_resolution(x.features())
    return rolled.select("event_date", "aoi_id", "resolution_km", "grid_id", "grid_row", "grid_col", *_VALUES, "data_coverage")


@register(over("SELECT resolution_km, " + ", ".join(f"{c}_source" for c in _VALUES) + ", count(*) AS n FROM wide GROUP BY ALL"))
def provenance_rollup(x: Layers) -> DataFrame:
    sources = [f"{c}_source" for c in _VALUES]
    return features.multi_resolution(x.features()).groupBy("resolution_km", *sources).agg(F.count("*").alias("n"))


_DAILY = ("data_coverage", "chlor_a_avg", "sea_temperature_avg", "ocean_productivity_avg", "sustainability_pressure_avg", "sustainability_pressure_p90", "fishing_hours_total", *SCORE_COLUMNS.values())
_RATIOS = ("active_cell_ratio", "high_activity_cell_ratio", "high_productivity_cell_ratio", "high_pressure_cell_ratio")
_TREND = ("share_of_all_fishing_hours", "fishing_hours_7d_avg", "sustainability_pressure_7d_avg")
_SCOPE = ("event_date", "aoi_id", "resolution_km")


@register(rounded("FROM dashboard", " ".join((*_DAILY, *_RATIOS, *_TREND)), "event_date aoi_id resolution_km cell_count"))
def dashboard_daily(x: Layers) -> DataFrame:
    return x.dashboard()


@register(rounded("FROM daily", " ".join(_RATIOS), " ".join(_SCOPE)))
def cell_ratios(x: Layers) -> DataFrame:
    return dashboard.daily_base(x.cells(), exact_p90=True).select(*_SCOPE, *_RATIOS)


@register(over("SELECT event_date, resolution_km, count(DISTINCT grid_id) AS cells FROM cells GROUP BY ALL"))
def distinct_cells(x: Layers) -> DataFrame:
    return x.cells().groupBy("event_date", "resolution_km").agg(F.countDistinct("grid_id").alias("cells"))


@register(rounded("FROM daily", "sustainability_pressure_p90", " ".join(_SCOPE)))
def pressure_p90(x: Layers) -> DataFrame:
    return x.cells().groupBy(*_SCOPE).agg(dashboard.pressure_p90(exact=True).alias("sustainability_pressure_p90"))


_STATUS = "fishing_hours_total productivity_score_avg fishing_score_avg cell_ratio"


@register(rounded("FROM status", _STATUS, "event_date aoi_id resolution_km status_class cell_count"))
def status_distribution(x: Layers) -> DataFrame:
    return x.status()


_PROFILED = ("chlor_a", "poc", "nflh", "sst", "nsst", "sst4")
_PROFILE_SQL = "count(*) AS output_rows, count(DISTINCT (event_date, aoi_id, grid_id, grid_row, grid_col)) AS distinct_key_rows, count(*) FILTER (event_date IS NULL OR aoi_id IS NULL OR grid_id IS NULL OR grid_row IS NULL OR grid_col IS NULL) AS null_key_rows, min(event_date) AS min_event_date, max(event_date) AS max_event_date, count(DISTINCT event_date) AS observed_day_count, " + ", ".join(
    f"count(*) FILTER ({m} IS NULL OR isnan({m})) AS {m}_invalid, round(min({m}), 6) AS {m}_min, round(max({m}), 6) AS {m}_max" for m in _PROFILED
)


@register(over(f"SELECT {_PROFILE_SQL} FROM grid"))
def quality_profile(x: Layers) -> DataFrame:
    return checks.profile(x.grid(), KEYS, _PROFILED)


@register(over("SELECT product, count(*) AS total_pixels, count(*) FILTER (NOT isnan(value) AND value > 0) AS valid_pixels, count(*) - count(*) FILTER (NOT isnan(value) AND value > 0) AS missing_pixels, round(count(*) FILTER (NOT isnan(value) AND value > 0) / count(*), 6) AS valid_ratio, round(1 - count(*) FILTER (NOT isnan(value) AND value > 0) / count(*), 6) AS missing_ratio FROM observations GROUP BY product"))
def coverage_report(x: Layers) -> DataFrame:
    """Pixels of value 0 or less count as missing here, to have some."""
    pixels = x.observations().withColumn("value", F.when(F.col("value") > 0, F.col("value")))
    return checks.coverage_report(pixels, "value", ["product"])


@register(over(" UNION ALL ".join(f"SELECT '{m}' AS metric, count({m}) AS n, round(avg({m}), 6) AS mean, round(stddev_samp({m}), 6) AS stddev, round(min({m}), 6) AS min, round(quantile_cont({m}, 0.25), 6) AS p25, round(quantile_cont({m}, 0.5), 6) AS p50, round(quantile_cont({m}, 0.75), 6) AS p75, round(max({m}), 6) AS max FROM grid HAVING count({m}) > 0" for m in _PROFILED)))
def describe_metrics(x: Layers) -> DataFrame:
    return checks.describe(x.grid(), _PROFILED)


_SUMMARY = "SELECT event_date, aoi_id, product_id, metric_id, resolution_km, round(avg(relative_score), 6) AS average_score, round(max(relative_score), 6) AS maximum_score, count(*) AS cell_count, round(avg(data_coverage), 6) AS data_coverage FROM cells GROUP BY ALL"


@register(over(_SUMMARY))
def metric_summary(x: Layers) -> DataFrame:
    return dashboard.metric_summary(x.cells())


@register(over(_SUMMARY, "wide"))
def metric_summary_wide(x: Layers) -> DataFrame:
    """The same over 57,600 cells a day, where few cells are observed and all fill levels are used."""
    return dashboard.metric_summary(replace(x, area_id="wide").cells())


@register(over(" UNION ALL ".join(f"SELECT '{n}' AS dataset, CAST(year(event_date) AS INT) AS year, count(DISTINCT event_date) AS days FROM {t} GROUP BY ALL" for n, t in (("backbone", "backbone"), ("grid", "grid"), ("map_metric", "cells"), ("status", "status")))))
def dates_per_year(x: Layers) -> DataFrame:
    return checks.dates_per_year(backbone=x.backbone(), grid=x.grid(), map_metric=x.cells(), status=x.status())


# ---- windows, reshape --------------------------------------------------------------------------------------------


@register(over(f"SELECT event_date, aoi_id, grid_id, grid_row, grid_col, {', '.join(f'round({m}_cell, 6) AS {m}_cell_mean, {m}_n AS {m}_cell_count' for m in ENVIRONMENT)} FROM trailed"))
def trailing_cell_mean(x: Layers) -> DataFrame:
    return fill.trailing_cell_means(x.joined(), ENVIRONMENT, x.window).drop(*ENVIRONMENT)


@register(over(f"SELECT event_date, aoi_id, {', '.join(f'round({m}_area, 6) AS {m}_area_mean' for m in ENVIRONMENT)} FROM area"))
def trailing_aoi_mean(x: Layers) -> DataFrame:
    return fill.trailing_area_means(x.joined(), ENVIRONMENT, x.window)


_FILLED = [f"{m}_{part}" for m in ENVIRONMENT for part in ("source", "observation_count_window")]


@register(rounded("FROM filled", " ".join(ENVIRONMENT), " ".join((_SQL_KEYS, *_FILLED))))
def gap_fill(x: Layers) -> DataFrame:
    return x.filled().select(*KEYS, *ENVIRONMENT, *_FILLED)


@register(over("SELECT DISTINCT event_date, aoi_id, product_id, metric_id, resolution_km FROM complete"))
def complete_scopes(x: Layers) -> DataFrame:
    long = features.long_metrics(features.multi_resolution(x.features()))
    return score.complete_scopes(long).select("event_date", "aoi_id", "product_id", "metric_id", "resolution_km").distinct()


@register(over("SELECT event_date, metric_id, resolution_km, grid_id, round(relative_score, 6) AS relative_score FROM ranked"))
def relative_score(x: Layers) -> DataFrame:
    return x.cells().select("event_date", "metric_id", "resolution_km", "grid_id", "relative_score")


@register(rounded("FROM dashboard", "share_of_all_fishing_hours", " ".join(_SCOPE)))
def share_of_total(x: Layers) -> DataFrame:
    return dashboard.daily_base(x.cells()).select(*_SCOPE, dashboard.share_of_total().alias("share_of_all_fishing_hours"))


_SHARES = "SELECT event_date, aoi_id, resolution_km, fishing_hours_total FROM daily"


@register(
    "SELECT event_date, aoi_id, resolution_km, round(CASE WHEN sum(fishing_hours_total) OVER t > 0 THEN fishing_hours_total / sum(fishing_hours_total) OVER t ELSE 0.0 END + "
    + f"{NUDGE}, 6) AS share_of_all_fishing_hours FROM (({over(_SHARES)}) UNION ALL ({over(_SHARES, 'corner')})) WINDOW t AS (PARTITION BY event_date, resolution_km)"
)
def share_of_areas(x: Layers) -> DataFrame:
    """Each of two areas' part of their hours on a day; the smaller one lies inside the other."""
    base = dashboard.daily_base(together([x, replace(x, area_id="corner")]))
    return base.select(*_SCOPE, dashboard.share_of_total().alias("share_of_all_fishing_hours"))


@register(rounded("FROM dashboard", "fishing_hours_7d_avg sustainability_pressure_7d_avg", " ".join(_SCOPE)))
def trailing_7d(x: Layers) -> DataFrame:
    base = dashboard.daily_base(x.cells())
    return base.select(*_SCOPE, *[dashboard.trailing_7d(c).alias(n) for c, n in (("fishing_hours_total", "fishing_hours_7d_avg"), ("sustainability_pressure_avg", "sustainability_pressure_7d_avg"))])


@register(over("SELECT product, count(*) AS n, round(sum(value::DOUBLE), 4) AS total FROM observations GROUP BY product"))
def union_products(x: Layers) -> DataFrame:
    whole = x.observations()
    split = {p.id: whole.where(F.col("product") == p.id).drop("product") for p in PRODUCTS}
    return daily.union_products(split).groupBy("product").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("double")), 4).alias("total"))


_LONG = "event_date aoi_id product_id metric_id resolution_km grid_id grid_row grid_col value_source"


@register(rounded("FROM long", "metric_value data_coverage", _LONG))
def long_metrics(x: Layers) -> DataFrame:
    return features.long_metrics(features.multi_resolution(x.features()))


@register(rounded("FROM cells", "metric_value data_coverage relative_score", _LONG + " display_level"))
def map_metric(x: Layers) -> DataFrame:
    """The flagship: from source rows to the scored map of all metrics and resolutions."""
    return x.cells()


# ---- checks ------------------------------------------------------------------------------------------------------

_GROUPS = (("chlor_a",), ("poc",), ("nflh",), ("sst", "nsst", "sst4"))


def _judged(x: Layers) -> DataFrame:
    return checks.verdict(checks.profile(x.grid(), KEYS, _PROFILED), _GROUPS, START, END)


@register(over("SELECT output_rows, output_rows - distinct_key_rows AS duplicate_key_rows, null_key_rows, 30 - observed_day_count AS missing_day_count, groups_passed, output_rows > 0 AND output_rows = distinct_key_rows AND null_key_rows = 0 AND observed_day_count = 30 AND groups_passed AS passed FROM (SELECT count(*) AS output_rows, count(DISTINCT (event_date, aoi_id, grid_id, grid_row, grid_col)) AS distinct_key_rows, 0::BIGINT AS null_key_rows, count(DISTINCT event_date) AS observed_day_count, count(chlor_a) > 0 AND count(poc) > 0 AND count(nflh) > 0 AND (count(sst) > 0 OR count(nsst) > 0 OR count(sst4) > 0) AS groups_passed FROM grid)"))
def quality_verdict(x: Layers) -> DataFrame:
    return _judged(x).select("output_rows", "duplicate_key_rows", "null_key_rows", "missing_day_count", "groups_passed", "passed")


_VERDICT = "SELECT {columns} FROM (SELECT output_rows, output_rows > 0 AND output_rows = distinct_key_rows AND observed_day_count = 30 AND groups_passed AS passed FROM (SELECT count(*) AS output_rows, count(DISTINCT (event_date, aoi_id, grid_id, grid_row, grid_col)) AS distinct_key_rows, count(DISTINCT event_date) AS observed_day_count, count(chlor_a) > 0 AND count(poc) > 0 AND count(nflh) > 0 AND (count(sst) > 0 OR count(nsst) > 0 OR count(sst4) > 0) AS groups_passed FROM grid))"


def _report(x: Layers) -> str:
    path = new_folder(x.spark, "report")
    sinks.write_report(checks.report_json(_judged(x), dataset="daily_grid", aoi_id=x.area_id), path)
    return path


@register(over(_VERDICT.format(columns="'daily_grid' AS dataset, 'probe' AS aoi_id, output_rows, passed")))
def quality_report_json(x: Layers) -> DataFrame:
    """The report as it was written, parsed back."""
    written = x.spark.read.text(_report(x)).select(F.from_json("value", "dataset string, aoi_id string, output_rows long, passed boolean").alias("r"))
    return written.select("r.*")


@register(over(_VERDICT.format(columns="passed, output_rows, 1::BIGINT AS reports")))
def quality_gate(x: Layers) -> DataFrame:
    """In the order of the job: the report is written first, then the gate passes the verdict on (strict, it would raise on a failed one)."""
    reports = x.spark.read.text(_report(x)).count()
    return checks.gate(_judged(x), strict=False).select("passed", "output_rows", F.lit(reports).cast("long").alias("reports"))


_PAIRS = tuple((c, f"{c}_source") for c in _VALUES)


# Faults put into the features: NaN, a null that claims to be observed, a value without a source, and one marked no_data.
_PLACE = "(grid_row * 7 + grid_col + day(event_date)) % 61"
_FAULTS = {
    "chlor_a": f"CASE WHEN {_PLACE} = 1 THEN CAST('NaN' AS DOUBLE) WHEN {_PLACE} = 2 THEN NULL ELSE chlor_a END",
    "chlor_a_source": f"CASE WHEN {_PLACE} = 2 THEN 'observed' WHEN {_PLACE} = 3 THEN NULL WHEN {_PLACE} = 4 THEN 'no_data' ELSE chlor_a_source END",
}
_FAULTY = "(SELECT * REPLACE (" + ", ".join(f"{sql} AS {c}" for c, sql in _FAULTS.items()) + ") FROM features)"


def _faulty(x: Layers) -> DataFrame:
    return x.features().withColumns({c: F.expr(sql) for c, sql in _FAULTS.items()})


@register(over(f"SELECT event_date, grid_id FROM {_FAULTY} WHERE " + " OR ".join(f"isnan({v}) OR ({v} IS NULL AND ({s} IS NULL OR {s} <> 'no_data')) OR ({v} IS NOT NULL AND ({s} IS NULL OR {s} = 'no_data'))" for v, s in _PAIRS)))
def unexplained_missing(x: Layers) -> DataFrame:
    """Of features with faults put in; those of the job itself have none."""
    return checks.unexplained(_faulty(x), _PAIRS).select("event_date", "grid_id")


@register(over(f"SELECT event_date, grid_id FROM {_FAULTY} WHERE ocean_productivity_score IS NULL OR isnan(ocean_productivity_score) OR chlor_a IS NULL OR isnan(chlor_a)"))
def missing_published(x: Layers) -> DataFrame:
    """The cells without chlorophyll or productivity, of features with faults put in; on the map table there is none."""
    return checks.missing(_faulty(x), ["ocean_productivity_score", "chlor_a"]).select("event_date", "grid_id")


@register(over("SELECT 'grid' AS dataset, count(*) > 0 AS nonempty FROM grid UNION ALL SELECT 'effort', count(*) > 0 FROM effort_grid UNION ALL SELECT 'nsst', count(*) > 0 FROM clean WHERE product = 'NSST'"))
def nonempty_inputs(x: Layers) -> DataFrame:
    return checks.require_rows(grid=x.grid(), effort=x.effort_grid(), nsst=x.clean().where("product = 'NSST'"))


@register(over("SELECT s.aoi_id, s.product_id, s.metric_id, s.resolution_km, count(p.event_date) AS published_scopes, count(*) - count(p.event_date) AS omitted_scopes FROM scopes s LEFT JOIN (SELECT DISTINCT event_date, product_id, metric_id, resolution_km FROM cells) p USING (event_date, product_id, metric_id, resolution_km) GROUP BY ALL"))
def degraded_report(x: Layers) -> DataFrame:
    return checks.degraded_report(x.cells(), x.area_id, START, END)


_KEY_NULL = "event_date IS NULL OR aoi_id IS NULL OR product_id IS NULL OR metric_id IS NULL OR resolution_km IS NULL OR grid_id IS NULL"
_RULES = {
    "key_not_null": _KEY_NULL,
    "required_metric_value": "metric_value IS NULL OR isnan(metric_value)",
    "required_relative_score": "relative_score IS NULL OR isnan(relative_score)",
    "class_display_level": "display_level IS NULL OR display_level NOT IN ('very_low', 'low', 'medium', 'high', 'very_high')",
    "range_relative_score": "relative_score IS NULL OR relative_score NOT BETWEEN 0 AND 100",
    "range_data_coverage": "data_coverage IS NULL OR data_coverage NOT BETWEEN 0 AND 1",
}


@register(over(" UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER ({c}) AS violations FROM cells" for n, c in _RULES.items()) + " UNION ALL SELECT 'key_unique', count(*) FROM (SELECT 1 FROM cells GROUP BY event_date, aoi_id, product_id, metric_id, resolution_km, grid_id HAVING count(*) > 1)"))
def contract_check(x: Layers) -> DataFrame:
    return checks.contract_violations(x.cells(), checks.MAP_CONTRACT)


@register(over("SELECT d.event_date, coalesce(c.n, 0) AS source_rows, coalesce(g.n, 0) AS grid_rows, coalesce(f.n, 0) AS features_rows FROM days d LEFT JOIN (SELECT event_date, count(*) AS n FROM clean GROUP BY 1) c USING (event_date) LEFT JOIN (SELECT event_date, count(*) AS n FROM grid GROUP BY 1) g USING (event_date) LEFT JOIN (SELECT event_date, count(*) AS n FROM features GROUP BY 1) f USING (event_date) WHERE d.event_date >= DATE '2024-01-01'"))
def reconcile_layers(x: Layers) -> DataFrame:
    return checks.reconcile(source=x.clean(), grid=x.grid(), features=x.features())


# ---- serving queries ---------------------------------------------------------------------------------------------


@register(over("SELECT event_date, aoi_id, product_id, metric_id, resolution_km, count(*) AS cells FROM cells WHERE resolution_km = 16 GROUP BY ALL"))
def availability(x: Layers) -> DataFrame:
    return serving.availability(published(x).cells(), aoi=x.area_id, resolution=16)


@register(over("SELECT grid_id, grid_row, grid_col, round(relative_score, 6) AS relative_score, display_level, value_source, round(data_coverage, 6) AS data_coverage, round(relative_score, 6) AS value, resolution_km FROM cells WHERE event_date = DATE '2024-01-20' AND product_id = 'CHL' AND resolution_km = 4"))
def daily_grid(x: Layers) -> DataFrame:
    return serving.daily_grid(published(x).cells(), DAY, x.area_id, "CHL", "chlor_a", 4)


@register(rounded("FROM (SELECT *, fishing_hours_score_avg AS average FROM dashboard) WHERE event_date = DATE '2024-01-20' AND resolution_km = 16", " ".join((*_DAILY, *_RATIOS, *_TREND, "average")), "event_date aoi_id resolution_km cell_count"))
def daily_summary(x: Layers) -> DataFrame:
    return serving.daily_summary(published(x).dashboard(), DAY, x.area_id, "GFW", "fishing_hours", 16)


@register(over("SELECT event_date, round(ocean_productivity_score_avg, 6) AS value FROM dashboard WHERE resolution_km = 32 AND ocean_productivity_score_avg IS NOT NULL AND event_date BETWEEN DATE '2024-01-05' AND DATE '2024-02-04'"))
def trend(x: Layers) -> DataFrame:
    return serving.trend(published(x).dashboard(), DAY, x.area_id, "PRODUCTIVITY", "ocean_productivity_score", 32, 15)


@register(rounded("FROM status WHERE event_date = DATE '2024-01-20' AND resolution_km = 4", _STATUS, "status_class cell_count"))
def status_by_scope(x: Layers) -> DataFrame:
    return serving.status_by_scope(published(x).status(), DAY, x.area_id, 4)


# ---- sources and sinks (written, then read back) -----------------------------------------------------------------


def _monthly(x: Layers) -> str:
    path = new_folder(x.spark, "monthly")
    sinks.write_monthly(x.observations(), path)
    return path


@register(over("SELECT date, product, round(lat, 6) AS lat, round(lon, 6) AS lon, round(value::DOUBLE, 6) AS value, CAST(quality_level AS INT) AS quality_level FROM observations WHERE product = 'CHL'"))
def scan_month_partitions(x: Layers) -> DataFrame:
    return files.scan_months(x.spark, _monthly(x), "CHL", date(2023, 12, 20), date(2024, 1, 31)).select("date", "product", "lat", "lon", "value", "quality_level")


@register(over("SELECT product, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, count(*) AS n, round(sum(value::DOUBLE), 4) AS total FROM observations GROUP BY ALL"))
def relayout_monthly(x: Layers) -> DataFrame:
    return x.spark.read.parquet(_monthly(x)).groupBy("product", "year", "month").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("double")), 4).alias("total"))


@register(rounded("FROM effort", "cell_ll_lat cell_ll_lon hours fishing_hours", "date flag geartype mmsi_present"))
def csv_to_parquet(x: Layers) -> DataFrame:
    source, out = new_folder(x.spark, "csv"), new_folder(x.spark, "parquet")
    x.effort().write.csv(source, header=True)
    files.read_effort_csv(x.spark, source).write.parquet(out)
    return x.spark.read.parquet(out)


@register(over("SELECT CAST(2023 + mmsi_present % 2 AS INT) AS year, count(*) AS n, round(sum(hours), 4) AS hours FROM effort GROUP BY 1"))
def ingest_recursive(x: Layers) -> DataFrame:
    source, out = new_folder(x.spark, "years"), new_folder(x.spark, "parquet")
    for year in (2023, 2024):
        x.effort().where(F.col("mmsi_present") % 2 == year - 2023).write.csv(f"{source}/{year}", header=True)
    files.ingest_recursive(x.spark, source).write.partitionBy("year").parquet(out)
    return x.spark.read.parquet(out).groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum("hours"), 4).alias("hours"))


@register(over("SELECT product, count(DISTINCT (year(date), month(date))) AS files FROM observations WHERE product NOT IN ('CHL', 'POC') GROUP BY product"))
def incremental_files(x: Layers) -> DataFrame:
    found = files.listing(x.spark, _monthly(x), "*.parquet").withColumn("product", F.regexp_extract("path", "product=([^/]+)", 1))
    found = found.withColumn("name", F.concat_ws("/", "product", "name"))  # a task names its files alike in all folders
    done = found.where(F.col("product").isin("CHL", "POC"))
    return files.pending_files(found, done).groupBy("product").agg(F.count("*").alias("files"))


_NAMES = "CASE product WHEN 'CHL' THEN {d8} WHEN 'POC' THEN {d10} WHEN 'NFLH' THEN {p8} ELSE 'undated_2024.nc' END"


@register(over("SELECT name, CASE WHEN name LIKE 'undated%' THEN NULL ELSE date END AS parsed FROM (SELECT DISTINCT CASE WHEN product IN ('CHL', 'POC', 'NFLH') THEN date END AS date, " + _NAMES.format(d8="'AQUA_MODIS.' || strftime(date, '%Y%m%d') || '.L3m.nc'", d10="strftime(date, '%Y-%m-%d') || '.parquet'", p8="'part_' || strftime(date, '%Y%m%d') || '.parquet'") + " AS name FROM observations)"))
def date_from_filename(x: Layers) -> DataFrame:
    name = _NAMES.format(d8="concat('AQUA_MODIS.', date_format(date, 'yyyyMMdd'), '.L3m.nc')", d10="concat(date_format(date, 'yyyy-MM-dd'), '.parquet')", p8="concat('part_', date_format(date, 'yyyyMMdd'), '.parquet')")
    return x.observations().select(F.expr(name).alias("name")).distinct().withColumn("parsed", I.date_from_name(F.col("name")))


@register(over("SELECT 'run-1' AS run_id, product, date AS event_date, 1::BIGINT AS files, true AS hashed FROM observations GROUP BY ALL"))
def file_manifest(x: Layers) -> DataFrame:
    """A file for each product and day, and none of these days reported as broken."""
    path = new_folder(x.spark, "days")
    with sinks.streamed_writes(x.spark):
        x.observations().withColumn("event_date", F.col("date")).repartition("product", "event_date").write.partitionBy("product", "event_date").parquet(path)
    manifest = files.file_manifest(x.spark, path, "run-1")
    broken = files.file_count_violations(manifest, [p.id for p in PRODUCTS], START, END)
    hashed = (F.length("sha256") == 64) & (F.col("bytes") > 0)
    return manifest.join(broken, ["product", "event_date"], "left").select("run_id", "product", "event_date", F.coalesce("files", F.lit(1)).cast("long").alias("files"), hashed.alias("hashed"))


@register(over("SELECT CAST(year(date) AS VARCHAR) AS year, format, 1::BIGINT AS files, true AS has_ratio FROM observations, (SELECT unnest(['csv', 'parquet']) AS format) GROUP BY ALL"))
def file_inventory(x: Layers) -> DataFrame:
    root = new_folder(x.spark, "formats")
    tagged = x.observations().withColumn("year", F.year("date")).repartition("year")
    with sinks.streamed_writes(x.spark):  # a year is one file, so one task: its rows pass through it
        tagged.write.partitionBy("year").csv(f"{root}/csv", header=True)
        tagged.write.partitionBy("year").parquet(f"{root}/parquet")
    return files.file_inventory(x.spark, root, "year").select("year", "format", "files", (F.col("csv_to_parquet") > 0).alias("has_ratio"))


_RASTER_SQL = """WITH c AS (SELECT DATE '2024-01-01' + CAST(vec_id % 30 AS INT) AS date, vec_id, embedding, unnest(range(8)) AS i FROM embeddings),
d AS (SELECT *, unnest(range(8)) AS j FROM c)
SELECT date, round(25 - (i + 0.5) / 24, 6)::DOUBLE AS lat, round(120 + (j + 0.5) / 24, 6)::DOUBLE AS lon, round(embedding[8 * i + j + 1]::DOUBLE, 6) AS value FROM d
WHERE (8 * i + j + vec_id) % 11 <> 0 AND (8 * i + j + vec_id) % 13 <> 0"""


@register(_RASTER_SQL.replace("::DOUBLE, 6)", f"::DOUBLE + {NUDGE}, 6)"))
def raster_to_rows(x: Layers) -> DataFrame:
    return files.raster_to_rows(x.rasters(), [-32767.0]).select("date", "lat", "lon", "value")


@register(over("SELECT product, CASE product " + " ".join(f"WHEN '{p.id}' THEN '{p.unit}'" for p in PRODUCTS) + " END AS unit, CASE product " + " ".join(f"WHEN '{p.id}' THEN '{p.period}'" for p in PRODUCTS) + " END AS period, count(*) AS n FROM clean GROUP BY ALL"))
def product_metadata(x: Layers) -> DataFrame:
    out = new_folder(x.spark, "metadata")
    files.with_product_metadata(x.clean()).write.parquet(out)
    return x.spark.read.parquet(out).groupBy("product", "unit", "period").agg(F.count("*").alias("n"))


@register(rounded("FROM grid", _COLUMNS, _SQL_KEYS))
def write_sharded(x: Layers) -> DataFrame:
    out = new_folder(x.spark, "sharded")
    sinks.write_sharded(x.grid(), out, shards=8)
    return x.spark.read.parquet(out).select(*KEYS, *_COLUMNS.split())


@register(over("SELECT event_date, aoi_id, resolution_km, count(*) AS n, round(sum(relative_score), 4) AS total FROM cells GROUP BY ALL"))
def write_snapshot(x: Layers) -> DataFrame:
    out = new_folder(x.spark, "snapshot")
    sinks.write_snapshot(serving.serving_view(x.cells(), "map_metric", START, END), out)
    return x.spark.read.parquet(out).groupBy(*_SCOPE).agg(F.count("*").alias("n"), F.round(F.sum("relative_score"), 4).alias("total"))


_CHANGED = "SELECT * REPLACE (chlor_a + 1 AS chlor_a) FROM grid WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AND grid_row % 2 = 0"
_REPLACED = f"SELECT event_date, grid_id, round(chlor_a, 6) AS chlor_a FROM (SELECT * FROM grid WHERE NOT event_date BETWEEN DATE '2024-01-10' AND DATE '{{last}}' UNION ALL {_CHANGED})"


def _changed(grid: DataFrame) -> DataFrame:
    rows = clean.in_dates(grid, date(2024, 1, 10), date(2024, 1, 12)).where("grid_row % 2 = 0")
    return rows.withColumn("chlor_a", F.col("chlor_a") + 1)


@register(over(_REPLACED.format(last="2024-01-12")))
def upsert_partitions(x: Layers) -> DataFrame:
    name = new_folder(x.spark, "upsert").rpartition("/")[2].replace("-", "_")
    sinks.upsert_partitions(x.grid(), name, ["event_date"])
    sinks.upsert_partitions(_changed(x.grid()), name, ["event_date"])
    return x.spark.table(name).select("event_date", "grid_id", "chlor_a")


def _released(x: Layers, name: str, **options: int) -> ReleasedTable:
    out = ReleasedTable(x.spark, new_folder(x.spark, name), ["event_date"])
    out.publish(x.grid(), **options)
    return out


@register(over(_REPLACED.format(last="2024-01-14")))
def replace_range(x: Layers) -> DataFrame:
    """Days 13 and 14 lie in the range but have no new row: they vanish."""
    held = _released(x, "ranges")
    held.replace_range(_changed(held.read(F.col("event_date").between("2024-01-10", "2024-01-12"))), date(2024, 1, 10), date(2024, 1, 14))
    return held.read().select("event_date", "grid_id", "chlor_a")


@register(over(_REPLACED.format(last="2024-01-12")))
def merge_partitions(x: Layers) -> DataFrame:
    held = _released(x, "merged")
    held.merge(_changed(held.read()))
    return held.read().select("event_date", "grid_id", "chlor_a")


@register(rounded("FROM grid", _COLUMNS, _SQL_KEYS))
def compact_partitions(x: Layers) -> DataFrame:
    """Files of 20 rows each, rewritten as one for each day."""
    held = _released(x, "compact", maxRecordsPerFile=20)
    held.compact()
    return held.read().select(*KEYS, *_COLUMNS.split())


def queries(names: Sequence[str] = ()) -> dict[str, Query]:
    return {n: q for n, q in QUERIES.items() if not names or n in names}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
