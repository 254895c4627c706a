"""The layers as DuckDB SQL, written on their own: literal eight-neighbour joins, window means over all cells."""

from __future__ import annotations

from gridlake.model import AREAS, ENVIRONMENT, PRODUCTS, PUBLISHED, RESOLUTIONS_KM
from gridlake.plans.layers import EFFORT, OBSERVATIONS, placed

_M = ENVIRONMENT
_each = lambda form, names=_M: ", ".join(form.format(m=m) for m in names)
_range = " OR ".join(f"(product = '{p.id}' AND metric_value BETWEEN {p.low} AND {p.high})" for p in PRODUCTS)
_pivot = ", ".join(f"round(avg(metric_value) FILTER (product = '{p.id}'), 6) AS {p.column}" for p in PRODUCTS)
_grid = "CAST(floor((90.0 - lat) * 24) AS INT) AS grid_row, CAST(floor((lon + 180.0) * 24) AS INT) AS grid_col"
_id = "printf('g4km_r%04d_c%04d', grid_row, grid_col) AS grid_id"
_DAY = "event_date, aoi_id, resolution_km"


def _pressure(hours: str, score: str) -> str:
    return f"CASE WHEN {score} IS NULL THEN NULL WHEN {hours} <= 0 THEN 0.0 ELSE {hours} / greatest({score}, 1e-9) END"


def _rolled(metric: str, partly: str) -> str:
    return f"CASE WHEN count({metric}) = 0 THEN 'no_data' WHEN bool_and({metric}_source = 'observed') THEN 'observed' ELSE '{partly}' END AS {metric}_source"


def _share(metric: str, condition: str) -> str:
    return f"avg(CASE WHEN metric_id = '{metric}' THEN CASE WHEN {condition} THEN 1.0 ELSE 0.0 END END)"


def _mean(metric: str, column: str) -> str:
    return f"avg({column}) FILTER (metric_id = '{metric}')"


def _filled(m: str) -> str:
    return f"""coalesce(w.{m}, {m}_cell, {m}_near, {m}_area) AS {m},
    CASE WHEN w.{m} IS NOT NULL THEN 'observed' WHEN {m}_cell IS NOT NULL THEN 'grid_3d_mean' WHEN {m}_near IS NOT NULL THEN 'neighbor_3d_mean'
         WHEN {m}_area IS NOT NULL THEN 'aoi_3d_mean' ELSE 'no_data' END AS {m}_source, CAST({m}_n AS INT) AS {m}_observation_count_window"""


_PRODUCTIVITY = " + ".join(f"CASE WHEN abs(avg({m}) OVER day) > 1e-12 THEN {m} / avg({m}) OVER day END" for m in ("chlor_a", "poc", "nflh"))
_PRODUCTIVE = "chlor_a_source = 'observed' AND poc_source = 'observed' AND nflh_source = 'observed'"

LAYERS = {
    "observations": OBSERVATIONS.replace("{events}", "events"),
    "effort": EFFORT.replace("{lineitem}", "lineitem"),
    "conformed": "SELECT date AS event_date, product, lat, lon, CAST(value AS DOUBLE) AS metric_value, CAST(quality_level AS INT) AS quality_level FROM observations",
    "clipped": """SELECT *, '$AREA' AS aoi_id FROM conformed WHERE event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
        AND lat BETWEEN $LAT AND lon BETWEEN $LON""",
    "ranged": f"SELECT * FROM clipped WHERE {_range}",
    "clean": f"SELECT *, {_id} FROM (SELECT *, {_grid} FROM ranged WHERE product NOT IN ('SST', 'NSST', 'SST4') OR quality_level <= 1)",
    "grid": f"SELECT event_date, aoi_id, grid_id, grid_row, grid_col, {_pivot} FROM clean GROUP BY ALL",
    "effort_conformed": """SELECT CAST(date AS DATE) AS event_date, cell_ll_lat + 0.005::DOUBLE AS lat, cell_ll_lon + 0.005::DOUBLE AS lon,
        hours, fishing_hours, mmsi_present FROM effort""",
    "effort_valid": "SELECT * FROM effort_conformed WHERE hours >= 0 AND fishing_hours BETWEEN 0 AND hours AND mmsi_present >= 0",
    "effort_clean": f"""SELECT *, {_id} FROM (SELECT *, '$AREA' AS aoi_id, {_grid} FROM effort_valid WHERE event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
        AND lat BETWEEN $LAT AND lon BETWEEN $LON)""",
    "effort_grid": """SELECT event_date, aoi_id, grid_id, grid_row, grid_col, round(sum(hours), 6) AS presence_hours, round(sum(fishing_hours), 6) AS fishing_hours,
        CAST(sum(mmsi_present) AS BIGINT) AS vessel_presence_count FROM effort_clean GROUP BY ALL""",
    "cells4": f"SELECT '$AREA' AS aoi_id, {_id}, grid_row, grid_col FROM (SELECT CAST(unnest(range($ROWS)) AS INT) AS grid_row), (SELECT CAST(unnest(range($COLS)) AS INT) AS grid_col)",
    "days": "SELECT CAST(unnest(range(DATE '2023-12-30', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS event_date",
    "backbone": "SELECT * FROM days, cells4",
    "joined": f"""SELECT b.*, {_each('g.{m}', _M[:3])}, coalesce(g.sst4, g.nsst, g.sst) AS {_M[3]}
        FROM backbone b LEFT JOIN grid g USING (event_date, aoi_id, grid_row, grid_col)""",
    "trailed": f"""SELECT *, {_each('avg({m}) OVER w AS {m}_cell, count({m}) OVER w AS {m}_n')} FROM joined
        WINDOW w AS (PARTITION BY aoi_id, grid_row, grid_col ORDER BY event_date - DATE '1970-01-01' RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "around": f"""SELECT a.event_date, a.aoi_id, a.grid_row, a.grid_col, {_each('avg(n.{m}_cell) AS {m}_avg')}
        FROM (SELECT event_date, aoi_id, grid_row, grid_col, unnest([-1, 0, 1]) AS r FROM backbone) a, (SELECT unnest([-1, 0, 1]) AS c) s, trailed n
        WHERE (r <> 0 OR c <> 0) AND n.event_date = a.event_date AND n.aoi_id = a.aoi_id AND n.grid_row = a.grid_row + r AND n.grid_col = a.grid_col + c
        GROUP BY ALL""",
    "near": f"""SELECT w.event_date, w.aoi_id, w.grid_row, w.grid_col, {_each('CASE WHEN w.{m}_cell IS NULL THEN {m}_avg END AS {m}_near')}
        FROM trailed w LEFT JOIN around USING (event_date, aoi_id, grid_row, grid_col)""",
    "area": f"""SELECT d.event_date, j.aoi_id, {_each('avg(j.{m}) AS {m}_area')} FROM days d JOIN joined j ON j.event_date BETWEEN d.event_date - 2 AND d.event_date GROUP BY ALL""",
    "filled": f"""SELECT w.event_date, w.aoi_id, w.grid_id, w.grid_row, w.grid_col, {', '.join(_filled(m) for m in _M)},
        coalesce(e.fishing_hours, 0.0) AS fishing_hours, CASE WHEN e.fishing_hours IS NULL THEN 'zero_filled' ELSE 'observed' END AS fishing_hours_source
        FROM trailed w JOIN near n USING (event_date, aoi_id, grid_row, grid_col) JOIN area a USING (event_date, aoi_id)
        LEFT JOIN effort_grid e USING (event_date, aoi_id, grid_row, grid_col)""",
    "scored": f"SELECT *, {_PRODUCTIVITY} AS ocean_productivity_score FROM filled WINDOW day AS (PARTITION BY event_date, aoi_id)",
    "sourced": f"""SELECT *, {_pressure('fishing_hours', 'ocean_productivity_score')} AS sustainability_pressure,
        CASE WHEN ocean_productivity_score IS NULL THEN 'no_data' WHEN {_PRODUCTIVE} THEN 'observed' ELSE 'derived_with_fill' END AS ocean_productivity_score_source,
        CASE WHEN ocean_productivity_score IS NULL THEN 'no_data' WHEN {_PRODUCTIVE} AND fishing_hours_source = 'observed' THEN 'observed' ELSE 'derived_with_fill' END AS sustainability_pressure_source,
        ({' + '.join(f"CAST({m}_source = 'observed' AS INT)" for m in _M)}) / 4.0::DOUBLE AS data_coverage FROM scored""",
    "features": "SELECT * FROM sourced WHERE event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'",
    "rolled": f"""SELECT event_date, aoi_id, resolution_km, CAST(grid_row - grid_row % (resolution_km // 4) AS INT) AS grid_row, CAST(grid_col - grid_col % (resolution_km // 4) AS INT) AS grid_col,
        avg(chlor_a) AS chlor_a, avg(sea_temperature_celsius) AS sea_temperature_celsius, avg(ocean_productivity_score) AS ocean_productivity_score,
        sum(fishing_hours) AS fishing_hours, avg(data_coverage) AS data_coverage, {_rolled('chlor_a', 'contains_filled')}, {_rolled('sea_temperature_celsius', 'contains_filled')},
        {_rolled('ocean_productivity_score', 'derived_with_fill')}, CASE WHEN bool_and(fishing_hours_source = 'observed') THEN 'observed' ELSE 'zero_filled' END AS fishing_hours_source
        FROM (SELECT * REPLACE (CAST(grid_row AS INT) AS grid_row), CAST(unnest([{', '.join(map(str, RESOLUTIONS_KM))}]) AS INT) AS resolution_km FROM features) GROUP BY 1, 2, 3, 4, 5""",
    "wide": f"""SELECT *, printf('r%02dkm_%04d_%04d', resolution_km, grid_row, grid_col) AS grid_id, {_pressure('fishing_hours', 'ocean_productivity_score')} AS sustainability_pressure,
        CASE WHEN ocean_productivity_score IS NULL THEN 'no_data' WHEN fishing_hours_source = 'observed' AND ocean_productivity_score_source = 'observed' THEN 'observed'
             ELSE 'derived_with_fill' END AS sustainability_pressure_source FROM rolled""",
    "long": " UNION ALL ".join(
        f"SELECT event_date, aoi_id, '{p}' AS product_id, '{m}' AS metric_id, resolution_km, grid_id, grid_row, grid_col, {c} AS metric_value, {c}_source AS value_source, data_coverage FROM wide"
        for p, m, c in PUBLISHED
    ),
    "complete": """SELECT * EXCLUDE (bad) FROM (SELECT *, sum(CASE WHEN metric_value IS NULL OR isnan(metric_value) THEN 1 ELSE 0 END)
        OVER (PARTITION BY event_date, aoi_id, product_id, metric_id) AS bad FROM long) WHERE bad = 0""",
    "ranked": """SELECT *, CASE WHEN product_id = 'GFW' AND metric_value <= 0 THEN 0.0::DOUBLE WHEN count(*) OVER s = 1 THEN 100.0::DOUBLE ELSE percent_rank() OVER (s ORDER BY round(metric_value + 1.234e-11, 9)) * 100 END AS relative_score
        FROM complete WINDOW s AS (PARTITION BY event_date, aoi_id, product_id, metric_id, resolution_km)""",
    "cells": """SELECT *, CASE WHEN relative_score >= 80 THEN 'very_high' WHEN relative_score >= 60 THEN 'high' WHEN relative_score >= 40 THEN 'medium'
        WHEN relative_score >= 20 THEN 'low' ELSE 'very_low' END AS display_level FROM ranked""",
    "daily": f"""SELECT {_DAY}, count(DISTINCT grid_id) AS cell_count, avg(data_coverage) AS data_coverage, {_mean('chlor_a', 'metric_value')} AS chlor_a_avg,
        {_mean('sea_temperature', 'metric_value')} AS sea_temperature_avg, {_mean('ocean_productivity_score', 'metric_value')} AS ocean_productivity_avg,
        {_mean('sustainability_pressure', 'metric_value')} AS sustainability_pressure_avg,
        quantile_disc(metric_value, 0.9) FILTER (metric_id = 'sustainability_pressure') AS sustainability_pressure_p90,
        coalesce(sum(metric_value) FILTER (metric_id = 'fishing_hours'), 0.0) AS fishing_hours_total, coalesce({_share('fishing_hours', 'metric_value > 0')}, 0.0) AS active_cell_ratio,
        coalesce({_share('fishing_hours', 'relative_score >= 80')}, 0.0) AS high_activity_cell_ratio, {_share('ocean_productivity_score', 'relative_score >= 80')} AS high_productivity_cell_ratio,
        {_share('sustainability_pressure', 'relative_score >= 80')} AS high_pressure_cell_ratio, {_mean('chlor_a', 'relative_score')} AS chlor_a_score_avg,
        {_mean('sea_temperature', 'relative_score')} AS sea_temperature_score_avg, {_mean('ocean_productivity_score', 'relative_score')} AS ocean_productivity_score_avg,
        {_mean('sustainability_pressure', 'relative_score')} AS sustainability_pressure_score_avg, {_mean('fishing_hours', 'relative_score')} AS fishing_hours_score_avg
        FROM cells GROUP BY {_DAY}""",
    "dashboard": """SELECT *, CASE WHEN sum(fishing_hours_total) OVER t > 0 THEN fishing_hours_total / sum(fishing_hours_total) OVER t ELSE 0.0 END AS share_of_all_fishing_hours,
        avg(fishing_hours_total) OVER w AS fishing_hours_7d_avg, avg(sustainability_pressure_avg) OVER w AS sustainability_pressure_7d_avg FROM daily
        WINDOW t AS (PARTITION BY event_date, resolution_km), w AS (PARTITION BY aoi_id, resolution_km ORDER BY event_date - DATE '1970-01-01' RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "pairs": f"""SELECT p.event_date, p.aoi_id, p.resolution_km, p.grid_id, p.relative_score AS productivity_score, f.relative_score AS fishing_score, f.metric_value AS fishing_hours
        FROM (SELECT * FROM cells WHERE metric_id = 'ocean_productivity_score') p JOIN (SELECT * FROM cells WHERE metric_id = 'fishing_hours') f USING ({_DAY}, grid_id)""",
    "classed": """SELECT *, CASE WHEN productivity_score >= 60 THEN 'high' ELSE 'low' END || '_productivity_' ||
        CASE WHEN fishing_score >= 60 AND fishing_hours > 0 THEN 'high' ELSE 'low' END || '_fishing' AS status_class FROM pairs""",
    "counted": f"""SELECT {_DAY}, status_class, count(*) AS cell_count, sum(fishing_hours) AS fishing_hours_total, avg(productivity_score) AS productivity_score_avg,
        avg(fishing_score) AS fishing_score_avg FROM classed GROUP BY ALL""",
    "status": f"SELECT *, cell_count / sum(cell_count) OVER (PARTITION BY {_DAY}) AS cell_ratio FROM counted",
    "scopes": f"""SELECT event_date, '$AREA' AS aoi_id, product_id, metric_id, resolution_km FROM (SELECT event_date FROM days WHERE event_date >= DATE '2024-01-01'),
        (VALUES {', '.join(f"('{p}', '{m}')" for p, m, _ in PUBLISHED)}) v(product_id, metric_id), (SELECT CAST(unnest([{', '.join(map(str, RESOLUTIONS_KM))}]) AS INT) AS resolution_km)""",
}



def _of_area(sql: str, area_id: str) -> str:
    a = AREAS[area_id]
    values = {
        "$AREA": a.id,
        "$LAT": f"{a.min_lat} AND {a.max_lat}",
        "$LON": f"{a.min_lon} AND {a.max_lon}",
        "$ROWS": f"{int((90 - a.max_lat) * 24)}, {int((90 - a.min_lat) * 24)}",
        "$COLS": f"{int((a.min_lon + 180) * 24)}, {int((a.max_lon + 180) * 24)}",
    }
    for name, value in values.items():
        sql = sql.replace(name, value)
    return placed(sql, area_id)


#: Added before results are rounded to 6 digits, on both sides: means of values of 6 digits often lie halfway, where noise in
#: the last bit would decide.
NUDGE = 1.234e-8


def over(select: str, area_id: str = "probe") -> str:
    """A query on the layers of one area; those it doesn't need cost nothing."""
    select = select.replace(", 6)", f" + {NUDGE}, 6)")
    return _of_area("WITH " + ",\n".join(f'"{name}" AS ({sql})' for name, sql in LAYERS.items()) + "\n" + select, area_id)


def rounded(select: str, doubles: str = "", others: str = "") -> str:
    """SELECT others, doubles rounded to 6 digits FROM ...; the names are space-separated."""
    columns = [*others.split(), *[f"round({c}, 6) AS {c}" for c in doubles.split()]]
    return over(f"SELECT {', '.join(columns)} {select}")
