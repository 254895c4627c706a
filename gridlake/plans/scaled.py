"""Registered queries of the forms made for areas and tables that no task can hold; the results are those of the plain forms."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.model import ENVIRONMENT, KEYS, PRODUCTS
from gridlake.operators import checks, clean, fill, reconcile, score, sketches
from gridlake.plans import incremental
from gridlake.plans.layers import END, START, Layers, table
from gridlake.plans.layers_sql import NUDGE, over, rounded
from gridlake.plans.registry import register
from gridlake.sources import rasters
from gridlake.sources.workspace import new_folder
from gridlake.streaming import ingest

_NEAR = {f"{m}_cell_mean": f"{m}_near" for m in ENVIRONMENT}


# ---- ranks in ranges, neighbours in tiles ------------------------------------------------------------------------


@register(over("SELECT event_date, metric_id, resolution_km, grid_id, round(relative_score, 6) AS relative_score FROM ranked"))
def relative_score_in_ranges(x: Layers) -> DataFrame:
    """Gate and ranks from counts by range: scopes and ties are spread over all tasks."""
    return score.map_metric_in_ranges(x.features()).select("event_date", "metric_id", "resolution_km", "grid_id", "relative_score")


@register(rounded("FROM near", " ".join(_NEAR.values()), "event_date aoi_id grid_row grid_col"))
def neighbor_mean_in_tiles(x: Layers) -> DataFrame:
    """Tiles of 5 x 5 cells, so that borders and corners of tiles are everywhere."""
    means = fill.neighbour_means(fill.trailing_cell_means(x.joined(), ENVIRONMENT, x.window), _NEAR, tile=5)
    return means.select("event_date", "aoi_id", "grid_row", "grid_col", *_NEAR.values())


_WIDE = "event_date, metric_id, resolution_km, display_level, count(*) AS cells, round(sum(relative_score), 4) AS total, round(max(metric_value), 6) AS most, round(min(metric_value), 6) AS least"


@register(over(f"SELECT {_WIDE} FROM cells GROUP BY ALL", "wide"))
def map_metric_wide(x: Layers) -> DataFrame:
    """The whole map over 57,600 cells a day with tiles of 64 x 64 cells and every scope ranked in ranges, summed by scope and level."""
    cells = replace(x, area_id="wide", tile=64, task_cells=0).cells()
    sums = [F.count("*").alias("cells"), F.round(F.sum("relative_score"), 4).alias("total"), F.max("metric_value").alias("most"), F.min("metric_value").alias("least")]
    return cells.groupBy("event_date", "metric_id", "resolution_km", "display_level").agg(*sums)


# ---- rasters by band, files as a stream --------------------------------------------------------------------------

_BOX = "lat BETWEEN 24.7 AND 24.9 AND lon BETWEEN 120.1 AND 130 AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"


@register(
    f"""WITH c AS (SELECT DATE '2024-01-01' + CAST(vec_id % 30 AS INT) AS date, vec_id, embedding, unnest(range(8)) AS i FROM embeddings),
d AS (SELECT *, unnest(range(8)) AS j FROM c)
SELECT date, round(lat + {NUDGE}, 6) AS lat, round(lon + {NUDGE}, 6) AS lon, round(value + {NUDGE}, 6) AS value
FROM (SELECT CAST(date AS DATE) AS date, 25::DOUBLE - (i + 0.5::DOUBLE) / 24 AS lat, 120::DOUBLE + (j + 0.5::DOUBLE) / 24 AS lon, embedding[8 * i + j + 1]::DOUBLE AS value FROM d
WHERE (8 * i + j + vec_id) % 11 <> 0 AND (8 * i + j + vec_id) % 13 <> 0) WHERE {_BOX}"""
)
def raster_files(x: Layers) -> DataFrame:
    """Rasters written as files and read back in bands of a twelfth of a degree; days, bands and columns outside the box aren't read."""
    out = new_folder(x.spark, "rasters")
    rasters.write_rasters(x.rasters().withColumn("name", F.concat(F.lit("r"), F.expr("uuid()"))), out, "value")
    box = {"lat": (24.7, 24.9), "lon": (120.1, 130.0), "days": (date(2024, 1, 5), date(2024, 1, 20))}
    return rasters.read_rasters(x.spark, out, "value", band_degrees=1 / 12, **box).select("date", "lat", "lon", "value")


@register(over("SELECT CAST(2023 + mmsi_present % 2 AS INT) AS year, count(*) AS n, round(sum(hours), 4) AS hours, (SELECT count(*) FROM effort WHERE mmsi_present % 2 = 0) AS first_run, (SELECT count(*) FROM effort WHERE mmsi_present % 2 = 1) AS second_run, 0::BIGINT AS third_run FROM effort GROUP BY 1"))
def ingest_stream(x: Layers) -> DataFrame:
    """Files arrive in two lots; each run reads what is new, the third nothing."""
    source, target, checkpoint = (new_folder(x.spark, n) for n in ("arriving", "ingested", "progress"))
    runs = []
    for year in (2023, 2024):
        x.effort().where(F.col("mmsi_present") % 2 == year - 2023).write.csv(f"{source}/{year}", header=True)
        runs.append(ingest.ingest_available(x.spark, source, target, checkpoint).rows)
    runs.append(ingest.ingest_available(x.spark, source, target, checkpoint).rows)
    found = x.spark.read.parquet(target).groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum("hours"), 4).alias("hours"))
    return found.withColumns({f"{name}_run": F.lit(n).cast("long") for name, n in zip(("first", "second", "third"), runs, strict=True)})


# ---- checks: cells that differ, verdicts of the write itself, sketches --------------------------------------------

_VALUES = [p.column for p in PRODUCTS]
_LOST, _DOUBLED, _CHANGED = ((f"(grid_row * 31 + grid_col + day(event_date)) % 97 = {k}") for k in (0, 1, 2))
_CHANGED = f"{_CHANGED} AND chlor_a IS NOT NULL"


@register(over(" UNION ALL ".join(f"SELECT event_date, aoi_id, grid_row, grid_col, '{n}' AS fault FROM grid WHERE {c}" for n, c in (("lost", _LOST), ("doubled", _DOUBLED), ("changed", _CHANGED)))))
def reconcile_cells(x: Layers) -> DataFrame:
    """A copy of the grid with rows lost, doubled and changed: each is named by day, cell and fault."""
    grid = x.grid()
    copy = grid.where(f"not ({_LOST})").withColumn("chlor_a", F.expr(f"if({_CHANGED}, chlor_a + 0.000001D, chlor_a)"))
    return reconcile.differences(grid, copy.union(copy.where(_DOUBLED)), _VALUES)


@register(over("SELECT event_date, count(*) AS cells, 0::BIGINT AS differing FROM grid GROUP BY event_date"))
def recomputed_cells(x: Layers) -> DataFrame:
    """Every cell of the grid recomputed from its source rows by another way (sampling parameter 1: all cells)."""
    grid = x.grid()
    faults = reconcile.recomputed_differences(x.clean(), grid, one_in=1).groupBy("event_date").agg(F.count("*").alias("n"))
    found = grid.groupBy("event_date").agg(F.count("*").alias("cells")).join(faults, "event_date", "left")
    return found.select("event_date", "cells", F.coalesce("n", F.lit(0)).cast("long").alias("differing"))


_JUDGED = "SELECT count(*) AS output_rows, count(DISTINCT (event_date, aoi_id, grid_id, grid_row, grid_col)) AS distinct_key_rows, count(DISTINCT event_date) AS days, round(min(chlor_a), 6) AS chlor_a_min, count(*) FILTER (sst4 IS NULL) AS sst4_invalid FROM grid WHERE NOT (event_date = DATE '2024-01-07')"


@register(over(f"SELECT output_rows, output_rows - distinct_key_rows AS duplicate_key_rows, 30 - days AS missing_day_count, chlor_a_min, sst4_invalid, false AS passed, output_rows AS written FROM ({_JUDGED})"))
def gated_write(x: Layers) -> DataFrame:
    """A day is missing, which the write itself finds; the table is there all the same, and the gate may refuse to go on."""
    out = new_folder(x.spark, "judged")
    grid = x.grid().where("event_date <> date'2024-01-07'")
    judged = checks.write_judged(grid, out, KEYS, _VALUES, (("chlor_a",), ("poc",), ("nflh",), ("sst", "nsst", "sst4")), START, END)
    written = F.lit(x.spark.read.parquet(out).count()).cast("long")
    return judged.select("output_rows", "duplicate_key_rows", "missing_day_count", "chlor_a_min", "sst4_invalid", "passed", written.alias("written"))


@register(over("SELECT resolution_km, count(*) FILTER (metric_id = 'sustainability_pressure') AS n_values, true AS p90_near, true AS cells_near FROM cells GROUP BY resolution_km"))
def sketched_month(x: Layers) -> DataFrame:
    """A month's 90th percentile and cells from 30 stored daily sketches, held against exact ranks and counts."""
    out = new_folder(x.spark, "sketches")
    cells = x.cells()
    sketches.daily_sketches(cells).write.partitionBy("event_date").parquet(out)
    month = sketches.merged(x.spark.read.parquet(out), ["resolution_km"])
    month = month.select("resolution_km", sketches.quantile(0.9).alias("p90"), sketches.distinct().alias("estimate"), F.expr("kll_sketch_get_n_double(value_sketch)").alias("n_values"))
    value = F.when(F.col("metric_id") == "sustainability_pressure", F.col("metric_value"))
    exact = cells.join(month.select("resolution_km", "p90"), "resolution_km").groupBy("resolution_km").agg(
        F.countDistinct("grid_id").alias("cells"), (F.count_if(value <= F.col("p90")) / F.count(value)).alias("top"), (F.count_if(value < F.col("p90")) / F.count(value)).alias("below")
    )
    error = sketches.rank_error()
    near = (F.col("top") >= 0.9 - error) & (F.col("below") <= 0.9 + error)
    counted = F.abs(F.col("estimate") - F.col("cells")) <= sketches.distinct_error() * F.col("cells")
    return month.join(exact, "resolution_km").select("resolution_km", "n_values", near.alias("p90_near"), counted.alias("cells_near"))


# ---- late data ---------------------------------------------------------------------------------------------------

_LATE = "CAST(ts AS DATE) <> DATE '2024-01-12'"


@register(rounded("FROM cells", "metric_value relative_score", "event_date metric_id resolution_km grid_id"))
def late_rows(x: Layers) -> DataFrame:
    """The events of one day arrive after the first run; the second run makes three days again, and the map is that of a full run."""
    source, root = new_folder(x.spark, "late"), new_folder(x.spark, "refreshed")
    events = table(x.spark, x.sf_dir, "events")
    events.where(_LATE).write.parquet(f"{source}/events.parquet")
    table(x.spark, x.sf_dir, "lineitem").write.parquet(f"{source}/lineitem.parquet")
    own = replace(x, sf_dir=source)
    incremental.refresh(own, root)
    events.where(f"not ({_LATE})").write.mode("append").parquet(f"{source}/events.parquet")
    done = incremental.refresh(own, root)
    if len(done.remade) != x.window:
        raise AssertionError(f"made again: {done}")
    held = incremental.ReleasedTable(x.spark, f"{root}/map_metric", incremental.SERVING_PARTITIONS)
    return held.read().select("event_date", "metric_id", "resolution_km", "grid_id", "metric_value", "relative_score")


# ---- many areas --------------------------------------------------------------------------------------------------

# Areas of very different sizes around the observed cells, some without any point, some of one line.
_AREAS = """SELECT concat('a', c_custkey) AS id, 23.5D + (c_custkey * 37 % 101) / 50D AS min_lat, 23.5D + (c_custkey * 37 % 101) / 50D + (c_custkey % 7) * (c_custkey % 5) / 24D AS max_lat,
119.5D + (c_custkey * 53 % 97) / 48D AS min_lon, 119.5D + (c_custkey * 53 % 97) / 48D + (c_custkey % 11) * (c_custkey % 3) / 24D AS max_lon FROM {customer}"""
_AREAS_SQL = _AREAS.format(customer="customer").replace("concat('a', c_custkey)", "'a' || c_custkey")
for _d in ("23.5", "119.5", "50", "48", "24"):
    _AREAS_SQL = _AREAS_SQL.replace(f"{_d}D", f"{_d}::DOUBLE")


@register(over(f"SELECT a.id AS aoi_id, count(*) AS n, round(sum(metric_value), 4) AS total FROM conformed c JOIN ({_AREAS_SQL}) a ON c.lat BETWEEN a.min_lat AND a.max_lat AND c.lon BETWEEN a.min_lon AND a.max_lon GROUP BY a.id"))
def clip_many_areas(x: Layers) -> DataFrame:
    """An area for each customer: places, with the sums of their rows, meet areas by tiles."""
    areas = x.spark.sql(_AREAS, customer=table(x.spark, x.sf_dir, "customer"))
    sums = clean.area_sums(clean.conform(x.observations()), areas, "metric_value")
    return sums.select("aoi_id", "n", F.round("total", 4).alias("total"))
