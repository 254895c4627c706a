"""Gap filling: own value, trailing mean of the cell, mean of the neighbours' trailing means, trailing mean of the area.

All metrics share one join and one pass of windows. The area's mean is taken from daily sums, never from all cells in one
task; the neighbours' mean comes from two sliding sums (along columns, then rows) over rows dealt by area and day. An
area with more cells than a tile is dealt by tiles instead: squares of cells, each with the cells around it (its halo), so a
task's share is set by the tile and not by the area.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.indicators import day_number, temperature
from gridlake.model import CELL, ENVIRONMENT, KEYS


def observed_backbone(backbone: DataFrame, observed: DataFrame, metrics: Sequence[str] = ENVIRONMENT) -> DataFrame:
    """The backbone with each metric's observed value or null."""
    if "sea_temperature_celsius" in metrics and "sea_temperature_celsius" not in observed.columns:
        observed = observed.withColumn("sea_temperature_celsius", temperature())
    return backbone.join(observed.select(*CELL, *metrics), list(CELL), "left").select(*KEYS, *metrics)


def zero_fill(df: DataFrame, effort: DataFrame) -> DataFrame:
    """Add fishing_hours, 0 where no effort was seen, and where it comes from."""
    joined = df.join(effort.select(*CELL, F.col("fishing_hours").alias("_hours")), list(CELL), "left")
    source = F.when(F.col("_hours").isNotNull(), "observed").otherwise("zero_filled")
    return joined.withColumns({"fishing_hours": F.coalesce("_hours", F.lit(0.0)), "fishing_hours_source": source}).drop("_hours")


def _trailing(window: int, *keys: str):
    return Window.partitionBy(*keys).orderBy(day_number(F.col("event_date"))).rangeBetween(-(window - 1), 0)


def trailing_cell_means(df: DataFrame, metrics: Sequence[str], window: int) -> DataFrame:
    """Add ``<metric>_cell_mean`` and ``<metric>_cell_count`` over the last ``window`` calendar days."""
    over = _trailing(window, "aoi_id", "grid_row", "grid_col")
    return df.withColumns({f"{m}_cell_mean": F.avg(m).over(over) for m in metrics} | {f"{m}_cell_count": F.count(m).over(over) for m in metrics})


def trailing_area_means(df: DataFrame, metrics: Sequence[str], window: int) -> DataFrame:
    """(aoi_id, event_date) with ``<metric>_area_mean``: the mean of all observations of the last ``window`` days."""
    daily = df.groupBy("aoi_id", "event_date").agg(*[F.sum(m).alias(f"_sum_{m}") for m in metrics], *[F.count(m).alias(f"_count_{m}") for m in metrics])
    over = _trailing(window, "aoi_id")
    return daily.select("aoi_id", "event_date", *[F.try_divide(F.sum(f"_sum_{m}").over(over), F.sum(f"_count_{m}").over(over)).alias(f"{m}_area_mean") for m in metrics])


#: Cells along a tile's side: a tile and its halo are 66,564 cells, 1.6 % of them halo.
TILE = 256


def _sliding(dealt: DataFrame, columns: dict[str, str], keys: Sequence[str]) -> DataFrame:
    """The 3 x 3 sums and counts of rows dealt by (some of) the keys, as means where the own value is null."""
    along = Window.partitionBy(*keys, "grid_row").orderBy(F.col("grid_col").cast("int")).rangeBetween(-1, 1)
    across = Window.partitionBy(*keys, "grid_col").orderBy(F.col("grid_row").cast("int")).rangeBetween(-1, 1)
    three = dealt.withColumns({f"_s_{v}": F.sum(v).over(along) for v in columns} | {f"_n_{v}": F.count(v).over(along) for v in columns})
    nine = three.withColumns({f"_ss_{v}": F.sum(f"_s_{v}").over(across) for v in columns} | {f"_nn_{v}": F.sum(f"_n_{v}").over(across) for v in columns})
    means = {new: F.when(F.col(v).isNull(), F.try_divide(F.col(f"_ss_{v}"), F.col(f"_nn_{v}"))) for v, new in columns.items()}
    return nine.withColumns(means).drop(*[f"{p}{v}" for v in columns for p in ("_s_", "_n_", "_ss_", "_nn_")])


def neighbour_means(df: DataFrame, columns: dict[str, str], tile: int | None = None) -> DataFrame:
    """Add, for each (value column: new column), the mean of the up to eight neighbours' values on the same day.

    Meant for cells whose own value is null: there the 3 x 3 sums hold the neighbours only. Other cells get null. The rows
    must have every cell of their rectangle, as a backbone has. With ``tile`` rows are dealt by squares of so many cells a side, else by area and day.
    """
    if tile is None:
        return _sliding(df.repartition("event_date", "aoi_id"), columns, ["event_date", "aoi_id"])
    keys = ["event_date", "aoi_id", "_tile_row", "_tile_col"]
    dealt = with_halos(df, tile).repartition(*keys)
    # Of a halo's cells only the own tile's copy has all neighbours; the others have done their part.
    return _sliding(dealt, columns, keys).where("not _halo").drop("_tile_row", "_tile_col", "_halo")


def with_halos(df: DataFrame, tile: int) -> DataFrame:
    """Each cell in its own tile (``_tile_row``, ``_tile_col``) and, marked ``_halo``, in the tiles that border on it: one at a side, three at a corner."""

    def touched(index: str) -> Column:
        i = F.col(index).cast("int")
        return F.array_distinct(F.transform(F.array(F.lit(0), F.lit(-1), F.lit(1)), lambda step: F.floor((i + step) / F.lit(tile)).cast("int")))

    both = df.withColumn("_tile_row", F.explode(touched("grid_row"))).withColumn("_tile_col", F.explode(touched("grid_col")))
    own = [F.floor(F.col(c).cast("int") / F.lit(tile)).cast("int") == F.col(t) for c, t in (("grid_row", "_tile_row"), ("grid_col", "_tile_col"))]
    return both.withColumn("_halo", ~(own[0] & own[1]))


def neighbour_means_by_join(df: DataFrame, value: str, new: str) -> DataFrame:
    """The same for one column, by joining each missing cell's eight neighbours; kept to check the sliding sums."""
    steps = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in (-1, 0, 1) for c in (-1, 0, 1) if r or c])
    asked = df.where(F.col(value).isNull()).select(*CELL, F.explode(steps).alias("d"))
    asked = asked.withColumns({"_row": F.col("grid_row") + F.col("d.r"), "_col": F.col("grid_col") + F.col("d.c")})
    known = df.where(F.col(value).isNotNull()).select("event_date", "aoi_id", F.col("grid_row").cast("int").alias("_row"), F.col("grid_col").cast("int").alias("_col"), F.col(value).alias("_v"))
    means = asked.join(known, ["event_date", "aoi_id", "_row", "_col"]).groupBy(*CELL).agg(F.avg("_v").alias(new))
    return df.join(means, list(CELL), "left")


def _source(metric: str, window: int) -> Column:
    return (
        F.when(F.col(metric).isNotNull(), "observed")
        .when(F.col(f"{metric}_cell_mean").isNotNull(), f"grid_{window}d_mean")
        .when(F.col(f"{metric}_neighbour_mean").isNotNull(), f"neighbor_{window}d_mean")
        .when(F.col(f"{metric}_area_mean").isNotNull(), f"aoi_{window}d_mean")
        .otherwise("no_data")
    )


def gap_fill(joined: DataFrame, window: int, metrics: Sequence[str] = ENVIRONMENT, tile: int | None = None) -> DataFrame:
    """Fill every metric of an observed backbone; add ``<metric>_source`` and ``<metric>_observation_count_window``. ``tile``: see ``neighbour_means``."""
    if window < 1:
        raise ValueError("the fill window must be one day at least")
    areas = trailing_area_means(joined, metrics, window)
    near = neighbour_means(trailing_cell_means(joined, metrics, window), {f"{m}_cell_mean": f"{m}_neighbour_mean" for m in metrics}, tile)
    full = near.join(areas, ["aoi_id", "event_date"], "left")
    steps = {m: F.coalesce(m, f"{m}_cell_mean", f"{m}_neighbour_mean", f"{m}_area_mean") for m in metrics}
    others = [c for c in joined.columns if c not in (*KEYS, *metrics)]
    return full.select(
        *KEYS,
        *others,
        *[steps[m].alias(m) for m in metrics],
        *[_source(m, window).alias(f"{m}_source") for m in metrics],
        *[F.col(f"{m}_cell_count").cast("int").alias(f"{m}_observation_count_window") for m in metrics],
    )


def join_metrics(frames: Sequence[DataFrame]) -> DataFrame:
    """Inner join of per-metric tables on the five keys, for tables that come apart; ``gap_fill`` needs none."""
    out = frames[0]
    for df in frames[1:]:
        out = out.join(df, list(KEYS))
    return out


def between(df: DataFrame, start: date, end: date) -> DataFrame:
    """Drop the history days that only the fill needed."""
    return df.where(F.col("event_date").between(F.lit(start), F.lit(end)))
