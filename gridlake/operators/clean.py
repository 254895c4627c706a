"""Conform and filter source rows. Casts never raise: what can't be read becomes null."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.grid import cell_centre
from gridlake.model import PRODUCTS, VERSION, Area


def conform(df: DataFrame, value_col: str = "value") -> DataFrame:
    """event_date, lat, lon, metric_value, and product and quality_level where the source has them."""
    read = lambda name, kind: F.col(name).try_cast(kind)
    own = [F.col("product")] if "product" in df.columns else []
    quality = [read("quality_level", "int").alias("quality_level")] if "quality_level" in df.columns else []
    return df.select(read("date", "date").alias("event_date"), *own, *[read(c, "double").alias(c) for c in ("lat", "lon")], read(value_col, "double").alias("metric_value"), *quality)


def conform_effort(df: DataFrame) -> DataFrame:
    """Effort rows at the centre of their cell. A count that is not a number becomes null."""
    return df.select(
        F.col("date").try_cast("date").alias("event_date"),
        cell_centre(F.col("cell_ll_lat")).alias("lat"),
        cell_centre(F.col("cell_ll_lon")).alias("lon"),
        F.col("hours").try_cast("double").alias("hours"),
        F.col("fishing_hours").try_cast("double").alias("fishing_hours"),
        F.col("mmsi_present").try_cast("long").alias("mmsi_present"),
    )


def in_dates(df: DataFrame, start: date, end: date) -> DataFrame:
    return df.where(F.col("event_date").between(F.lit(start), F.lit(end)))


def clip_areas(df: DataFrame, areas: Iterable[Area]) -> DataFrame:
    """A row for each area that holds the point, with aoi_id; all four edges belong to an area.

    The areas are part of the expression, so nothing is joined. Their outer box is a plain filter, which reaches the
    scan where lat and lon are columns of a file.
    """
    areas = list(areas)
    box = {edge: pick(getattr(a, edge) for a in areas) for edge, pick in (("min_lat", min), ("max_lat", max), ("min_lon", min), ("max_lon", max))}
    near = df.where(F.col("lat").between(box["min_lat"], box["max_lat"]) & F.col("lon").between(box["min_lon"], box["max_lon"]))
    held = F.array(*[F.struct(F.lit(a.id).alias("id"), *[F.lit(getattr(a, k)).alias(k) for k in box]) for a in areas])
    inside = F.filter(held, lambda a: F.col("lat").between(a["min_lat"], a["max_lat"]) & F.col("lon").between(a["min_lon"], a["max_lon"]))
    return near.withColumn("aoi_id", F.explode(F.transform(inside, lambda a: a["id"])))


#: Degrees of the smallest tile that areas are put on.
_SMALLEST_TILE = 1 / 64


def _level(size: Column) -> Column:
    """The least power of two that is no smaller than a size in degrees."""
    return F.ceil(F.log2(F.greatest(size, F.lit(_SMALLEST_TILE)))).cast("int")


def clip_area_table(df: DataFrame, areas: DataFrame) -> DataFrame:
    """``clip_areas`` for a table of any number of areas (id, min_lat, max_lat, min_lon, max_lon): an equi-join on tiles, then the exact test.

    An area is put on square tiles at least as large as itself, so it touches four at most, whatever its size; the tiles'
    sides are powers of two degrees. A point looks at its one tile of each size in use (a dozen or two). All four edges
    belong to an area; overlapping areas each get the point; an area whose edges are null or out of order has none.
    """
    size = F.greatest(F.col("max_lat") - F.col("min_lat"), F.col("max_lon") - F.col("min_lon"))
    sound = areas.select("id", "min_lat", "max_lat", "min_lon", "max_lon").where("min_lat <= max_lat and min_lon <= max_lon")
    sound = sound.withColumn("_level", _level(size))
    tile = lambda c, level: F.floor(F.col(c) / F.pow(F.lit(2.0), level))
    on = F.col("_level")
    cover = sound.withColumn("_y", F.explode(F.sequence(tile("min_lat", on), tile("max_lat", on)))).withColumn("_x", F.explode(F.sequence(tile("min_lon", on), tile("max_lon", on))))
    levels = sorted(r[0] for r in sound.select("_level").distinct().collect())  # sizes of tiles in use
    if not levels:
        return df.withColumn("aoi_id", F.lit(None).cast(areas.schema["id"].dataType)).limit(0)
    point = df.where("lat is not null and lon is not null").withColumn("_level", F.explode(F.array(*[F.lit(k) for k in levels])))
    point = point.withColumns({"_y": tile("lat", on), "_x": tile("lon", on)})
    inside = F.col("lat").between(F.col("min_lat"), F.col("max_lat")) & F.col("lon").between(F.col("min_lon"), F.col("max_lon"))
    return point.join(cover, ["_level", "_y", "_x"]).where(inside).select(*df.columns, F.col("id").alias("aoi_id"))


def area_sums(df: DataFrame, areas: DataFrame, value: str) -> DataFrame:
    """``aoi_id``, ``n`` rows and ``total`` of a value for each area of a table that holds a point.

    Rows of one place are summed before they meet areas, so an area costs as many rows as it has places, whatever the
    number of days, products and repeats; on a grid that is bounded by the area's cells.
    """
    places = df.where("lat is not null and lon is not null").groupBy("lat", "lon").agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return clip_area_table(places, areas).groupBy("aoi_id").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def valid_range(df: DataFrame) -> DataFrame:
    """Keep values inside their product's range, both ends included; NaN is outside every range."""
    tests = [(F.col("product") == p.id) & F.col("metric_value").between(p.low, p.high) for p in PRODUCTS]
    return df.where(reduce(lambda a, b: a | b, tests))


def valid_quality(df: DataFrame) -> DataFrame:
    """Temperature products need a quality of 1 or better; without a quality column nothing is dropped."""
    if "quality_level" not in df.columns:
        return df
    needing = [p.id for p in PRODUCTS if p.needs_quality]
    return df.where(~F.col("product").isin(needing) | F.coalesce(F.col("quality_level") <= 1, F.lit(False)))


def valid_effort(df: DataFrame) -> DataFrame:
    """Hours and presence not negative, fishing hours between 0 and hours; a null fails."""
    return df.where((F.col("hours") >= 0) & F.col("fishing_hours").between(F.lit(0.0), F.col("hours")) & (F.col("mmsi_present") >= 0))


def drop_missing(df: DataFrame, column: str, sentinels: Sequence[float] = ()) -> DataFrame:
    """Drop nulls, NaN, infinities and the given fill values."""
    value = F.col(column)
    keep: Column = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return df.where(keep & ~value.isin(list(sentinels)) if sentinels else keep)


def round_columns(df: DataFrame, digits: int, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def audited(df: DataFrame, version: str = VERSION) -> DataFrame:
    return df.withColumns({"updated_at_utc": F.current_timestamp(), "pipeline_version": F.lit(version)})
