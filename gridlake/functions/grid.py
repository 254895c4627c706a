"""Columns of the 1/24 degree grid, counted from the north-west corner of the globe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.model import CELLS_PER_DEGREE, FINE_KM


def grid_row(lat: Column) -> Column:
    return F.floor((F.lit(90.0) - lat) * CELLS_PER_DEGREE).cast("short")


def grid_col(lon: Column) -> Column:
    return F.floor((lon + F.lit(180.0)) * CELLS_PER_DEGREE).cast("short")


def fine_grid_id(row: Column, col: Column) -> Column:
    return F.format_string("g4km_r%04d_c%04d", row, col)


def coarse_grid_id(km: Column, row: Column, col: Column) -> Column:
    return F.format_string("r%02dkm_%04d_%04d", km, row, col)


def with_grid(df: DataFrame) -> DataFrame:
    """Add grid_row, grid_col and grid_id from lat and lon. Clip first: a cell index must fit a smallint."""
    placed = df.withColumns({"grid_row": grid_row(F.col("lat")), "grid_col": grid_col(F.col("lon"))})
    return placed.withColumn("grid_id", fine_grid_id(F.col("grid_row"), F.col("grid_col")))


def cell_centre(lower_left: Column) -> Column:
    """The centre of a 0.01 degree cell from its lower-left coordinate."""
    return lower_left + F.lit(0.005)


def coarse(index: Column, km: Column | int) -> Column:
    """A fine row or column snapped to the coarse cell that holds it; the origin is global."""
    factor = (F.lit(km) if isinstance(km, int) else km) / F.lit(FINE_KM)
    return (F.floor(index / factor) * factor).cast("short")


def cell_bounds(row: Column, col: Column, km: Column | int) -> dict[str, Column]:
    """North, south, west and east edges of a cell, in degrees."""
    size = (F.lit(km) if isinstance(km, int) else km) / F.lit(FINE_KM)
    return {
        "north": F.lit(90.0) - row / CELLS_PER_DEGREE,
        "south": F.lit(90.0) - (row + size) / CELLS_PER_DEGREE,
        "west": col / CELLS_PER_DEGREE - F.lit(180.0),
        "east": (col + size) / CELLS_PER_DEGREE - F.lit(180.0),
    }


def _spread(index: Column) -> Column:
    """The bits of a 16-bit number at every second place of a 32-bit one."""
    x = index.cast("long").bitwiseAND(0xFFFF)
    for step, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, step)).bitwiseAND(mask)
    return x


def morton(row: Column, col: Column) -> Column:
    """The place of a cell on the Morton curve, which visits the cells of small squares one after another."""
    return F.shiftleft(_spread(row), 1).bitwiseOR(_spread(col))
