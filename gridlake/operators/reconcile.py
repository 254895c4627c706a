"""Layer reconciliation: which day, and then which cell, of two versions of a table differs, and cells recomputed from source rows.

Checksums don't depend on the order of rows and can be merged: those of parts, added up, are that of the whole. A day's
has the number of rows, the sum of their hashes (a doubled or lost row shows) and their exclusive or. Only days that
differ are compared by cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.model import CELL, PRODUCTS

_SUMS = ("rows", "total", "parity")


def _row_hash(columns: Sequence[str]) -> Column:
    # 0.0 and -0.0 are one value; a null doesn't vanish beside another column's value, since its place is hashed too.
    parts = [F.struct(F.lit(i), F.col(c) + F.lit(0.0) if kind else F.col(c)) for i, (c, kind) in enumerate(columns)]
    return F.xxhash64(*parts)


def _typed(df: DataFrame, columns: Sequence[str]) -> list[tuple[str, bool]]:
    kinds = dict(df.dtypes)
    return [(c, kinds[c] == "double") for c in columns]


def checksums(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("event_date",)) -> DataFrame:
    """``by`` with ``rows``, ``total`` (sum of the rows' hashes) and ``parity`` of the given columns."""
    hashed = df.select(*by, _row_hash(_typed(df, columns)).alias("_h"))
    return hashed.groupBy(*by).agg(F.count("*").alias("rows"), F.sum(F.col("_h").cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"), F.bit_xor("_h").alias("parity"))


def merged(parts: DataFrame, by: Sequence[str] = ("event_date",)) -> DataFrame:
    """The checksums of tables that come in parts, from the parts' checksums (united)."""
    return parts.groupBy(*by).agg(F.sum("rows").alias("rows"), F.sum("total").cast("decimal(38,0)").alias("total"), F.bit_xor("parity").alias("parity"))


def changed_days(before: DataFrame, after: DataFrame, by: Sequence[str] = ("event_date",)) -> DataFrame:
    """The days (or other groups) whose checksums differ, or that only one side has."""
    old, new = (df.select(*[F.col(c).alias(f"{side}{c}") for c in (*by, *_SUMS)]) for df, side in ((before, "o_"), (after, "n_")))
    pairs = old.join(new, on=[F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}")) for c in by], how="full")
    differ = ~(F.col("o_rows").eqNullSafe(F.col("n_rows")) & F.col("o_total").eqNullSafe(F.col("n_total")) & F.col("o_parity").eqNullSafe(F.col("n_parity")))
    return pairs.where(differ).select(*[F.coalesce(f"o_{c}", f"n_{c}").alias(c) for c in by])


def differences(before: DataFrame, after: DataFrame, values: Sequence[str], key: Sequence[str] = CELL) -> DataFrame:
    """``key`` and ``fault`` of each cell that differs: ``lost``, ``added``, ``doubled`` (more rows than before), ``thinned`` (fewer) or ``changed``.

    ``key`` starts with the day. Keys don't have nulls. Cells are compared on days with differing checksums only.
    """
    columns, day = [*key, *values], [key[0]]
    days = changed_days(checksums(before, columns, day), checksums(after, columns, day), day)
    cells = [checksums(df.join(days, day, "left_semi"), columns, key) for df in (before, after)]
    old, new = cells[0], cells[1].select(*key, *[F.col(c).alias(f"n_{c}") for c in _SUMS])
    fault = (
        F.when(F.col("n_rows").isNull(), "lost")
        .when(F.col("rows").isNull(), "added")
        .when(F.col("n_rows") > F.col("rows"), "doubled")
        .when(F.col("n_rows") < F.col("rows"), "thinned")
        .when((F.col("n_total") != F.col("total")) | (F.col("n_parity") != F.col("parity")), "changed")
    )
    return old.join(new, list(key), "full").select(*key, fault.alias("fault")).where("fault is not null")


def sampled(df: DataFrame, one_in: int, seed: int = 0) -> DataFrame:
    """The rows of one in so many cells, the same cells on every day and in every layer; ``one_in`` 1 takes all."""
    return df.where(F.pmod(F.xxhash64("aoi_id", "grid_row", "grid_col", F.lit(seed)), F.lit(one_in)) == 0)


def recomputed(clean: DataFrame, digits: int = 6) -> DataFrame:
    """The daily grid again, by another way: sums and counts of each product as rows, divided and turned into columns last."""
    parts = clean.groupBy(*CELL, "product").agg(F.sum("metric_value").alias("_sum"), F.count("metric_value").alias("_n"))
    means = parts.select(*CELL, "product", F.round(F.try_divide("_sum", "_n"), digits).alias("mean"))
    return means.groupBy(*CELL).agg(*[F.max(F.when(F.col("product") == p.id, F.col("mean"))).alias(p.column) for p in PRODUCTS])


def recomputed_differences(clean: DataFrame, grid: DataFrame, one_in: int = 1000, seed: int = 0) -> DataFrame:
    """``differences`` between sampled cells of the stored grid and the same cells recomputed from their source rows."""
    values = [p.column for p in PRODUCTS]
    return differences(recomputed(sampled(clean, one_in, seed)), sampled(grid, one_in, seed).select(*CELL, *values), values)
