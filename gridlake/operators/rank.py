"""Ranks within groups of any size: no task holds a whole group, nor all rows of one value.

``percent_rank`` over a window sorts a whole group in one task. Here the rows are dealt into ranges by (group, value, and a
hash that splits ties), so a task gets about the same number of rows whatever the groups' sizes. Each range tells for each
group that it touches how many rows it has, its least and greatest value, and how many rows have the greatest. From this
small table come prefix sums: the rows of the group in earlier ranges, and those of them that tie with the first value here.
Inside a range and group an ordinary rank is left, over rows that fit a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.sources.workspace import stored

_MISSING = float("-inf")


def _dealt(df: DataFrame, group: Sequence[str], value: Column, splits: Sequence[str]) -> DataFrame:
    """The rows with ``_value`` and ``_range``, written range by range: ranges are sampled, so they must be fixed before they are counted."""
    keyed = df.withColumns({"_value": F.coalesce(value.cast("double"), F.lit(_MISSING)), "_split": F.xxhash64(*splits)})
    ranges = keyed.repartitionByRange(*group, "_value", "_split").drop("_split")
    return stored(ranges.withColumn("_range", F.spark_partition_id()), "ranges")


def _ranges(dealt: DataFrame, group: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """For each group and range: ``_before`` (rows of earlier ranges), ``_tied`` (those of them with this range's least value), ``_least``, ``_rows`` (of the group).

    Its size is the number of ranges and groups; a group's window holds one row a range.
    """
    keys = [*group, "_range"]
    parts = dealt.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_value").alias("_least"), F.max("_value").alias("_most"), *[F.sum(c).alias(n) for n, c in sums.items()])
    tops = dealt.select(*keys, "_value").join(parts.select(*keys, "_most"), keys).where("_value = _most").groupBy(*keys).agg(F.count("*").alias("_n_most"))
    both = parts.join(tops, keys)
    order = Window.partitionBy(*group).orderBy("_range")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy(*group, "_most").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = both.withColumn("_run", F.sum("_n_most").over(same))
    tied = F.when(F.lag("_most").over(order) == F.col("_least"), F.lag("_run").over(order)).otherwise(0)
    return run.select(
        *keys,
        "_least",
        *sums,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        tied.alias("_tied"),
        F.sum("_n").over(Window.partitionBy(*group)).alias("_rows"),
    )


def ranked(df: DataFrame, group: Sequence[str], value: Column, splits: Sequence[str], sums: dict[str, tuple[Column, Sequence[str]]] | None = None) -> DataFrame:
    """All columns with ``rank`` (1 and the number of rows with a smaller value; equal values share it) and ``group_rows``.

    A null value stands before all others, like minus infinity, NaN after all. ``splits`` names columns whose hash spreads
    rows of equal value; repeated rows are ranked each. ``sums``: further columns, each the sum of an expression over the
    rows that share the named columns (some or all of the group's), made of the ranges' sums. An empty table gives an
    empty table. The rows are written once to the shared folder and read from there.
    """
    sums = sums or {}
    dealt = _dealt(df, group, value, splits)
    ranges = _ranges(dealt, group, {n: c for n, (c, _) in sums.items()})
    if sums:
        ranges = ranges.withColumns({n: F.sum(n).over(Window.partitionBy(*over)) for n, (_, over) in sums.items()})
    keys = [*group, "_range"]
    local = F.rank().over(Window.partitionBy(*keys).orderBy("_value"))
    placed = dealt.withColumn("_local", local).join(ranges, keys)
    rank = F.col("_before") + F.col("_local") - F.when(F.col("_value") == F.col("_least"), F.col("_tied")).otherwise(0)
    return placed.select(*df.columns, *sums, rank.cast("long").alias("rank"), F.col("_rows").alias("group_rows"))
