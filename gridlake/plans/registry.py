"""Where the grid engine's queries are registered, each with the oracle SQL that gives the same rows.

Doubles are rounded to 6 digits and smallints widened on both sides, so that results compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.plans.layers import Layers
from gridlake.plans.layers_sql import NUDGE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    near = lambda c: F.round(c.cast("double") + F.lit(NUDGE), digits)
    kinds = {"double": near, "float": near, "smallint": lambda c: c.cast("int")}
    return df.select(*[kinds[kind](F.col(name)).alias(name) if kind in kinds else F.col(name) for name, kind in df.dtypes])


def register(sql: str | None = None) -> Callable[[Callable[[Layers], DataFrame]], Query]:
    """Register a function of the layers under its own name; ``sql`` None leaves only the rows to check."""

    def add(plan: Callable[[Layers], DataFrame]) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(plan(Layers(spark, sf_dir)))

        query.__name__, query.__doc__ = plan.__name__, plan.__doc__
        QUERIES[plan.__name__] = query
        if sql is not None:
            ORACLES[plan.__name__] = sql
        return query

    return add
