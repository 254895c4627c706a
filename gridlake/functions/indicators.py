"""Columns of the derived indicators and small helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridlake.model import LEVELS


def temperature() -> Column:
    """Sea temperature from the first of the three products that has a value."""
    return F.coalesce("sst4", "nsst", "sst")


def safe_ratio(value: Column, base: Column) -> Column:
    """Null unless both are present and the base is not (nearly) 0."""
    return F.when(value.isNotNull() & (F.abs(base) > 1e-12), value / base)


def productivity(means: dict[str, Column]) -> Column:
    """The sum of each metric's ratio to its mean; null when any ratio is."""
    return reduce(lambda a, b: a + b, [safe_ratio(F.col(name), mean) for name, mean in means.items()])


def observed(*sources: str) -> Column:
    """True when every source column says "observed"."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(s) == "observed", F.lit(False)) for s in sources])


def derived_source(value: Column, *sources: str) -> Column:
    return F.when(value.isNull(), "no_data").when(observed(*sources), "observed").otherwise("derived_with_fill")


def pressure(hours: Column, score: Column) -> Column:
    """Hours for each unit of productivity; 0 without hours, null without productivity."""
    return F.when(score.isNotNull(), F.when(hours <= 0, 0.0).otherwise(hours / F.greatest(score, F.lit(1e-9))))


def coverage(sources: Sequence[str]) -> Column:
    """Share of the sources that are observed."""
    return reduce(lambda a, b: a + b, [observed(s).cast("int") for s in sources]) / F.lit(float(len(sources)))


def display_level(score: Column) -> Column:
    steps = F.when(score >= 20, LEVELS[1]).otherwise(LEVELS[0])
    for least, name in zip((40, 60, 80), LEVELS[2:], strict=True):
        steps = F.when(score >= least, name).otherwise(steps)
    return steps


def status_class(productivity_score: Column, fishing_score: Column, hours: Column) -> Column:
    """One of four classes: each score is high from 60 on; fishing needs hours above 0 too."""
    side = lambda high, name: F.concat(F.when(high, "high").otherwise("low"), F.lit(f"_{name}"))
    return F.concat_ws("_", side(productivity_score >= 60, "productivity"), side((fishing_score >= 60) & (hours > 0), "fishing"))


def shard(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def day_number(day: Column) -> Column:
    return F.unix_date(day)


def date_from_name(name: Column) -> Column:
    """The first valid date in a file name, as digits between dots or as YYYY-MM-DD or YYYYMMDD; else null."""
    pick = lambda pattern, form: F.to_date(F.try_to_timestamp(F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")), F.lit(form)))
    return F.coalesce(pick(r"\.(\d{8})\.", "yyyyMMdd"), pick(r"(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd"), pick(r"(\d{8})", "yyyyMMdd"))
