"""Forms for large areas against the plain ones: ranks in ranges and neighbours in tiles."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlake.model import SCOPE
from gridlake.operators import fill, rank, score
from tests.test_grid import LONG

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def scopes(seed, sizes):
    """Rows of scopes of the given sizes, with many ties; some scopes have nulls or NaN."""
    rng, rows = random.Random(seed), []
    for k, n in enumerate(sizes):
        for c in range(n):
            value = rng.choice([0.0, 0.0, 0.0, 1.5, rng.randint(0, 40) / 4, rng.random()])
            if k % 5 == 4 and c % 7 == 0:
                value = rng.choice([None, float("nan")])
            rows.append((D1 if k % 2 else D2, f"a{k % 3}", "GFW" if k % 4 == 0 else "CHL", f"m{k}", 4, f"c{c}", 1, 1, value, "observed", 1.0))
    return rows


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_ranks_in_ranges_equal_windows(spark, partitions):
    """Ties lie across the borders of ranges (three rows in ten of a scope are 0), small scopes share a range, a large one has many."""
    rows = spark.createDataFrame(scopes(3, [1, 1, 2, 3, 900, 40, 0, 2500, 17, 60]), LONG).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        value = F.col("metric_value")
        dealt = rank.ranked(rows, SCOPE, value, ["grid_id"])
        got = sorted((r["metric_id"], r["grid_id"], r["rank"], r["group_rows"]) for r in dealt.collect())
        window = Window.partitionBy(*SCOPE)
        plain = rows.withColumns({"rank": F.rank().over(window.orderBy("metric_value")), "group_rows": F.count("*").over(window)})
        assert got == sorted((r["metric_id"], r["grid_id"], r["rank"], r["group_rows"]) for r in plain.collect())
        if partitions == 40:
            held = rank._dealt(rows, SCOPE, value, ["grid_id"]).groupBy("_range").agg(F.count("*").alias("n"), F.count_if(F.col("_value") == 0).alias("zeros"))
            sizes = held.collect()
            assert len(sizes) > 20 and max(r["n"] for r in sizes) < 500  # no range has the largest scope, nor its ties
            assert sum(r["zeros"] > 0 for r in sizes) > 10
        a, b = score.relative_score_in_ranges(rows), score.relative_score(rows)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_gate_counts_holes_over_all_ranges(spark):
    rows = spark.createDataFrame(scopes(5, [300, 20, 5, 1, 800, 9]), LONG)
    both = rows.union(rows.withColumns({"resolution_km": F.lit(16), "metric_value": F.lit(1.0)}))  # without holes of its own
    got = score._in_ranges(both, gated=True)
    plain = score.complete_scopes(score.relative_score(both)).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    assert rank.ranked(rows.limit(0), SCOPE, F.col("metric_value"), ["grid_id"]).collect() == []


@pytest.mark.parametrize("tile", [1, 2, 5, 64])
def test_neighbours_in_tiles_equal_joined_ones(spark, tile):
    rng = random.Random(tile)
    rows = [(D1, "a", f"g{r}_{c}", r, c, None if rng.random() < 0.6 else float(rng.randint(0, 99))) for r in range(118, 135) for c in range(3, 16)]
    rows += [(d, "b", f"g{r}_{c}", r, c, float(r + c) if (r, c) == (5, 5) else None) for d in (D1, D2) for r in range(0, 11) for c in range(0, 11)]
    df = spark.createDataFrame(rows, "event_date date, aoi_id string, grid_id string, grid_row smallint, grid_col smallint, v double")
    got = fill.neighbour_means(df, {"v": "near"}, tile)
    want = fill.neighbour_means_by_join(df, "v", "near")
    key = ["event_date", "aoi_id", "grid_id", "grid_row", "grid_col", "v", "near"]
    assert sorted(map(str, got.select(*key).collect())) == sorted(map(str, want.select(*key).collect()))
    shared = fill.with_halos(df, tile).groupBy("event_date", "aoi_id", "_tile_row", "_tile_col").count().agg(F.max("count")).first()[0]
    assert shared <= (tile + 2) ** 2  # a task's share is set by the tile
    copies = fill.with_halos(df, tile).groupBy("event_date", "aoi_id", "grid_id").agg(F.count("*").alias("n"), F.count_if(~F.col("_halo")).alias("own"))
    assert copies.where("own <> 1").isEmpty() and copies.agg(F.max("n")).first()[0] == (9 if tile == 1 else 4)
