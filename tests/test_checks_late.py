"""Reconciliation, checks during the write, sketches, late data, many areas, digests, order of written rows."""

from __future__ import annotations

import hashlib
import random
from dataclasses import replace
from datetime import date, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridlake.model import AREAS, CELL, KEYS, Area
from gridlake.operators import checks, clean, reconcile, sketches
from gridlake.plans import incremental
from gridlake.plans.layers import Layers, table
from gridlake.sources import files, sinks
from gridlake.sources.releases import ReleasedTable

SF = "/root/testdata/sf0.001"
D1 = date(2024, 1, 1)
GRID = "event_date date, aoi_id string, grid_row smallint, grid_col smallint, a double, b double"


def day(n):
    return D1 + timedelta(days=n)


# ---- reconciliation ----------------------------------------------------------------------------------------------


def grid(spark, change=lambda rows: rows):
    rows = [(day(n), "x", r, c, float(r * c), None if (r + c) % 3 == 0 else 0.5 * r) for n in range(4) for r in range(10) for c in range(10)]
    return spark.createDataFrame(change(rows), GRID)


def at(rows, n, r, c):
    return next(k for k, x in enumerate(rows) if x[0] == day(n) and x[2:4] == (r, c))


def faults(found):
    return sorted((r.event_date, r.grid_row, r.grid_col, r.fault) for r in found.collect())


def put(rows, k, **values):
    names = ("event_date", "aoi_id", "grid_row", "grid_col", "a", "b")
    return [*rows[:k], tuple(values.get(n, v) for n, v in zip(names, rows[k], strict=True)), *rows[k + 1 :]]


@pytest.mark.parametrize(
    ("change", "want"),
    [
        (lambda rows: rows[::-1], []),
        (lambda rows: put(rows, at(rows, 2, 3, 4), a=12.0000001), [(day(2), 3, 4, "changed")]),
        (lambda rows: put(rows, at(rows, 0, 0, 5), a=-0.0), []),
        (lambda rows: put(rows, at(rows, 1, 1, 1), a=None), [(day(1), 1, 1, "changed")]),
        (lambda rows: put(rows, at(rows, 1, 2, 2), a=1.0, b=4.0), [(day(1), 2, 2, "changed")]),  # the values of a and b exchanged
        (lambda rows: [x for k, x in enumerate(rows) if k != at(rows, 3, 9, 9)], [(day(3), 9, 9, "lost")]),
        (lambda rows: [*rows, rows[at(rows, 0, 7, 7)]], [(day(0), 7, 7, "doubled")]),
        (lambda rows: [*rows, *[rows[at(rows, 0, 7, 7)]] * 2], [(day(0), 7, 7, "doubled")]),  # an even number of copies
        (lambda rows: [*rows, (day(9), "x", 1, 1, 1.0, 1.0)], [(day(9), 1, 1, "added")]),
        (lambda rows: [x for x in rows if x[0] != day(1)], [(day(1), r, c, "lost") for r in range(10) for c in range(10)]),
        (lambda rows: [(x[0], x[1], x[2], x[3], y[4], x[5]) if x[0] == day(2) and x[2] == 5 and x[3] in (1, 2) else x for x, y in zip(rows, [*rows[1:], rows[0]], strict=True)], [(day(2), 5, 1, "changed"), (day(2), 5, 2, "changed")]),
    ],
)
def test_what_differs_is_named(spark, change, want):
    assert faults(reconcile.differences(grid(spark), grid(spark, change), ["a", "b"])) == want


def test_checksums_merge_in_any_order(spark):
    df = grid(spark)
    whole = reconcile.checksums(df, ["a", "b", "grid_row"])
    parts = [reconcile.checksums(df.where(f"grid_col % 3 = {k}"), ["a", "b", "grid_row"]) for k in (2, 0, 1)]
    together = reconcile.merged(parts[0].union(parts[1]).union(parts[2]))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, together.collect()))
    assert reconcile.changed_days(whole, together).isEmpty()


def test_sampled_cells_are_recomputed(spark):
    x = Layers(spark, SF, start=D1, end=day(5))
    stored = x.grid()
    assert reconcile.recomputed_differences(x.clean(), stored, one_in=1).isEmpty()
    some = reconcile.sampled(stored, 5)
    cells = lambda df: {(r.grid_row, r.grid_col) for r in df.collect()}
    assert 0 < some.count() < stored.count() and cells(some) & cells(stored.join(some, list(CELL), "left_anti")) == set()
    row = some.where("chlor_a is not null").first()
    wrong = stored.withColumn("chlor_a", F.when((F.col("event_date") == row.event_date) & (F.col("grid_id") == row.grid_id), F.col("chlor_a") + 0.001).otherwise(F.col("chlor_a")))
    assert faults(reconcile.recomputed_differences(x.clean(), wrong, one_in=5)) == [(row.event_date, row.grid_row, row.grid_col, "changed")]


# ---- checks during the write -------------------------------------------------------------------------------------


def daily(spark, extra=()):
    rows = [(day(n), "x", f"g{c}", 1, c, None if c == 3 else float(c), float("nan") if n == 1 else 1.0) for n in range(3) for c in range(20)] + list(extra)
    return spark.createDataFrame(rows, "event_date date, aoi_id string, grid_id string, grid_row smallint, grid_col smallint, m double, k double")


@pytest.mark.parametrize("extra", [(), ((day(1), "x", "g4", 1, 4, 9.0, 1.0), (day(1), "x", "g4", 1, 4, 4.0, 2.0)), ((day(2), "x", None, 1, 4, 0.0, 0.0), (day(2), "x", None, 1, 4, 0.0, 0.0))])
def test_the_write_judges_itself(spark, tmp_path, extra):
    """The verdict is that of a profile of the rows, repeated and null keys included, and the rows are all there."""
    df = daily(spark, extra)
    groups = (("m",), ("k",))
    judged = checks.write_judged(df, f"{tmp_path}/t", KEYS, ["m", "k"], groups, D1, day(3))
    want = checks.verdict(checks.profile(df, KEYS, ["m", "k"]), groups, D1, day(3))
    assert judged.columns == want.columns and list(map(str, judged.collect())) == list(map(str, want.collect()))
    back = spark.read.parquet(f"{tmp_path}/t").select(df.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_verdict_and_gate_need_no_second_pass(spark, tmp_path):
    """As many jobs as the plain write, and none for verdict, report and gate."""
    daily(spark).write.parquet(f"{tmp_path}/source")
    df, context = spark.read.parquet(f"{tmp_path}/source"), spark.sparkContext
    jobs = lambda group: len(context.statusTracker().getJobIdsForGroup(group))
    context.setJobGroup("plain", "")
    watched, _ = checks.observed_profile(df, KEYS, ["m"])
    watched.write.partitionBy("event_date").parquet(f"{tmp_path}/plain")
    context.setJobGroup("judged", "")
    judged = checks.write_judged(df, f"{tmp_path}/judged", KEYS, ["m"], (("m",),), D1, day(2))
    context.setJobGroup("", "")
    assert jobs("judged") == jobs("plain")
    assert judged.first().passed and checks.gate(judged, strict=False) is judged
    report = checks.report_json(judged, dataset="daily")
    assert "FileScan" in df._jdf.queryExecution().toString() and all("FileScan" not in d._jdf.queryExecution().toString() for d in (judged, report))
    empty = checks.write_judged(df.limit(0), f"{tmp_path}/none", KEYS, ["m"], (("m",),), D1, day(2))
    with pytest.raises(checks.QualityError):
        checks.gate(empty)


# ---- sketches ----------------------------------------------------------------------------------------------------


def test_sketches_of_days_make_a_month(spark):
    rng = random.Random(6)
    rows = [(day(n), "x", 4, f"g{c}", m, rng.lognormvariate(0, 2) if c % 9 else float("nan")) for n in range(30) for c in range(n, 700) for m in ("sustainability_pressure", "chlor_a")]
    rows += [(day(n), "y", 4, "g1", "chlor_a", 1.0) for n in range(30)]
    cells = spark.createDataFrame(rows, "event_date date, aoi_id string, resolution_km int, grid_id string, metric_id string, metric_value double")
    month = sketches.merged(sketches.daily_sketches(cells), ["aoi_id"])
    got = {r.aoi_id: r for r in month.select("aoi_id", *[sketches.quantile(q).alias(f"q{int(q * 100)}") for q in (0.1, 0.5, 0.9, 0.99)], sketches.distinct().alias("n")).collect()}
    values = sorted(r[5] for r in rows if r[4] == "sustainability_pressure" and r[5] == r[5])
    for q in (0.1, 0.5, 0.9, 0.99):
        rank = sum(v <= got["x"][f"q{int(q * 100)}"] for v in values) / len(values)
        assert abs(rank - q) <= sketches.rank_error() + 1 / len(values)
    assert abs(got["x"].n - 700) <= 700 * sketches.distinct_error() and got["y"].n == 1 and got["y"].q90 is None


# ---- late data ---------------------------------------------------------------------------------------------------


def map_rows(df):
    return sorted((r.event_date, r.metric_id, r.resolution_km, r.grid_id, round(r.metric_value, 9), round(r.relative_score, 6)) for r in df.collect())


def test_late_rows_remake_the_windows_days_only(spark, tmp_path):
    source, root = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    events, lines = table(spark, SF, "events"), table(spark, SF, "lineitem")
    events.where("cast(ts as date) <> date'2024-01-05'").write.parquet(f"{source}/events.parquet")
    lines.write.parquet(f"{source}/lineitem.parquet")
    x = Layers(spark, source, area_id="corner", start=D1, end=day(11))
    assert len(incremental.refresh(x, root).remade) == 12
    assert incremental.refresh(x, root) == incremental.Refreshed((), ())  # nothing new, nothing done
    held = ReleasedTable(spark, f"{root}/map_metric", sinks.SERVING_PARTITIONS)
    before = {r.file for r in held.files().collect()}
    events.where("cast(ts as date) = date'2024-01-05'").write.mode("append").parquet(f"{source}/events.parquet")
    done = incremental.refresh(x, root)
    assert done == incremental.Refreshed((day(4),), (day(4), day(5), day(6)))
    after = {r.file: r.event_date for r in held.files().collect()}
    assert {d for f, d in after.items() if f not in before} <= set(done.remade) and before - set(after)
    assert map_rows(held.read()) == map_rows(x.cells())
    dashboards = lambda df: sorted((r.event_date, r.resolution_km, round(r.fishing_hours_7d_avg, 6), round(r.sustainability_pressure_7d_avg or -1, 6)) for r in df.collect())
    assert dashboards(ReleasedTable(spark, f"{root}/dashboard", ["event_date"]).read()) == dashboards(x.dashboard())
    # Effort reaches its own day only; rows that go leave no trace.
    rest = lines.where("l_orderkey % 30 <> 9")
    rest.write.mode("overwrite").parquet(f"{source}/lineitem.parquet")
    assert incremental.refresh(x, root) == incremental.Refreshed((day(9),), (day(9),))
    assert map_rows(held.read()) == map_rows(x.cells())


def test_spans_and_reach():
    assert incremental.spans([day(5), day(1), day(2), day(9)]) == [(day(1), day(2)), (day(5), day(5)), (day(9), day(9))]
    assert incremental.reached([day(0), day(8)], 3, day(1), day(9)) == {day(1), day(2), day(8), day(9)}
    assert incremental.spans([]) == []


# ---- many areas --------------------------------------------------------------------------------------------------


def test_ten_thousand_areas_without_a_nested_loop(spark):
    rng = random.Random(7)
    areas = []
    for k in range(10_000):
        lat, lon = rng.uniform(-90, 80), rng.uniform(-180, 170)
        high, wide = (rng.choice([0, 0.01, 0.3, 2, 7.5]) for _ in range(2))
        areas.append((f"a{k}", lat, lat + high, lon, lon + wide))
    areas += [("globe", -90.0, 90.0, -180.0, 180.0), ("edge", 24.0, 25.0, 120.0, 121.0), ("dot", 8.0, 8.0, 16.0, 16.0), ("null", None, 1.0, 1.0, 2.0), ("back", 5.0, 4.0, 1.0, 2.0)]
    points = [(k, rng.uniform(-90, 90), rng.uniform(-180, 180)) for k in range(300)] + [(1000 + i, lat, lon) for i, (lat, lon) in enumerate((a, b) for a in (24.0, 25.0, 24.5) for b in (120.0, 121.0))]
    points += [(2000, 8.0, 16.0), (2001, None, 1.0), (2002, 1.0, float("nan"))] + [(3000 + k, areas[k][2], areas[k][4]) for k in range(100)]
    df = spark.createDataFrame(points, "k int, lat double, lon double")
    held = spark.createDataFrame(areas, "id string, min_lat double, max_lat double, min_lon double, max_lon double")
    got = clean.clip_area_table(df, held)
    want = sorted((k, a[0]) for k, lat, lon in points if lat is not None for a in areas if a[1] is not None and a[1] <= lat <= a[2] and a[3] <= lon <= a[4])
    assert sorted((r.k, r.aoi_id) for r in got.collect()) == want
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert clean.clip_area_table(df, held.limit(0)).collect() == []
    few = [AREAS["probe"], AREAS["corner"], Area("line", 24.5, 24.5, 119.0, 122.0)]
    own = spark.createDataFrame([(a.id, a.min_lat, a.max_lat, a.min_lon, a.max_lon) for a in few], held.schema)
    assert sorted(map(tuple, clean.clip_area_table(df, own).collect())) == sorted(map(tuple, clean.clip_areas(df, few).collect()))


def test_rows_of_one_place_meet_areas_once(spark, monkeypatch):
    rng, met, real = random.Random(3), [], clean.clip_area_table
    points = [(rng.choice([1.5, 2.5, -0.0, 0.0]), rng.choice([8.0, 9.0]), rng.choice([None, 0.25, 3.0])) for _ in range(2000)] + [(None, 8.0, 1.0), (1.5, None, 1.0), (7.0, 7.0, None)]
    areas = [(f"a{k}", lat, lat + k % 3, lon, lon + k % 2) for k, (lat, lon) in enumerate((rng.choice([0.0, 1.5, 2.0, 6.0, 40.0]), rng.choice([7.0, 8.0, 8.5])) for _ in range(60))] + [("own", 7.0, 7.0, 7.0, 7.0)]

    def clip(df, held):
        met.append(df)
        return real(df, held)

    monkeypatch.setattr(clean, "clip_area_table", clip)
    df = spark.createDataFrame(points, "lat double, lon double, v double")
    got = clean.area_sums(df, spark.createDataFrame(areas, "id string, min_lat double, max_lat double, min_lon double, max_lon double"), "v")
    want = {}
    for name, low, high, west, east in areas:
        inside = [v for lat, lon, v in points if lat is not None and lon is not None and low <= lat <= high and west <= lon <= east]
        values = [v for v in inside if v is not None]
        want |= {name: (len(inside), sum(values) if values else None)} if inside else {}
    assert {r.aoi_id: (r.n, r.total) for r in got.collect()} == want and (None in {t for _, t in want.values()})
    assert met[0].count() == 7  # six places of 2,000 rows, and one without a value


# ---- digests, order of written rows ------------------------------------------------------------------------------


def test_digests_are_streamed(spark, tmp_path, monkeypatch):
    for name, size in (("product=CHL/a 20240101.parquet", 3), ("product=CHL/b%3D20240102.parquet", 5), ("product=POC/c+20240103.parquet", 3_000_000)):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(random.Random(size).randbytes(size))
    monkeypatch.setattr(files, "_HASHED_BYTES", 1000)
    rows = files.file_manifest(spark, f"file://{tmp_path}", "r").collect()
    assert {(r.product, r.file): (r.bytes, r.sha256) for r in rows} == {(p.parent.name[8:], p.name): (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in tmp_path.rglob("*.parquet")}
    assert sorted(r.event_date for r in rows) == [D1, day(1), day(2)]
    plan = files.file_manifest(spark, str(tmp_path), "r")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow digest" in plan and "sha2(" not in plan  # the column is named sha256


def test_written_rows_stand_in_order(spark, tmp_path):
    """Each file of an upserted table and of a release is sorted by partition, product, metric and cell."""
    rng = random.Random(3)
    rows = [(day(k % 2), p, m, f"g{c:02}", float(c)) for k in range(2) for p, m in (("SST", "b"), ("CHL", "a"), ("CHL", "c")) for c in range(40)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "event_date date, product_id string, metric_id string, grid_id string, v double").repartition(5)
    spark.sql("drop table if exists ordered_rows")
    sinks.upsert_partitions(df, "ordered_rows", ["event_date"])
    sinks.upsert_partitions(df.where("event_date = '2024-01-01'"), "ordered_rows", ["event_date"])
    held = ReleasedTable(spark, f"file://{tmp_path}/t", ["event_date"])
    held.publish(df)
    written = [*spark.table("ordered_rows").inputFiles(), *held.read().inputFiles()]
    assert len(written) == 4
    for path in written:
        got = pq.ParquetFile(files.arrow_path(path)[1]).read(["product_id", "metric_id", "grid_id"]).to_pylist()
        assert len(got) == 120 and [tuple(r.values()) for r in got] == sorted(tuple(r.values()) for r in got)
    spark.sql("drop table ordered_rows")


def test_partial_runs_look_back(spark):
    x = Layers(spark, SF, area_id="corner", start=D1, end=day(8))
    part = replace(x, start=day(4), end=day(6), since=day(2))
    assert map_rows(part.cells()) == [r for r in map_rows(x.cells()) if day(4) <= r[0] <= day(6)]
