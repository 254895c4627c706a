"""Grid operators on hand-built rows, and optimised forms against literal ones."""

from __future__ import annotations

from datetime import date, timedelta
from hashlib import sha256

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlake.functions import grid as G
from gridlake.functions import indicators as I
from gridlake.model import AREAS, KEYS, Area
from gridlake.operators import checks, clean, daily, dashboard, features, fill, score, spine
from gridlake.plans import publish, queries, serving
from gridlake.plans.layers import Layers
from gridlake.sources import files, sinks

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)
LONG = "event_date date, aoi_id string, product_id string, metric_id string, resolution_km int, grid_id string, grid_row smallint, grid_col smallint, metric_value double, value_source string, data_coverage double"


def long_rows(spark, rows):
    """(day, product, metric, km, cell, value)"""
    return spark.createDataFrame([(d, "probe", p, m, km, f"c{c}", 1, c, v, "observed" if v is not None else "no_data", 1.0) for d, p, m, km, c, v in rows], LONG)


def test_gate_judges_each_area_day_and_metric_alone(spark):
    """One missing cell at any resolution withholds that metric's day in that area, and nothing else."""
    days = [date(2024, 3, d) for d in (9, 10, 11)]
    metrics = [("GFW", "fishing_hours"), ("SST", "sea_temperature")]
    holes = {("north", days[0], "sea_temperature", 32, 7): None, ("south", days[1], "fishing_hours", 4, 3): float("nan"), ("south", days[2], "sea_temperature", 4, 4): None}
    rows = []
    for area in ("north", "south"):
        for day in days:
            for product, metric in metrics:
                for km, cells in ((4, (3, 4, 5)), (16, (6,)), (32, (7,))):
                    for c in cells:
                        value = holes.get((area, day, metric, km, c), 10.0 * c)
                        rows.append((day, area, product, metric, km, f"c{c}", 1, c, value, "observed" if value is not None else "no_data", 1.0))
    kept = score.complete_scopes(spark.createDataFrame(rows, LONG))
    withheld = {(area, day, metric) for area, day, metric, _, _ in holes}
    want = {(a, d, m, km) for a in ("north", "south") for d in days for _, m in metrics for km in (4, 16, 32) if (a, d, m) not in withheld}
    assert {(r.aoi_id, r.event_date, r.metric_id, r.resolution_km) for r in kept.collect()} == want
    assert checks.omitted_scopes(kept.where("aoi_id = 'north'"), "north", days[0], days[-1]).count() == 3 * 5 * 3 - sum(x[0] == "north" for x in want)


@pytest.mark.parametrize(("values", "scores"), [([0, 0, 5], [0, 0, 100]), ([0, 3, 5], [0, 50, 100]), ([0, 0], [0, 0]), ([7], [100]), ([0], [0]), ([2, 2, 4], [0, 0, 100])])
def test_fishing_scores(spark, values, scores):
    rows = long_rows(spark, [(D1, "GFW", "fishing_hours", 4, c, float(v)) for c, v in enumerate(values)])
    got = {r.grid_id: r.relative_score for r in score.relative_score(rows).collect()}
    assert [got[f"c{c}"] for c in range(len(values))] == scores


@pytest.mark.parametrize("absent", ["chlor_a", "poc", "nflh", "sea_temperature_celsius", None])
def test_indicators_need_all_their_inputs(spark, absent):
    """Of four cells one lacks a value: only what is made of that value is missing there, and no mean counts it as zero."""
    names = ("chlor_a", "poc", "nflh", "sea_temperature_celsius")
    rows = []
    for c in range(4):
        values = [None if c == 3 and n == absent else float((c + 1) * (k + 2)) for k, n in enumerate(names)]
        rows.append((D2, "south", f"c{c}", 1, c, *values, *["no_data" if v is None else "observed" for v in values], 3.0 * c, "observed"))
    columns = ", ".join([*[f"{n} double" for n in names], *[f"{n}_source string" for n in names]])
    table = spark.createDataFrame(rows, f"event_date date, aoi_id string, grid_id string, grid_row int, grid_col int, {columns}, fishing_hours double, fishing_hours_source string")
    got = {r.grid_col: r for r in features.with_indicators(table).collect()}
    lacking = absent in names[:3]
    assert (got[3].ocean_productivity_score is None) == (got[3].sustainability_pressure is None) == lacking
    assert got[3].ocean_productivity_score_source == got[3].sustainability_pressure_source == ("no_data" if lacking else "observed")
    assert got[3].data_coverage == (1.0 if absent is None else 0.75)
    means = [(1 + 2 + 3) / 3 if n == absent else (1 + 2 + 3 + 4) / 4 for n in names[:3]]
    for c in range(3):
        assert got[c].ocean_productivity_score == pytest.approx(sum((c + 1) / m for m in means))
        assert got[c].sustainability_pressure == pytest.approx(3.0 * c / got[c].ocean_productivity_score)


@pytest.fixture(scope="module")
def patchy(spark):
    """A 5 x 6 area over 6 days with a few observations, so that every fill level occurs."""
    area = Area("patch", 24.0, 24.0 + 5 / 24, 120.0, 120.0 + 6 / 24)
    bones = spine.backbone(spark, area, date(2024, 1, 3), date(2024, 1, 6), 3).cache()
    seen = bones.where("pmod(hash(grid_id, event_date), 11) = 0 and event_date > date '2024-01-02'")
    values = seen.select(*KEYS, *[(F.pmod(F.hash("grid_id", F.lit(i)), F.lit(97)) / 7).alias(m) for i, m in enumerate(("chlor_a", "poc", "nflh", "sea_temperature_celsius"))])
    return bones, fill.observed_backbone(bones, values).cache()


def test_sliding_neighbours_equal_joined_neighbours(spark, patchy):
    means = fill.trailing_cell_means(patchy[1], ["chlor_a"], 3).cache()
    slid = fill.neighbour_means(means, {"chlor_a_cell_mean": "near"}).select("event_date", "grid_id", F.round("near", 9).alias("near"))
    joined = fill.neighbour_means_by_join(means, "chlor_a_cell_mean", "near").select("event_date", "grid_id", F.round("near", 9).alias("near"))
    assert slid.exceptAll(joined).isEmpty() and joined.exceptAll(slid).isEmpty()
    assert slid.where("near is not null").count() > 20


def test_area_mean_from_daily_sums_equals_the_direct_window(spark, patchy):
    day = I.day_number(F.col("event_date"))
    direct = patchy[1].select("event_date", F.round(F.avg("poc").over(Window.partitionBy("aoi_id").orderBy(day).rangeBetween(-2, 0)), 9).alias("poc_area_mean")).distinct()
    summed = fill.trailing_area_means(patchy[1], ["poc"], 3).select("event_date", F.round("poc_area_mean", 9).alias("poc_area_mean"))
    assert direct.exceptAll(summed).isEmpty() and summed.exceptAll(direct).isEmpty()


def test_every_fill_level_in_order(spark, patchy):
    filled = fill.gap_fill(patchy[1], 3)
    levels = {r.chlor_a_source for r in filled.collect()}
    assert levels == {"observed", "grid_3d_mean", "neighbor_3d_mean", "aoi_3d_mean", "no_data"}
    assert checks.unexplained(filled, [("chlor_a", "chlor_a_source")]).isEmpty()
    assert filled.where("chlor_a is null").select("event_date").distinct().count() == 2  # nothing was seen before day 3
    with pytest.raises(ValueError):
        fill.gap_fill(patchy[1], 0)


def test_edges_of_an_area(spark):
    probe = AREAS["probe"]
    points = spark.createDataFrame([(24.0, 120.5), (25.0, 121.0), (24.999, 120.0), (23.999, 120.5)], "lat double, lon double")
    inside = G.with_grid(clean.clip_areas(points, [probe, AREAS["taiwan"]]))
    assert inside.where("aoi_id = 'probe'").count() == 3 and inside.where("aoi_id = 'taiwan'").count() == 4
    assert inside.where("aoi_id = 'probe' and lat = 24.0").first().grid_row == 1584
    assert spine.extent(probe) == (1560, 1583, 7200, 7223) and spine.cell_spine(spark, probe).count() == 576
    assert [spine.cell_spine(spark, AREAS[a]).count() for a in ("taiwan", "wide")] == [24192, 57600]
    assert spine.backbone(spark, probe, D1, D2, 3).groupBy("event_date").count().count() == 4


def test_source_rows_that_are_not_fit(spark):
    rows = [("2024-01-01", "SST", 24.5, 120.5, 20.0, None), ("2024-01-01", "SST", 24.5, 120.5, 20.0, 1), ("2024-01-01", "SST", 24.5, 120.5, 20.0, 2), ("2024-01-01", "CHL", 24.5, 120.5, 1.0, None), ("x", "CHL", 24.5, 120.5, 1.0, 1), ("2024-01-01", "CHL", 24.5, 120.5, float("nan"), 1), ("2024-01-01", "CHL", 24.5, 120.5, 0.000998, 1), (None, "POC", None, 120.5, 1.0, 1)]
    table = spark.createDataFrame(rows, "date string, product string, lat double, lon double, value double, quality_level int")
    cleaned = daily.clean_observations(table, [AREAS["probe"]], D1, D1)
    assert sorted(r.product for r in cleaned.collect()) == ["CHL", "SST"]
    assert daily.clean_observations(table.drop("quality_level"), [AREAS["probe"]], D1, D1).where("product = 'SST'").count() == 3
    effort = [("2024-01-01", 24.5, 120.5, "f", "g", 2.0, 1.0, 3.0), ("2024-01-01", 24.5, 120.5, "f", "g", 2.0, 3.0, 1.0), ("bad", 24.5, 120.5, "f", "g", 2.0, 1.0, 1.0), ("2024-01-01", 24.5, 120.5, "f", "g", None, 1.0, 1.0), ("2024-01-01", 24.5, 120.5, "f", "g", 2.0, 1.0, float("nan"))]
    table = spark.createDataFrame(effort, "date string, cell_ll_lat double, cell_ll_lon double, flag string, geartype string, hours double, fishing_hours double, mmsi_present double")
    got = daily.effort_grid(daily.clean_effort(table, [AREAS["probe"]], D1, D1)).collect()
    assert [(r.presence_hours, r.fishing_hours, r.vessel_presence_count) for r in got] == [(2.0, 1.0, 3)]
    values = spark.createDataFrame([(1.0,), (float("inf"),), (float("-inf"),), (float("nan"),), (None,), (-32767.0,)], "v double")
    assert [r.v for r in clean.drop_missing(values, "v", [-32767.0]).collect()] == [1.0]


def test_coarse_cells_partly_inside(spark):
    base = spark.createDataFrame([(D1, "a", f"c{i}", 1567 + i, 7204, 1.0, 2.0, 3.0, 1.0, 1.0) for i in range(3)], "event_date date, aoi_id string, grid_id string, grid_row int, grid_col int, chlor_a double, sea_temperature_celsius double, ocean_productivity_score double, fishing_hours double, data_coverage double")
    fine = base.withColumns({f"{m}_source": F.lit("observed") for m in ("chlor_a", "sea_temperature_celsius", "ocean_productivity_score", "fishing_hours")})
    got = {(r.resolution_km, r.grid_row): (r.fishing_hours, round(r.sustainability_pressure, 6)) for r in features.multi_resolution(fine).collect()}
    assert got == {(4, 1567): (1.0, 0.333333), (4, 1568): (1.0, 0.333333), (4, 1569): (1.0, 0.333333), (16, 1564): (1.0, 0.333333), (16, 1568): (2.0, 0.666667), (32, 1560): (1.0, 0.333333), (32, 1568): (2.0, 0.666667)}


def test_dashboard_without_a_metric(spark):
    cells = score.relative_score(long_rows(spark, [(D1, "CHL", "chlor_a", 4, c, float(c)) for c in range(3)])).cache()
    row = dashboard.dashboard_daily(cells).first()
    assert (row.cell_count, row.fishing_hours_total, row.active_cell_ratio, row.share_of_all_fishing_hours) == (3, 0.0, 0.0, 0.0)
    assert row.high_productivity_cell_ratio is None and row.sustainability_pressure_p90 is None
    assert serving.summary_components(dashboard.dashboard_daily(cells)).select("component", "text").collect() == [("high_activity", "0.0%")]
    assert dashboard.status_distribution(cells).isEmpty()
    assert checks.contract_violations(cells, checks.MAP_CONTRACT).where("violations > 0").isEmpty()
    assert checks.contract_violations(cells.union(cells), checks.MAP_CONTRACT).where("rule = 'key_unique'").first().violations == 3


def test_trailing_week_is_by_calendar(spark):
    rows = [(D1 + timedelta(days=d), "a", 4, float(h)) for d, h in ((0, 7), (1, 1), (7, 3), (20, 5))]
    got = spark.createDataFrame(rows, "event_date date, aoi_id string, resolution_km int, h double").select("event_date", dashboard.trailing_7d("h").alias("m")).orderBy("event_date").collect()
    assert [r.m for r in got] == [7.0, 4.0, 2.0, 5.0]


def test_verdict(spark):
    schema = "event_date date, grid_id string, chlor_a double, sst double, sst4 double"
    good = spark.createDataFrame([(D1, "a", 1.0, None, 3.0), (D2, "b", float("nan"), None, None)], schema)
    judge = lambda df, groups=(("chlor_a",), ("sst", "sst4")), end=D2: checks.verdict(checks.profile(df, ["event_date", "grid_id"], ["chlor_a", "sst", "sst4"]), groups, D1, end)
    assert judge(good).first().passed and judge(good).first().chlor_a_invalid == 1
    assert not judge(good, groups=(("sst",),)).first().passed
    assert not judge(good, end=D2 + timedelta(days=1)).first().passed
    assert not judge(good.union(good.limit(1))).first().passed
    assert not judge(good.union(spark.createDataFrame([(D2, None, 1.0, 1.0, 1.0)], schema))).first().passed
    bad = judge(good.limit(0))
    assert not bad.first().passed and checks.gate(bad, strict=False) is bad
    with pytest.raises(checks.QualityError):
        checks.gate(bad)
    assert "output_rows" in checks.report_json(judge(good), dataset="x").first().value


def test_snapshot_replaces_partitions(spark, tmp_path):
    now = spark.createDataFrame([(D1, "a", 4, 1), (D1, "b", 4, 2), (D2, "a", 4, 3)], "event_date date, aoi_id string, resolution_km int, v int")
    new = spark.createDataFrame([(D1, "a", 4, 9)], now.schema)
    sinks.write_snapshot(now, f"{tmp_path}/s")
    sinks.write_snapshot(new, f"{tmp_path}/s")
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_path}/s").collect()) == [2, 3, 9]


def test_files(spark, tmp_path):
    (tmp_path / "2023").mkdir()
    header = "date,cell_ll_lat,cell_ll_lon,flag,geartype,hours,fishing_hours,mmsi_present\n"
    (tmp_path / "2023" / "full.csv").write_text(header + "2023-05-01,1.0,2.0,X,g,3.5,1.5,2\n")
    (tmp_path / "2023" / "empty.csv").write_text(header)
    assert files.ingest_recursive(spark, str(tmp_path)).select("year", "hours").collect() == [(2023, 3.5)]
    found = files.listing(spark, str(tmp_path), "*.csv")
    assert files.pending_files(found, found).isEmpty() and files.pending_files(found, found, overwrite=True).count() == 2
    older = found.withColumn("modified", F.col("modified") - F.expr("interval 1 day"))
    assert files.pending_files(found, older).count() == 2
    names = spark.createDataFrame([("AQUA_MODIS.20240229.L3m.nc",), ("2024-02-30.nc",), ("x_20231231_y",), ("none",)], "n string")
    assert [r.d for r in names.select(I.date_from_name(F.col("n")).alias("d")).collect()] == [date(2024, 2, 29), None, date(2023, 12, 31), None]


def test_month_scan_prunes_folders(spark, tmp_path):
    rows = spark.createDataFrame([(date(2023, 12, 31), "CHL", 1), (date(2024, 1, 5), "CHL", 2), (date(2024, 3, 5), "CHL", 3), (date(2024, 1, 5), "SST", 4)], "date date, product string, v int")
    sinks.write_monthly(rows, f"{tmp_path}/m")
    scan = files.scan_months(spark, f"{tmp_path}/m", "CHL", date(2023, 12, 15), date(2024, 1, 20))
    assert sorted(r.v for r in scan.collect()) == [1, 2]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(product" in plan and "PushedFilters: []" in plan


def test_serving_arguments(spark):
    cells = score.relative_score(long_rows(spark, [(d, "CHL", "chlor_a", 4, c, float(c)) for d in (D1, D2) for c in range(3)]))
    assert serving.daily_grid(cells, D1, "probe", "CHL", "chlor_a", 4, most=2).count() == 3  # one more than asked: too many
    assert serving.availability(cells).count() == 2
    for wrong in ({"aoi": "x"}, {"product": "CHL", "metric": "fishing_hours"}, {"resolution": 5}):
        with pytest.raises(ValueError):
            serving.availability(cells, **wrong)
    daily_rows = dashboard.dashboard_daily(cells)
    assert serving.trend(daily_rows, D1, "probe", "CHL", "chlor_a", 4, None).count() == 2
    with pytest.raises(ValueError):
        serving.trend(daily_rows, D1, "probe", "CHL", "chlor_a", 4, 7)
    pick = lambda day: serving.asof_date(cells, day).first().event_date
    assert [pick(D1), pick(date(2024, 2, 1)), pick(date(2023, 1, 1))] == [D1, D2, D2]


def test_rasters(spark):
    table = spark.createDataFrame([(D1, [1.0, 2.0], [5.0], [[1.0], [-9.0]], [[0], [1]])], "date date, lat array<float>, lon array<float>, values array<array<float>>, quality array<array<int>>")
    assert [tuple(r) for r in files.raster_to_rows(table, [-9.0]).collect()] == [(D1, 1.0, 5.0, 1.0, 0)]


def test_outer_box_reaches_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    rows = [("2024-01-02", "CHL", 24.0 + i / 10, 119.5 + i / 10, 1.0, 1) for i in range(12)]
    spark.createDataFrame(rows, "date string, product string, lat double, lon double, value double, quality_level int").write.parquet(f"{tmp_path}/obs")
    areas = [AREAS["probe"], Area("east", 24.2, 24.6, 120.3, 120.6)]
    found = daily.clean_observations(spark.read.parquet(f"{tmp_path}/obs"), areas, D1, D2)
    plan = found._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters") :]
    for part in ("GreaterThanOrEqual(lat,24.0)", "LessThanOrEqual(lat,25.0)", "GreaterThanOrEqual(lon,120.0)", "LessThanOrEqual(lon,121.0)"):
        assert part in pushed
    want = sorted((a.id, r[2]) for r in rows for a in areas if a.min_lat <= r[2] <= a.max_lat and a.min_lon <= r[3] <= a.max_lon)
    assert sorted((r.aoi_id, r.lat) for r in found.collect()) == want


def test_night_temperature_stands_between(spark):
    rows = [(D1, c, sst4, nsst, sst) for c, (sst4, nsst, sst) in enumerate([(4.0, 5.0, 6.0), (None, 5.0, 6.0), (None, None, 6.0), (None, None, None), (None, 5.0, None)])]
    seen = spark.createDataFrame(rows, "event_date date, c int, sst4 double, nsst double, sst double")
    got = [r.t for r in seen.select("c", I.temperature().alias("t")).orderBy("c").collect()]
    assert got == [4.0, 5.0, 6.0, None, 5.0]


def test_sinks_lay_files_out(spark, tmp_path):
    rows = [(date(2024, 1, 1 + i % 3), "probe", 4, "CHL", "chlor_a", f"g{i:03}", float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "event_date date, aoi_id string, resolution_km int, product_id string, metric_id string, grid_id string, metric_value double")
    sinks.write_sharded(df, f"{tmp_path}/sharded", shards=4)
    per_day = {d.name: sum(1 for _ in d.glob("*.zstd.parquet")) for d in (tmp_path / "sharded").glob("event_date=*")}
    assert len(per_day) == 3 and all(1 <= n <= 4 for n in per_day.values())
    shards = spark.read.parquet(f"{tmp_path}/sharded").select(I.shard(F.col("grid_id"), 4).alias("s"), F.input_file_name().alias("f")).distinct()
    assert shards.groupBy("f").count().count() <= 12
    sinks.write_snapshot(df, f"{tmp_path}/snap")
    assert sorted(p.relative_to(tmp_path / "snap").parent.as_posix() for p in (tmp_path / "snap").rglob("*.zstd.parquet")) == [f"event_date=2024-01-0{d}/aoi_id=probe/resolution_km=4" for d in (1, 2, 3)]
    sinks.write_snapshot(df.where("event_date = date '2024-01-02'").withColumn("metric_value", F.lit(0.0)), f"{tmp_path}/snap")
    assert spark.read.parquet(f"{tmp_path}/snap").groupBy("event_date").agg(F.sum("metric_value").alias("s")).where("s = 0").count() == 1


def test_upsert_leaves_the_session_alone(spark):
    table, mode = "upsert_test", spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    make = lambda rows: spark.createDataFrame(rows, "grid_id string, v int, event_date date")
    sinks.upsert_partitions(make([("b", 1, D1), ("a", 2, D1), ("c", 3, D2)]), table, ["event_date"])
    sinks.upsert_partitions(make([("d", 4, D2), ("e", 5, date(2024, 1, 3))]), table, ["event_date"])
    assert sorted((r.grid_id, r.v, r.event_date.day) for r in spark.table(table).collect()) == [("a", 2, 1), ("b", 1, 1), ("d", 4, 2), ("e", 5, 3)]
    assert [r.grid_id for r in spark.table(table).where("event_date = date '2024-01-01'").collect()] == ["a", "b"]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    spark.sql(f"DROP TABLE {table}")


def test_file_bookkeeping(spark, tmp_path):
    for product, day in (("CHL", 1), ("CHL", 2), ("POC", 1)):
        folder = tmp_path / f"files/product={product}/event_date=2024-01-0{day}"
        folder.mkdir(parents=True)
        (folder / "x.parquet").write_bytes(f"{product}{day}".encode())
    (tmp_path / "files/product=CHL/event_date=2024-01-02/again.parquet").write_bytes(b"twice")
    (tmp_path / "files/product=CHL/event_date=2024-01-02/again.csv").write_bytes(b"0123456789")
    manifest = files.file_manifest(spark, str(tmp_path / "files"), "r")
    assert {(r.product, r.event_date.day, r.bytes, r.sha256) for r in manifest.where("file = 'x.parquet'").collect()} == {(p, d, 4, sha256(f"{p}{d}".encode()).hexdigest()) for p, d in (("CHL", 1), ("CHL", 2), ("POC", 1))}
    broken = files.file_count_violations(manifest, ["CHL", "POC"], D1, D2)
    assert {(r.product, r.event_date.day, r.files) for r in broken.collect()} == {("CHL", 2, 2), ("POC", 2, 0)}
    counted = {(r.event_date, r.format): (r.files, r.bytes, r.csv_to_parquet) for r in files.file_inventory(spark, str(tmp_path / "files"), "event_date").collect()}
    assert counted == {("2024-01-01", "parquet"): (2, 8, None), ("2024-01-02", "parquet"): (2, 9, 10 / 9), ("2024-01-02", "csv"): (1, 10, 10 / 9)}
    sinks.write_report(checks.report_json(spark.sql("select true as passed, 3L as output_rows"), dataset="d"), f"{tmp_path}/report")
    assert [r.value for r in spark.read.text(f"{tmp_path}/report").collect()] == ['{"dataset":"d","passed":true,"output_rows":3}']
    stamped = clean.audited(spark.range(2), "9").collect()
    assert len({r.updated_at_utc for r in stamped}) == 1 and {r.pipeline_version for r in stamped} == {"9"}


def test_serving_reads_partitions(spark, tmp_path):
    layers = Layers(spark, "/root/testdata/sf0.001", start=D1, end=date(2024, 1, 4))
    publish.publish(layers, f"file://{tmp_path}/serving")
    stored = publish.Published(spark, f"file://{tmp_path}/serving")
    grid = serving.daily_grid(stored.cells(), D2, "probe", "CHL", "chlor_a", 16)
    plan = grid._jdf.queryExecution().toString()
    scan = plan[plan.rindex("PartitionFilters") :].split("PushedFilters")[0]
    assert all(part in scan for part in ("event_date", "aoi_id", "resolution_km"))
    assert grid.count() == 36
    trend = serving.trend(stored.dashboard(), D2, "probe", "CHL", "chlor_a", 32, None)
    assert "resolution_km" in trend._jdf.queryExecution().toString().split("PartitionFilters")[-1].split("PushedFilters")[0]
    assert [tuple(r) for r in trend.collect()] == [tuple(r) for r in serving.trend(layers.dashboard(), D2, "probe", "CHL", "chlor_a", 32, None).collect()]
    counts = lambda status: sorted((r.event_date, r.resolution_km, r.status_class, r.cell_count) for r in status.collect())
    assert counts(stored.status()) == counts(layers.status())


def test_a_task_that_writes_one_folder_does_not_hold_its_rows(spark, tmp_path):
    """Stages that write files need no memory for a sort; a task with more folders than open files still writes them all."""
    sc = spark.sparkContext
    before = spark.conf.get(sinks._OPEN_FILES, None)
    sc.setJobGroup("streamed", "")
    queries.QUERIES["file_inventory"](spark, "/root/testdata/sf0.001")
    rows = spark.range(0, 3000, 1, 1).selectExpr("id", "date'2024-01-01' + cast(id % 30 as int) as date", "concat('P', id % 2) as product")
    sinks.write_monthly(rows, f"{tmp_path}/one")
    sc.setLocalProperty("spark.jobGroup.id", None)
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    tracker, store = sc.statusTracker(), sc._jsc.sc().statusStore()
    stages = [store.lastStageAttempt(k) for job in tracker.getJobIdsForGroup("streamed") for k in tracker.getJobInfo(job).stageIds]
    writing = [s.peakExecutionMemory() for s in stages if s.outputBytes() > 0]
    assert len(writing) >= 3 and set(writing) == {0}
    assert spark.read.parquet(f"{tmp_path}/one").count() == 3000 and spark.conf.get(sinks._OPEN_FILES, None) == before
    with sinks.streamed_writes(spark, files=3):
        rows.write.partitionBy("date").parquet(f"{tmp_path}/many")
    found = spark.read.parquet(f"{tmp_path}/many")
    assert sorted(map(tuple, found.select(*rows.columns).collect())) == sorted(map(tuple, rows.collect()))
