"""Staged releases: replaced ranges, merges, compaction, and writes that fail halfway."""

from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridlake.functions.grid import morton
from gridlake.plans import publish
from gridlake.plans.layers import Layers
from gridlake.sources import files
from gridlake.sources.releases import ReleasedTable, ReleaseError

D1 = date(2024, 1, 1)
KIND = "event_date date, aoi_id string, v int, grid_row smallint, grid_col smallint"


def day(n):
    return D1 + timedelta(days=n)


def rows_of(table, **how):
    return sorted((r.event_date, r.aoi_id, r.v) for r in table.read(**how).collect())


@pytest.fixture
def held(spark, tmp_path):
    table = ReleasedTable(spark, f"file://{tmp_path}/t", ["event_date", "aoi_id"])
    table.publish(spark.createDataFrame([(day(n), a, 10 * n, 1, n) for n in range(5) for a in ("x", "y z=1")] + [(None, "x", -1, 0, 0)], KIND))
    return table


def frame(spark, rows):
    return spark.createDataFrame([(d, a, v, 1, 1) for d, a, v in rows], KIND)


def test_merge_replaces_whole_partitions_and_names_others_again(spark, held):
    before = held.files()
    names = {r.file for r in before.collect()}
    was = rows_of(held, where="event_date is not null")
    old = held.current()
    held.merge(frame(spark, [(day(1), "x", 7), (day(1), "x", 8), (day(9), "x", 9)]))
    now = rows_of(held, where="event_date is not null")
    assert now == sorted([r for r in was if r[:2] != (day(1), "x")] + [(day(1), "x", 7), (day(1), "x", 8), (day(9), "x", 9)])
    after = {r.file for r in held.files().collect()}
    assert len(names - after) == 1 and len(after - names) == 2  # one partition replaced, one new, the others' files are the same
    assert rows_of(held, where="event_date is not null", release=old) == was  # a reader of the old release still reads it
    held.merge(frame(spark, [(None, "x", -2)]))
    assert [r.v for r in held.read("event_date is null").collect()] == [-2]


def test_range_without_new_rows_vanishes(spark, held):
    held.replace_range(frame(spark, [(day(2), "x", 99)]), day(1), day(3))
    assert {(d, v) for d, _, v in rows_of(held, where="event_date is not null")} == {(day(0), 0), (day(2), 99), (day(4), 40)}
    before = held.current()
    with pytest.raises(ReleaseError, match="outside"):
        held.replace_range(frame(spark, [(day(8), "x", 1)]), day(1), day(3))
    with pytest.raises(ValueError, match="columns"):
        held.merge(frame(spark, []).drop("v"))
    assert held.current() == before
    held.replace_range(frame(spark, []), day(0), day(9))
    assert held.read("event_date is not null").isEmpty() and held.current().number == before.number + 1


def test_failed_writes_leave_the_old_release(spark, held, monkeypatch):
    was, old = held.read().count(), held.current()
    halfway = frame(spark, [(day(n), "x", n) for n in range(5)]).withColumn("v", F.expr("if(v = 4, raise_error('stopped'), v)").cast("int"))
    with pytest.raises(Exception, match="stopped"):
        held.merge(halfway)
    with pytest.raises(ReleaseError, match="not made current"):  # the check sees the release as readers would
        held.merge(frame(spark, [(day(1), "x", -5)]), check=lambda df: df.where("v = -5"))
    with monkeypatch.context() as patched:
        patched.setattr(ReleasedTable, "_point", lambda *_: (_ for _ in ()).throw(RuntimeError("killed before the pointer")))
        with pytest.raises(RuntimeError, match="killed"):
            held.replace_range(frame(spark, [(day(1), "x", 6)]), day(0), day(4))
    assert held.current() == old and held.read().count() == was
    assert held.merge(frame(spark, [(day(1), "x", 6)]), check=lambda df: df.where("v = -5")).number == old.number + 1
    left = len(list(Path(held.root[7:], "data").iterdir()))
    assert held.expire(keep=1) > 0 and len(list(Path(held.root[7:], "data").iterdir())) < left
    assert held.read().count() == was and [r.v for r in held.read("aoi_id = 'x' and event_date = '2024-01-02'").collect()] == [6]


def test_writer_with_an_old_base_gives_up(spark, held, monkeypatch):
    real = ReleasedTable._staged

    def slow(self, df, *args, **kwargs):
        if df.columns and monkeypatched.pop("once", False):
            ReleasedTable(spark, held.root, held.partitions).merge(frame(spark, [(day(0), "x", 1)]))  # another writer is quicker
        return real(self, df, *args, **kwargs)

    monkeypatched = {"once": True}
    monkeypatch.setattr(ReleasedTable, "_staged", slow)
    with pytest.raises(ReleaseError, match="meanwhile"):
        held.merge(frame(spark, [(day(1), "x", 2)]))
    assert [r.v for r in held.read("event_date = '2024-01-01' and aoi_id = 'x'").collect()] == [1]


def test_reads_name_the_asked_partitions_only(held):
    assert len(held.read("event_date = '2024-01-02'").inputFiles()) == 2
    assert held.read("event_date = '2030-01-01'").isEmpty() and held.read("event_date = '2030-01-01'").columns == KIND.replace(",", "").split()[::2]


def _groups_in_box(paths, box):
    """Row groups whose statistics allow a row of the box."""
    (r0, r1), (c0, c1) = box
    n = 0
    for path in paths:
        meta = pq.ParquetFile(path).metadata
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            s = [meta.row_group(g).column(at[c]).statistics for c in ("grid_row", "grid_col")]
            n += s[0].min <= r1 and s[0].max >= r0 and s[1].min <= c1 and s[1].max >= c0
    return n


def test_compaction_keeps_partitions_and_lays_cells_out(spark, tmp_path):
    cells = spark.range(128 * 128 * 2).selectExpr("date_add(date'2024-01-01', cast(id % 2 as int)) as event_date", "'x' as aoi_id", "cast(id as int) as v", "cast(id div 256 as smallint) as grid_row", "cast((id div 2) % 128 as smallint) as grid_col")
    small = {"maxRecordsPerFile": 2000}
    held = ReleasedTable(spark, f"file://{tmp_path}/t", ["event_date", "aoi_id"])
    held.publish(cells.where("event_date = '2024-01-01'").union(cells.where("event_date = '2024-01-02' and grid_row < 100")), **small)
    held.merge(cells.where("event_date = '2024-01-02'"))  # one large file: it stays
    before = {r.file: r for r in held.files().collect()}
    kept = {f for f in before if "01-02" in f}
    whole = sorted(map(tuple, held.read().collect()))
    assert {r.bin for r in held.bins(1 << 30, small_bytes=60_000).collect()} == {0} and held.bins(20_000, small_bytes=60_000).select("bin").distinct().count() > 1
    row_groups = {"parquet.block.row.count.limit": 1024}
    done = held.compact(1 << 30, small_bytes=60_000, **row_groups)
    after = {r.file: r for r in held.files().collect()}
    assert kept <= set(after) and len(after) == len(kept) + 1 and sum(r.rows for r in after.values()) == len(whole)
    assert sorted(map(tuple, held.read().collect())) == whole and done.number == 3
    assert held.compact(1 << 30, small_bytes=60_000) == done  # nothing left to do
    # The same rows in order of row and column need more row groups for a box than along the curve.
    by_row = f"{tmp_path}/by_row"
    cells.where("event_date = '2024-01-01'").coalesce(1).sort("grid_row", "grid_col").write.options(**row_groups).parquet(by_row)
    ours, plain = [f"{held.root[7:]}/data/{f}" for f in after if f not in kept], [*Path(by_row).glob("*.parquet")]
    everywhere = ((0, 127), (0, 127))
    assert _groups_in_box(ours, everywhere) == _groups_in_box(plain, everywhere) == 16
    tall = ((0, 127), (70, 77))
    assert _groups_in_box(ours, tall) == 4 and _groups_in_box(plain, tall) == 16
    assert sum(_groups_in_box(ours, ((r, r + 31), (c, c + 7))) for r in range(0, 128, 32) for c in range(0, 128, 8)) < 0.6 * sum(
        _groups_in_box(plain, ((r, r + 31), (c, c + 7))) for r in range(0, 128, 32) for c in range(0, 128, 8)
    )


def test_morton_order():
    want = lambda r, c: sum(((r >> b & 1) << (2 * b + 1)) | ((c >> b & 1) << (2 * b)) for b in range(16))
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    cells = [(0, 0), (1, 2), (4319, 8639), (255, 256), (32767, 1)]
    got = spark.createDataFrame(cells, "r smallint, c smallint").select(morton(F.col("r"), F.col("c")).alias("m")).collect()
    assert [r.m for r in got] == [want(r, c) for r, c in cells]


def test_served_tables_follow_their_sources(spark, tmp_path):
    """A new file of a source table is noticed; the next query publishes a new release."""
    for name in ("events", "lineitem"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    x = Layers(spark, str(tmp_path), area_id="corner", start=D1, end=day(2))
    first = publish.published(x)
    number = first.tables["map_metric"].current().number
    assert publish.published(x).tables["map_metric"].current().number == number
    hours = lambda p: p.dashboard().agg(F.sum("fishing_hours_total")).first()[0]
    before = hours(first)
    spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    again = publish.published(x)
    assert again.tables["map_metric"].current().number == number + 1
    assert hours(again) == pytest.approx(2 * before)
    assert files.fingerprint(spark, x.sources) == files.fingerprint(spark, x.sources)
