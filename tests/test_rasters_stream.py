"""The raster source reads what the filters leave; the ingest stream reads each file once."""

from __future__ import annotations

import math
from datetime import date

import numpy as np
import pytest
from pyarrow import fs

from gridlake.sources import rasters
from gridlake.streaming import ingest

LAT, LON = np.arange(89.5, -90, -1.0), np.arange(-179.5, 180, 3.0)


@pytest.fixture
def folder(tmp_path):
    """Two days of one-degree rasters, with holes and quality; other files beside them."""
    rng = np.random.default_rng(1)
    for day in ("20240101", "20240229"):
        values = rng.random((len(LAT), len(LON))).astype(np.float32)
        values[rng.random(values.shape) < 0.3] = np.nan
        (tmp_path / day[:4]).mkdir(exist_ok=True)
        raw = rasters.netcdf_bytes(LAT, LON, "chlor_a", values, quality=rng.integers(0, 4, values.shape))
        (tmp_path / day[:4] / f"AQUA.{day}.L3m.nc").write_bytes(raw)
        np.save(tmp_path / f"{day}.npy", values)
    (tmp_path / "notes.20240101.txt").write_text("no raster")
    (tmp_path / "undated.nc").write_bytes(b"no raster either")
    return tmp_path


def reader_of(folder, band=10, **box):
    return rasters.RasterReader(str(folder), "chlor_a", band, **box)


def test_all_rows_come_back(spark, folder):
    got = {(r.date, r.lat, r.lon): r.value for r in rasters.read_rasters(spark, f"file://{folder}", "chlor_a").collect()}
    want = {}
    for d, name in ((date(2024, 1, 1), "20240101"), (date(2024, 2, 29), "20240229")):
        values = np.load(folder / f"{name}.npy")
        want |= {(d, LAT[i], LON[j]): float(values[i, j]) for i, j in zip(*np.nonzero(~np.isnan(values)), strict=True)}
    assert got == want


def test_outside_the_box_nothing_is_read(folder):
    every = sum(b.num_rows for p in reader_of(folder).partitions() for b in reader_of(folder).read(p))
    reader = reader_of(folder, lat=(15.0, 34.9), lon=(105.0, 135.0), days=(date(2024, 2, 1), date(2024, 2, 29)))
    parts = reader.partitions()
    assert len(parts) == 3 and {p.day for p in parts} == {date(2024, 2, 29)} and len(reader_of(folder).partitions()) == 36
    assert {(p.south, p.north) for p in parts} == {(10, 20), (20, 30), (30, 40)}
    seen = [b for p in parts for b in reader.read(p)]
    values = np.load(folder / "20240229.npy")[(LAT >= 15) & (LAT < 35)][:, (LON >= 105) & (LON <= 135)]
    assert sum(b.num_rows for b in seen) == (~np.isnan(values)).sum() < every / 50
    assert {b.num_columns for b in seen} == {5} and all(0 <= q < 4 for b in seen for q in b.column(4).to_pylist())
    assert reader_of(folder, days=(date(2020, 1, 1), date(2023, 12, 31))).partitions() == []


def test_bytes_outside_the_box_stay_on_disk(folder):
    taken = []

    class Counted:
        def __init__(self, file):
            self.file = file

        def read(self, n):
            taken.append(n)
            return self.file.read(n)

        def seek(self, at):
            return self.file.seek(at)

    path = next((folder / "2024").glob("*.nc"))
    with path.open("rb") as file:
        counted = Counted(file)
        variables = rasters.read_header(counted)
        assert sum(taken) <= 8192 < path.stat().st_size and variables["chlor_a"].shape == (180, 120)
        taken.clear()
        assert len(rasters._read(counted, variables["chlor_a"], 120 * 60 + 90, 10)) == 10 and taken == [40]


def test_plans_do_not_share_a_box(spark, folder):
    df = rasters.read_rasters(spark, f"file://{folder}", "chlor_a")
    every = df.count()
    near = rasters.read_rasters(spark, f"file://{folder}", "chlor_a", lat=(15, 35), lon=(106, 180), days=(date(2024, 2, 29), date(2024, 2, 29)))
    plain = df.where("lat between 15 and 35 and lon between 106 and 180 and date = date'2024-02-29'")
    assert near.rdd.getNumPartitions() == 3 and sorted(map(tuple, near.collect())) == sorted(map(tuple, plain.collect()))
    assert 0 < near.count() < every == df.count()


def test_packed_values_and_poles(spark, tmp_path):
    """Scaled shorts with a fill value; both poles and a null-quality raster; a band that has no row."""
    raw = rasters.netcdf_bytes([90.0, 0.0, -90.0], [0.0, 1.0], "sst", np.array([[100, -32767], [7, 8], [-5, 0]], np.int16), scale_factor=0.5, add_offset=10.0)
    (tmp_path / "x_2024-03-01.nc").write_bytes(raw)
    got = sorted((r.lat, r.lon, r.value, r.quality_level) for r in rasters.read_rasters(spark, str(tmp_path), "sst").collect())
    assert got == [(-90.0, 0.0, 7.5, None), (-90.0, 1.0, 10.0, None), (0.0, 0.0, 13.5, None), (0.0, 1.0, 14.0, None), (90.0, 0.0, 60.0, None)]
    assert rasters.name_date("a.20240230.20240301b_1.nc") == date(2024, 3, 1) and rasters.name_date("none.nc") is None
    with pytest.raises(ValueError, match="classic"):
        rasters.read_header(fs.LocalFileSystem().open_input_file(__file__))
    assert math.isnan(rasters._values(np.array([np.inf], ">f4"), rasters.Variable((1,), np.dtype(">f4"), 0, {}))[0])


def test_many_small_files_share_tasks(spark, tmp_path):
    """900 files of two bands, some with quality: every row once, a file of two bands opened once, tasks bounded by bytes."""
    rng, want = np.random.default_rng(5), set()
    for k in range(900):
        values, day = rng.random((4, 3)), date(2024, 1, 1 + k % 30)
        values[rng.random(values.shape) < 0.2] = np.nan
        quality = rng.integers(0, 4, values.shape) if k % 2 else None
        (tmp_path / f"r{k}.{day:%Y%m%d}.nc").write_bytes(rasters.netcdf_bytes([19.0, 15.0, 9.0, 5.0], [k, k + 0.25, k + 0.5], "v", values, quality))
        want |= {(day, lat, k + j / 4, values[i, j], int(quality[i, j]) if k % 2 else None) for i, lat in enumerate((19.0, 15.0, 9.0, 5.0)) for j in range(3) if not np.isnan(values[i, j]) and lat > 5}
    box = {"lat": (6.0, 20.0), "days": (date(2024, 1, 1), date(2024, 1, 30))}
    found = rasters.read_rasters(spark, str(tmp_path), "v", **box)
    assert found.rdd.getNumPartitions() <= 130
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(want) and set(rows) == want
    parts = rasters.RasterReader(str(tmp_path), "v", 10, **box).partitions()
    held = [b for p in parts for b in p.bands]
    assert len(held) < 1100 and {(b.south, b.north) for b in held} <= {(0, 20), (0, 10), (10, 20)}


def test_large_bands_stay_apart():
    bands = [rasters.Band(f"{k // 2}.nc", date(2024, 1, 1), 10 - k % 2 * 10, 20 - k % 2 * 10) for k in range(300)]
    assert [p.bands for p in rasters.packed(bands, [rasters._TASK_BYTES + 1] * 300)] == [[b] for b in bands]
    some = rasters.packed(bands, [rasters._TASK_BYTES / 8] * 300)
    assert 128 <= len(some) and max(len(p.bands) for p in some) <= 8


HEADER = "date,cell_ll_lat,cell_ll_lon,flag,geartype,hours,fishing_hours,mmsi_present\n"


def put(path, *hours):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(HEADER + "".join(f"2023-05-01,1.0,2.0,X,g,{h},1.5,2\n" for h in hours))


def test_each_file_is_read_once(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "seen"))
    run = lambda **how: ingest.ingest_available(spark, source, target, progress, **how)
    for n in range(5):
        put(tmp_path / "in" / "2023" / f"d{n}.csv", n, n)
    put(tmp_path / "in" / "2023" / "empty.csv")
    (tmp_path / "in" / "2023" / "other.txt").write_text("x")
    first = run(files_per_batch=2)
    assert first.rows == 10 and first.batches >= 3
    assert run() == ingest.Ingested(0, 0)  # a second run reads nothing
    stored = lambda: sorted((r.year, r.source, r.hours) for r in spark.read.parquet(target).collect())
    was = stored()
    put(tmp_path / "in" / "2024" / "d0.csv", 7)
    assert run().rows == 1 and stored() == sorted([*was, (2024, "d0.csv", 7.0)])
    again = ingest.with_source(spark.read.schema(ingest.EFFORT_SCHEMA).csv(f"{source}/2023/d1.csv", header=True))
    ingest.write_batch(again, target)  # a replayed batch changes nothing
    assert stored() == sorted([*was, (2024, "d0.csv", 7.0)])
    put(tmp_path / "in" / "corrected" / "2023" / "d1.csv", 50)  # delivered anew: its rows are replaced
    assert run().rows == 1
    assert stored() == sorted([*[r for r in was if r[1] != "d1.csv"], (2023, "d1.csv", 50.0), (2024, "d0.csv", 7.0)])


def test_failed_batch_is_replayed(spark, tmp_path, monkeypatch):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "seen"))
    put(tmp_path / "in" / "2023" / "a.csv", 1)
    real = ingest.write_batch

    def dies(rows, out):
        real(rows, out)
        raise RuntimeError("killed after the write, before the batch is committed")

    monkeypatch.setattr(ingest, "write_batch", dies)
    with pytest.raises(Exception, match="killed"):
        ingest.ingest_available(spark, source, target, progress)
    monkeypatch.setattr(ingest, "write_batch", real)
    assert ingest.ingest_available(spark, source, target, progress).rows == 1
    assert spark.read.parquet(target).count() == 1
