"""Status log, reconciliation, file statistics, and the file and cruise stages end to end."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomgrid import schemas, session
from fathomgrid.operators import cube, filestats, grid, status
from fathomgrid.plans import cruise_job, file_job
from fathomgrid.sources import geojson, tables
from tests.test_arrays import model

T0 = dt.datetime(2007, 7, 11, 18, 0, 0)


def log(spark, rows):
    return spark.createDataFrame(
        [(f, c, s, T0 + dt.timedelta(seconds=t), q, n) for f, c, s, t, q, n in rows],
        "file_name string, cruise_name string, pipeline_status string, pipeline_time timestamp, event_seq long, n long",
    )


def test_latest_row_replaces_the_whole_row(spark):
    rows = log(spark, [("f", "c", "SUCCESS", 1, 1, 9), ("f", "c", "PROCESSING", 1, 2, None), ("f", "d", "SUCCESS", 0, 3, 4)])
    got = {(r["file_name"], r["cruise_name"]): (r["pipeline_status"], r["n"]) for r in status.latest_status(rows).collect()}
    assert got == {("f", "c"): ("PROCESSING", None), ("f", "d"): ("SUCCESS", 4)}


def test_unknown_files_read_as_none(spark):
    asked = spark.createDataFrame([("f", "c"), ("g", "c")], "file_name string, cruise_name string")
    rows = log(spark, [("f", "c", "FAILURE", 1, 1, 9)])
    assert {r["file_name"]: r["pipeline_status"] for r in status.status_of(asked, rows).collect()} == {"f": "FAILURE", "g": "NONE"}
    assert status.pending_files(asked, rows).count() == 2
    done = log(spark, [("f", "c", "SUCCESS", 1, 1, 9)])
    assert [r["file_name"] for r in status.pending_files(asked, done).collect()] == ["g"]
    assert status.pending_files(asked, done, overwrite=True).count() == 2


def test_no_eligible_files_is_reported(spark):
    rows = log(spark, [("f", "c", "FAILURE", 1, 1, 9), ("g", "d", "SUCCESS", 1, 1, 9)])
    assert [(r["cruise_name"], r["files"]) for r in status.cruises_without_files(rows).collect()] == [("c", 1)]


def test_status_sink_keeps_history(spark, tmp_path):
    path = str(tmp_path / "log")
    files = spark.createDataFrame([("f", "c")], "file_name string, cruise_name string")
    tables.append_status(tables.status_rows(files, status.PROCESSING, 1), path)
    tables.append_status(tables.status_rows(files, status.SUCCESS, 2), path)
    stored = tables.read_status(spark, path)
    assert stored.schema == schemas.FILE_STATUS and stored.count() == 2
    assert status.latest_status(stored).first()["pipeline_status"] == "SUCCESS"


def test_reconciliation(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "store string")
    b = spark.createDataFrame([("x",), ("y",), ("z",)], "store string")
    got = {r["store"]: (r["expected"], r["actual"]) for r in status.reconcile(a, b, ["store"]).collect()}
    assert got == {"x": (2, 1), "z": (0, 1)}


def files(spark, rows):
    return spark.createDataFrame(
        rows,
        "cruise string, file_name string, start_time string, num_ping_time_dropna long, min_echo_range double, "
        "max_echo_range double, frequencies array<long>, channels array<string>",
    )


def test_slices_and_dimensions(spark):
    table = files(
        spark,
        [
            ("c", "b", "2007-01-01", 4, 0.2, 100.0, [38000, 18000], ["y", "x"]),
            ("c", "a", "2007-01-01", 3, 0.3, 90.0, [18000, 38000], ["x"]),
            ("c", "z", "2007-01-02", 0, 0.0, 120.0, [1], ["z"]),
            ("c", "y", "2007-01-03", 2, 0.25, 80.0, [2], ["x"]),
        ],
    )
    slices = {r["file_name"]: (r["start_idx"], r["end_idx"]) for r in grid.file_slices(table).collect()}
    assert slices == {"a": (0, 3), "b": (3, 7), "z": (7, 7), "y": (7, 9)}
    row = grid.cruise_grid(table).first()
    assert (row["width"], row["step"], row["max_depth"]) == (9, 0.2, 120.0)
    assert row["depth_bins"] == int(np.float32(120.0) / np.float32(0.2)) + 1
    assert row["channels"] == ["x", "y", "z"] and row["frequencies"] == [18000.0, 38000.0]
    axis = [r["depth"] for r in grid.depth_axis(grid.cruise_dimensions(table)).orderBy("depth_idx").collect()]
    assert axis == np.linspace(0, float(np.float32(120.0)), row["depth_bins"]).tolist()


def soundings(spark, per_file):
    rows = []
    for name, (start, n, step, depth) in per_file.items():
        for ping in range(n):
            for frequency in (18000.0, 38000.0):
                ranges = [i * step for i in range(depth)]
                sv = [None if (i + ping) % 5 == 0 else -60.0 - i * 0.5 - ping for i in range(depth)]
                rows.append(("HB", name, f"GPT {frequency}", frequency, ping, T0 + dt.timedelta(seconds=start + ping), ranges, sv))
    return spark.createDataFrame(rows, schemas.SOUNDINGS)


@pytest.fixture(scope="module")
def survey(spark):
    """Two sound files and one whose positions are out of bounds."""
    sound = soundings(spark, {"A.raw": (0, 6, 0.25, 20), "B.raw": (100, 5, 0.5, 12), "bad.raw": (200, 3, 0.5, 4)})
    pings = sound.select("cruise", "file_name", "ping_idx", "ping_time").distinct()
    nmea = spark.createDataFrame(
        [("HB", f, i, T0 + dt.timedelta(seconds=s), lat, -70.0 - i) for i, (f, s, lat) in enumerate(
            [("A.raw", 2, 40.0), ("A.raw", 4, 41.0), ("B.raw", 99, 42.0), ("bad.raw", 200, 95.0)])],
        schemas.NMEA,
    )
    return nmea, pings, sound


def test_file_and_cruise_stage(spark, survey, tmp_path):
    nmea, pings, sound = survey
    log_path, geo_path, cube_path = (str(tmp_path / n) for n in ("log", "geo", "cube"))
    file_job.run(nmea, pings, sound, "Bigelow", "EK60", geo_path, log_path)
    stored = tables.read_status(spark, log_path)
    rows = {r["file_name"]: r for r in stored.collect()}
    assert {k: r["pipeline_status"] for k, r in rows.items()} == {"A.raw": "SUCCESS", "B.raw": "SUCCESS", "bad.raw": "FAILURE"}
    a = rows["A.raw"]
    assert (float(a["min_echo_range"]), float(a["max_echo_range"]), a["num_ping_time_dropna"]) == (0.25, 4.75, 4)
    assert (a["start_time"], a["end_time"]) == ("2007-07-11T18:00:00.000Z", "2007-07-11T18:00:05.000Z")
    assert a["zarr_path"] == "level_1/Bigelow/HB/EK60/A.zarr" and a["frequencies"] == [18000.0, 38000.0]
    broken = file_job.violations(nmea, pings).collect()
    assert [(r["file_name"], r["reasons"]) for r in broken] == [("bad.raw", ["positions out of bounds"])]
    assert geojson.read_features(spark, geo_path).count() == 11

    stage = file_job.file_stage(nmea, pings, sound)
    aligned = stage.aligned
    mismatches = cruise_job.run(stored, aligned, sound, cube_path, stage.layout)
    assert mismatches.count() == 0
    back = tables.read_cube(spark, cube_path).collect()
    assert len(back) == 2 * (4 + 5)
    bins = int(np.float32(5.5) / np.float32(0.25)) + 1
    source = {(r["file_name"], r["ping_idx"], r["frequency"]): r for r in sound.collect()}
    for r in back:
        first, start = {"A.raw": (2, 0), "B.raw": (0, 4)}[r["file_name"]]
        s = source[(r["file_name"], first + r["time_idx"] - start, r["frequency"])]
        want = model(s["echo_range"], s["sv"], 5.5, bins)
        assert r["sv"] == want
        assert r["ts"] == (s["ping_time"] - dt.datetime(1970, 1, 1)).total_seconds()

    # A file that is no longer eligible loses its slices.
    fewer = stored.filter("file_name <> 'A.raw'")
    cruise_job.run(fewer, aligned, sound, cube_path)
    assert {r["file_name"] for r in tables.read_cube(spark, cube_path).collect()} == {"B.raw"}
    cruise_job.run(stored, aligned, sound, cube_path)

    # Writing one file again leaves the other slices alone.
    stage = cruise_job.cruise_stage(stored, aligned, sound)
    tables.write_cube(stage.cube.filter("file_name = 'B.raw'"), cube_path)
    assert tables.read_cube(spark, cube_path).count() == 18
    one = cube.read_slice(tables.read_cube(spark, cube_path), "HB", 4, 6)
    assert sorted({r["time_idx"] for r in one.collect()}) == [4, 5]
    assert cube.read_slice(tables.read_cube(spark, cube_path), "HB", 4, 4).count() == 0


def test_regrid_leaves_the_samples_in_place(spark, survey):
    """The plan of the regrid has no exchange; only the grid is shipped."""
    _, _, sound = survey
    table = session.stored(grid.cruise_dimensions(files(spark, [("HB", "A", "t", 4, 0.25, 4.75, [1], ["x"])])), "grid")
    plan = cube.regrid(sound, table)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_bucketed_soundings_are_not_shuffled(spark, survey):
    _, pings, sound = survey
    tables.save_soundings_bucketed(sound, "bucketed_soundings", 4)
    stored = spark.table("bucketed_soundings")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = pings.withColumns({"time_idx": F.col("ping_idx"), "epoch_seconds": F.lit(0.0), "latitude": F.lit(1.0), "longitude": F.lit(1.0)})
        table = session.stored(grid.cruise_dimensions(files(spark, [("HB", "A", "t", 4, 0.25, 4.75, [1], ["x"])])), "grid")
        plan = cube.cube_rows(stored, placed, table)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("Initial Plan")[0].splitlines()
    scan_at = next(i for i, l in enumerate(lines) if "bucketed_soundings" in l)
    join_at = max(i for i, l in enumerate(lines[:scan_at]) if "Join" in l)
    assert not any("Exchange" in l for l in lines[join_at:scan_at]), plan
    want = cube.cube_rows(sound, placed, table).drop("sv").collect()
    got = cube.cube_rows(stored, placed, table).drop("sv").collect()
    assert sorted(got) == sorted(want) and len(got) == sound.count()


def test_zero_step_files_are_reported(spark):
    sound = soundings(spark, {"A.raw": (0, 2, 0.25, 20), "Z.raw": (0, 2, 0.0, 4)})
    stats = filestats.file_statistics(sound)
    assert [r["file_name"] for r in filestats.zero_step_files(stats).collect()] == ["Z.raw"]


def test_missing_pings(spark):
    rows = [("c", "f", "x", 1.0, 0, T0, [0.0, 1.0], [None, float("nan")]), ("c", "f", "y", 2.0, 0, T0, [0.0, 1.0], [None, None]),
            ("c", "f", "x", 1.0, 1, T0, [0.0, 1.0], [-3.0, float("nan")]), ("c", "f", "y", 2.0, 1, T0, [0.0, 1.0], [None, -2.0])]
    sound = spark.createDataFrame(rows, schemas.SOUNDINGS)
    got = {r["ping_idx"]: (r["max_sv"], r["all_missing"]) for r in filestats.loudest_per_ping(sound).collect()}
    assert got == {0: (None, True), 1: (-2.0, False)}
    shape = filestats.cube_shape(sound).first()
    assert (shape["channels"], shape["pings"], shape["samples"]) == (2, 2, 2)
    assert filestats.mean_sv(sound).first()["mean_sv"] == -2.5


def test_snapshot_and_tail_are_the_whole_log(spark, tmp_path):
    from fathomgrid.sources import tables

    log, snapshot = str(tmp_path / "log"), str(tmp_path / "snapshot")
    put = lambda *rows: tables.append_status(
        spark.createDataFrame(rows, "file_name string, cruise_name string, pipeline_status string, event_seq long")
        .withColumn("pipeline_time", F.timestamp_seconds(F.col("event_seq"))),
        log,
    )
    plain = lambda: sorted(map(tuple, status.latest_status(tables.read_status(spark, log)).select("file_name", "event_seq").collect()))
    short = lambda: sorted(map(tuple, tables.read_latest_status(spark, log, snapshot).select("file_name", "event_seq").collect()))
    put(("a", "A", "PROCESSING", 1), ("b", "A", "PROCESSING", 5))
    assert short() == plain() == [("a", 1), ("b", 5)]
    assert tables.compact_status(spark, log, snapshot) == 1
    assert short() == plain()
    # A late row that is older than the snapshot's does not win.
    put(("a", "A", "SUCCESS", 7), ("b", "A", "FAILURE", 4), ("c", "B", "PROCESSING", 2))
    assert short() == plain() == [("a", 7), ("b", 5), ("c", 2)]
    assert len(tables._status_parts(spark, log, snapshot)[1]) < len(tables.read_status(spark, log).inputFiles())
    assert tables.compact_status(spark, log, snapshot) == 2
    assert tables.compact_status(spark, log, snapshot) == 2
    # A snapshot that was not finished does not count.
    (tmp_path / "snapshot" / "000000003" / "rows").mkdir(parents=True)
    put(("c", "B", "SUCCESS", 9))
    assert short() == plain() == [("a", 7), ("b", 5), ("c", 9)]
