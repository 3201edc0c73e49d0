"""What Spark makes of the queries: no all-pairs joins, pruned scans, pushed filters, bounded shuffles."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401 - registers the queries
from fathomgrid.operators import catalog, cube, gps, status
from fathomgrid.operators.ordered import Layout
from fathomgrid.sources import tables
from workload.registry import QUERIES
from workload.views import table, view

SF = "/root/testdata/sf0.001"
# Real streams and sinks run when they are built; their results are compared elsewhere.
BUILT_BY_RUNNING = {
    "completion_stream", "aggregator_stream", "failure_stream", "repeat_removal", "status_stream", "geojson_roundtrip", "cube_sink",
    "index_sink", "archive_listing", "collection_roundtrip", "cube_slice", "message_completion", "fan_out_stream",
    "log_failure_stream", "log_failure_completion", "cube_chunk", "cube_axes", "tile_publish", "status_snapshot", "folder_listing",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in BUILT_BY_RUNNING])
def test_no_all_pairs(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def shuffles(df):
    return plan_of(df).split("Initial Plan")[-1].count("Exchange hashpartitioning")


def test_scans_are_pruned(spark):
    plan = plan_of(gps.bounds_violations(view(spark, SF, "v_fix")))
    assert "In(event_type, [error,signup,view])" in plan
    assert "props" not in plan.split("ReadSchema")[-1]
    plan = plan_of(QUERIES["zero_step_files"](spark, SF))
    assert "embedding:" not in plan.split("ReadSchema")[-1]


def test_one_shuffle_per_grouping(spark):
    assert shuffles(status.latest_status(view(spark, SF, "v_status"))) == 1
    files = catalog.raw_files(view(spark, SF, "v_keys"))
    assert shuffles(catalog.representatives(files)) == 1
    layout = Layout(10, 1)
    aligned = gps.align_fixes(view(spark, SF, "v_ping"), view(spark, SF, "v_fix"), layout=layout)
    # Positions and counts keep the partitioning by file that the alignment made.
    assert shuffles(gps.positions_in_file(gps.valid_pings(aligned), layout=layout)) == 1
    assert shuffles(gps.valid_counts(aligned)) == 1


def test_aggregates_combine_before_the_shuffle(spark):
    plan = plan_of(QUERIES["cruise_index"](spark, SF))
    assert "partial_count" in plan and "partial_sum" in plan
    plan = plan_of(status.latest_status(view(spark, SF, "v_status")))
    assert "partial_max_by" in plan


def test_regrid_does_not_shuffle(spark):
    df = QUERIES["regrid_nearest"](spark, SF)
    plan = plan_of(df)
    assert plan.split("Initial Plan")[-1].count("ArrowEvalPython") == 1
    # The one exchange gathers the grid per cruise; samples stay where they are.
    assert shuffles(df) == 1 and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("name", ["regrid_nearest", "cruise_cube", "cube_tiles", "cube_sink"])
def test_the_kernel_runs_once(spark, name):
    if name == "cube_sink":
        from workload.grid_queries import _cube

        df = _cube(spark, SF)
    else:
        df = QUERIES[name](spark, SF)
    assert plan_of(df).split("Initial Plan")[-1].count("ArrowEvalPython") == 1


def test_tables_are_read_in_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        table(spark, SF, "events")
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_cube_reads_are_pruned(spark, tmp_path):
    rows = spark.range(200).selectExpr(
        "if(id % 2 = 0, 'A', 'B') AS cruise", "concat('F', cast(id % 4 as string)) AS file_name", "id AS time_idx",
        "cast(38000 as float) AS frequency", "0D AS ts", "0F AS latitude", "0F AS longitude",
        "array(cast(id as float)) AS sv", "floor(id / 10) AS time_tile",
    )
    path = str(tmp_path / "cube")
    tables.write_cube(rows, path)
    part = cube.read_slice(tables.read_cube(spark, path), "A", 20, 40, tile=10).select("time_idx", "latitude")
    plan = plan_of(part)
    assert "PartitionFilters: [isnotnull(cruise" in plan
    assert "GreaterThanOrEqual(time_tile,2)" in plan
    assert "sv:" not in plan.split("ReadSchema")[-1]
    assert sorted(r["time_idx"] for r in part.collect()) == list(range(20, 40, 2))


def above(plan, mark):
    """Operators between the line with `mark` and the root of a printed plan."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if mark in line)
    depth = lambda line: len(line) - len(line.lstrip(" +-:"))
    found, limit = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < limit:
            found.append(line.strip(" +-:"))
            limit = depth(line)
    return found


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_bucketed_soundings_do_not_move(spark, broadcast):
    """Between the stored samples and the cube there is no exchange, however the positions arrive."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        plan = plan_of(QUERIES["bucketed_cube"](spark, SF)).split("Initial Plan")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    operators = above(plan, "FileScan parquet spark_catalog.default.soundings_")
    assert operators and not [o for o in operators if o.startswith("Exchange")]


def test_a_chunk_is_read_alone_and_written_alone(spark, tmp_path):
    import glob
    import os

    path = str(tmp_path / "sv")
    rows = spark.range(240).selectExpr(
        "'A' AS cruise", "concat('F', cast(id div 100 as string)) AS file_name", "id AS time_idx", "cast(38000 as float) AS frequency",
        "transform(sequence(0, 69), i -> cast(id * 100 + i as float)) AS sv",
    )
    write = lambda df: tables.write_chunks(df, path, 32, 32)
    write(rows)
    assert len(glob.glob(f"{path}/cruise=A/time_tile=*/depth_tile=*")) == 8 * 3
    chunk = tables.read_chunk(spark, path, "A", 3, 2, 38000.0)
    plan = plan_of(chunk)
    assert all(f"{c}#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0] for c in ("cruise", "time_tile", "depth_tile"))
    assert "EqualTo(frequency" in plan
    assert all("time_tile=3/depth_tile=2" in f for f in chunk.inputFiles()) or len(chunk.collect()) == 32
    got = {r["time_idx"]: list(r["sv"]) for r in chunk.collect()}
    # The last depth tile is as deep as the column; the time tile has the ends of two files.
    assert got == {t: [float(t * 100 + i) for i in range(64, 70)] for t in range(96, 128)}
    stamp = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/part-*", recursive=True) if "file_name=F1" not in f}
    before = stamp()
    # The slice shrinks and becomes shallower: its own folders change, and those it left are gone.
    write(rows.filter("file_name = 'F1' and time_idx < 150").withColumn("sv", F.slice("sv", 1, 40)))
    assert stamp() == before
    own = tables.read_chunks(spark, path).filter("file_name = 'F1'")
    assert {(r["time_tile"], r["depth_tile"]) for r in own.select("time_tile", "depth_tile").distinct().collect()} == {(3, 0), (3, 1), (4, 0), (4, 1)}
    assert own.count() == 100


def test_chunks_are_replaced_without_opening_others(spark, tmp_path, monkeypatch):
    """Which folders a slice has left is told by their names, and rows of a chunk are in groups of a frequency."""
    import glob

    import pyarrow.parquet as pq

    path = str(tmp_path / "sv")
    monkeypatch.setattr(tables, "_CHUNK_BYTES", 32 * 32 * 4)
    rows = spark.range(256).selectExpr(
        "'A' AS cruise", "concat('F', cast(id div 128 as string)) AS file_name", "id AS time_idx",
        "explode(array(cast(1 as float), cast(2 as float))) AS frequency", "transform(sequence(0, 31), i -> cast(i as float)) AS sv",
    )
    tables.write_chunks(rows, path, 32, 32)
    (kept,) = glob.glob(f"{path}/cruise=A/time_tile=1/depth_tile=0/file_name=F0/part-*")
    groups = pq.ParquetFile(kept).metadata
    assert groups.num_rows == 64 and groups.num_row_groups >= 2
    assert pq.read_table(kept, partitioning=None).column("frequency").to_pylist() == [1.0] * 32 + [2.0] * 32
    good = open(kept, "rb").read()
    with open(kept, "wb") as f:
        f.write(b"no parquet file")
    tables.write_chunks(rows.filter("file_name = 'F1' and time_idx < 160"), path, 32, 32)
    with open(kept, "wb") as f:
        f.write(good)
    stored = tables.read_chunks(spark, path)
    assert stored.filter("file_name = 'F1'").count() == 64 and stored.filter("file_name = 'F0'").count() == 256
    assert len(glob.glob(f"{path}/cruise=A/time_tile=*/depth_tile=0/file_name=F1")) == 1
