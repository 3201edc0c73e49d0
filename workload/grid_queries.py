"""Cruise grid, slices and the regridded cube."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fathomgrid.functions import arrays
from fathomgrid.operators import cube, filestats, gps, grid, status
from fathomgrid.plans import file_job
from fathomgrid.session import scratch_path
from fathomgrid.sources import tables
from workload.registry import query, sql_view
from workload.views import sounding_pings, soundings, table, view

sql_view(
    "v_dimensions",
    """
SELECT *, cast(trunc(cast(cast(cast(max_depth AS float) AS double) / cast(cast(step AS float) AS double) AS float)) AS bigint) + 1
    AS depth_bins, cast(trunc(ceil(max_depth) / step) AS bigint) AS stored_height
FROM (SELECT cruise, cast(sum(num_ping_time_dropna) AS bigint) AS width,
    min(min_echo_range) FILTER (min_echo_range > 0) AS step, max(max_echo_range) AS max_depth
  FROM v_usable_info GROUP BY cruise)""",
)
sql_view(
    "v_slices",
    """
SELECT cruise, file_name, num_ping_time_dropna,
  cast(coalesce(sum(num_ping_time_dropna) OVER (PARTITION BY cruise ORDER BY start_time, file_name
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS start_idx
FROM v_usable_info""",
)


def _info(spark, d):
    return view(spark, d, "v_usable_info")


@query("cruise_dimensions", "SELECT * FROM v_dimensions")
def cruise_dimensions(spark, d):
    return grid.cruise_dimensions(_info(spark, d))


@query(
    "cruise_channels",
    "SELECT cruise, string_agg(DISTINCT channel, '|' ORDER BY channel) AS channels "
    "FROM (SELECT cruise, unnest(channels) AS channel FROM v_usable_info) GROUP BY cruise",
)
def cruise_channels(spark, d):
    return grid.cruise_channels(_info(spark, d)).withColumn("channels", F.array_join("channels", "|"))


@query(
    "cruise_frequencies",
    "SELECT cruise, cast(f[1] AS double) AS first, cast(f[2] AS double) AS second, cast(f[3] AS double) AS third "
    "FROM (SELECT cruise, arg_min(frequencies, start_time || file_name) AS f FROM v_usable_info GROUP BY cruise)",
)
def cruise_frequencies(spark, d):
    f = F.col("frequencies")
    return grid.cruise_frequencies(_info(spark, d)).select(
        "cruise", f[0].alias("first"), f[1].alias("second"), f[2].alias("third")
    )


@query(
    "files_in_start_order",
    "SELECT cruise, file_name, start_time FROM v_usable_info ORDER BY start_time, file_name",
)
def files_in_start_order(spark, d):
    return status.in_start_order(_info(spark, d)).select("cruise", "file_name", "start_time")


@query(
    "depth_axis",
    """
SELECT cruise, cast(j AS int) AS depth_idx, CASE WHEN j = 0 THEN 0e0 WHEN j = depth_bins - 1 THEN deep
  ELSE j * (deep / (depth_bins - 1)) END AS depth
FROM (SELECT cruise, depth_bins, cast(cast(max_depth AS float) AS double) AS deep,
  unnest(range(0, depth_bins)) AS j FROM v_dimensions)""",
)
def depth_axis(spark, d):
    return grid.depth_axis(grid.cruise_dimensions(_info(spark, d)))


@query(
    "stored_depth_axis",
    """
SELECT cruise, cast(j AS int) AS depth_idx,
  round_even((CASE WHEN j = 0 THEN 0e0 WHEN j = stored_height - 1 THEN step * stored_height
    ELSE j * (step * stored_height / (stored_height - 1)) END) * 1e2, 0) / 1e2 + 1e-2 AS depth
FROM (SELECT cruise, stored_height, step, unnest(range(0, stored_height)) AS j FROM v_dimensions)""",
)
def stored_depth_axis(spark, d):
    return grid.stored_depth_axis(grid.cruise_dimensions(_info(spark, d)))


@query(
    "file_slices",
    "SELECT cruise, file_name, start_idx, start_idx + num_ping_time_dropna AS end_idx FROM v_slices",
)
def file_slices(spark, d):
    return grid.file_slices(_info(spark, d)).select("cruise", "file_name", "start_idx", "end_idx")


@query(
    "whole_tiles",
    "SELECT cruise, cast(ceil(width / 1024e0) AS bigint) * 1024 AS width, "
    "cast(ceil(stored_height / 1024e0) AS bigint) * 1024 AS height FROM v_dimensions",
)
def whole_tiles(spark, d):
    return grid.cruise_dimensions(_info(spark, d)).select(
        "cruise", cube.whole_tiles(F.col("width")).alias("width"),
        cube.whole_tiles(F.col("stored_height")).alias("height"),
    )


# --- the sound files of the embeddings, from positions to the cube -------------------------------

sql_view(
    "v_placed_ping",
    """
SELECT cruise, file_name, ping_idx, ping_time, latitude, longitude,
  row_number() OVER (PARTITION BY cruise, file_name ORDER BY ping_idx) - 1 AS position
FROM (SELECT p.*, f.latitude, f.longitude FROM v_sounding_ping p ASOF LEFT JOIN (
    SELECT * FROM v_sounding_fix QUALIFY row_number() OVER (PARTITION BY cruise, file_name, ts ORDER BY seq DESC) = 1) f
  ON p.cruise = f.cruise AND p.file_name = f.file_name AND p.ping_time >= f.ts)
WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
)
sql_view(
    "v_sound_info",
    """
SELECT r.cruise, r.file_name, r.start_time, r.min_echo_range, r.max_echo_range, coalesce(n.n, 0) AS n
FROM v_recorded r LEFT JOIN (SELECT cruise, file_name, count(*) AS n FROM v_placed_ping GROUP BY ALL) n
  ON r.cruise = n.cruise AND r.file_name = n.file_name""",
)
sql_view(
    "v_sound_grid",
    """
SELECT *, cast(trunc(cast(cast(cast(max_depth AS float) AS double) / cast(cast(step AS float) AS double) AS float)) AS bigint) + 1
    AS depth_bins
FROM (SELECT cruise, cast(sum(n) AS bigint) AS width, min(min_echo_range) FILTER (min_echo_range > 0) AS step,
    max(max_echo_range) AS max_depth FROM v_sound_info GROUP BY cruise)""",
)
sql_view(
    "v_bin",
    """
SELECT cruise, j AS depth_idx, CASE WHEN j = 0 THEN 0e0 WHEN j = depth_bins - 1 THEN deep
  ELSE j * (deep / (depth_bins - 1)) END AS depth
FROM (SELECT cruise, depth_bins, cast(cast(max_depth AS float) AS double) AS deep,
  unnest(range(0, depth_bins)) AS j FROM v_sound_grid)""",
)
# Brute force: every bin against every sample of the ping; a repeated depth counts once, its first.
sql_view(
    "v_regridded",
    """
SELECT k.cruise, k.file_name, k.ping_idx, k.channel, k.frequency, b.depth_idx, n.sv
FROM (SELECT DISTINCT cruise, file_name, ping_idx, channel, frequency, vec_no FROM v_sample) k
JOIN v_bin b ON k.cruise = b.cruise
LEFT JOIN (
  SELECT s.vec_no, b.depth_idx, arg_min_null(s.sv, (abs(s.depth - b.depth), s.depth)) AS sv
  FROM (SELECT cruise, vec_no, depth, arg_min_null(sv, sample_idx) AS sv FROM v_sample GROUP BY ALL) s
  JOIN v_bin b ON s.cruise = b.cruise
  GROUP BY s.vec_no, b.depth_idx
  HAVING any_value(b.depth) BETWEEN min(s.depth) AND max(s.depth)
) n ON n.vec_no = k.vec_no AND n.depth_idx = b.depth_idx""",
)
sql_view(
    "v_cube_cell",
    """
SELECT r.cruise, r.file_name, r.channel, p.position + s.start_idx AS time_idx,
  cast(r.frequency AS double) AS frequency, epoch_us(p.ping_time) / 1e6 AS ts,
  cast(cast(p.latitude AS float) AS double) AS latitude, cast(cast(p.longitude AS float) AS double) AS longitude,
  r.depth_idx, cast(cast(r.sv AS float) AS double) AS sv
FROM v_regridded r
JOIN v_placed_ping p ON r.cruise = p.cruise AND r.file_name = p.file_name AND r.ping_idx = p.ping_idx
JOIN (SELECT cruise, file_name, cast(coalesce(sum(n) OVER (PARTITION BY cruise ORDER BY start_time, file_name
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS start_idx FROM v_sound_info) s
  ON r.cruise = s.cruise AND r.file_name = s.file_name""",
)


def _placed(spark, d):
    pings, fixes = sounding_pings(spark, d), view(spark, d, "v_sounding_fix")
    layout = gps.measure_series(pings, fixes)
    aligned = gps.align_fixes(pings, fixes, layout=layout)
    return gps.positions_in_file(gps.valid_pings(aligned), layout=layout)


def _sound_info(spark, d):
    """File information of the sound files, recorded in a table before the cruise stage reads it."""
    stats = filestats.recorded_ranges(filestats.file_statistics(soundings(spark, d)))
    counts = _placed(spark, d).groupBy("cruise", "file_name").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "file-info")
    stats.join(counts, ["cruise", "file_name"], "left").withColumn(
        "num_ping_time_dropna", F.coalesce("n", F.lit(0).cast("long"))
    ).drop("n").write.parquet(path)
    return spark.read.parquet(path)


def _on_axis(spark, d, info):
    return grid.on_time_axis(_placed(spark, d), grid.file_slices(info))


def _cube(spark, d):
    info = _sound_info(spark, d)
    return cube.cube_rows(soundings(spark, d), _on_axis(spark, d, info), grid.cruise_dimensions(info))


def _cells(rows):
    """Long form, one row per depth bin, in double precision for comparison."""
    columns = [c for c in ("cruise", "file_name", "time_idx") if c in rows.columns]
    return rows.select(
        *columns,
        F.col("frequency").cast("double").alias("frequency"),
        "ts",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.posexplode("sv").alias("i", "v"),
    ).select("*", F.col("i").cast("long").alias("depth_idx"), F.col("v").cast("double").alias("sv")).drop("i", "v")


@query(
    "regrid_nearest",
    "SELECT cruise, file_name, ping_idx, channel, depth_idx, cast(cast(sv AS float) AS double) AS sv FROM v_regridded",
)
def regrid_nearest(spark, d):
    rows = cube.regrid(soundings(spark, d), grid.cruise_dimensions(_sound_info(spark, d)))
    return rows.select(
        "cruise", "file_name", "ping_idx", "channel", F.posexplode("sv").alias("i", "v")
    ).select(
        "cruise", "file_name", "ping_idx", "channel",
        F.col("i").cast("long").alias("depth_idx"), F.col("v").cast("double").alias("sv"),
    )


@query(
    "time_axis",
    """
SELECT p.cruise, p.file_name, p.ping_idx, p.position + s.start_idx AS time_idx FROM v_placed_ping p
JOIN (SELECT cruise, file_name, cast(coalesce(sum(n) OVER (PARTITION BY cruise ORDER BY start_time, file_name
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS start_idx FROM v_sound_info) s
  ON p.cruise = s.cruise AND p.file_name = s.file_name""",
)
def time_axis(spark, d):
    placed = grid.on_time_axis(_placed(spark, d), grid.file_slices(_sound_info(spark, d)))
    return placed.select("cruise", "file_name", "ping_idx", "time_idx")


_CELL = "cruise, file_name, time_idx, frequency, ts, latitude, longitude, depth_idx, sv"


@query("cruise_cube", f"SELECT {_CELL} FROM v_cube_cell")
def cruise_cube(spark, d):
    return _cells(_cube(spark, d))


@query(
    "cube_tiles",
    "SELECT cruise, frequency, time_idx // 16 AS time_tile, depth_idx // 32 AS depth_tile, count(*) AS cells, "
    "count(sv) AS present FROM v_cube_cell GROUP BY ALL",
)
def cube_tiles(spark, d):
    """Cells per tile, with small tiles so that several occur."""
    pieces = cube.tiled(_cube(spark, d), tile=32).withColumn("time_tile", cube.time_tile(F.col("time_idx"), 16))
    present = F.size(F.filter("sv", lambda x: x.isNotNull()))
    return pieces.groupBy(
        "cruise", F.col("frequency").cast("double").alias("frequency"), "time_tile",
        F.col("depth_tile").cast("long").alias("depth_tile"),
    ).agg(F.sum(F.size("sv")).alias("cells"), F.sum(present).alias("present"))


@query("bucketed_cube", f"SELECT {_CELL} FROM v_cube_cell")
def bucketed_cube(spark, d):
    """The cube of soundings kept as a bucketed table: positions go to the samples, which stay where they are."""
    name = f"soundings_{uuid.uuid4().hex}"
    kept = tables.save_soundings_bucketed(soundings(spark, d), name, 8, scratch_path(spark, name))
    info = _sound_info(spark, d)
    return _cells(cube.cube_rows(kept, _on_axis(spark, d, info), grid.cruise_dimensions(info)))


@query(
    "cube_chunk",
    """
SELECT c.cruise, c.file_name, c.frequency, c.time_idx, c.depth_idx, t.ts, t.latitude, t.longitude, b.depth, c.sv
FROM v_cube_cell c
JOIN (SELECT DISTINCT cruise, time_idx, ts, latitude, longitude FROM v_cube_cell) t ON c.cruise = t.cruise AND c.time_idx = t.time_idx
JOIN v_bin b ON c.cruise = b.cruise AND c.depth_idx = b.depth_idx
WHERE c.cruise = 'C1' AND c.time_idx // 16 = 1 AND c.depth_idx // 32 = 2""",
)
def cube_chunk(spark, d):
    """One depth tile of one time tile of the stored chunks, after one file's slice was written again, with its axes."""
    path = scratch_path(spark, "chunks")
    info = _sound_info(spark, d)
    on_axis, dims = _on_axis(spark, d, info), grid.cruise_dimensions(info)
    rows = cube.cube_rows(soundings(spark, d), on_axis, dims)
    tables.write_chunks(rows, f"{path}/sv", 16, 32)
    tables.write_chunks(rows.filter("file_name = 'F5'"), f"{path}/sv", 16, 32)
    tables.write_axes(on_axis, grid.depth_axis(dims), path)
    chunk = tables.read_chunk(spark, f"{path}/sv", "C1", 1, 2)
    cells = chunk.select(
        "cruise", "file_name", F.col("frequency").cast("double").alias("frequency"), "time_idx", F.posexplode("sv").alias("i", "v")
    ).select("*", (F.col("i") + 2 * 32).cast("long").alias("depth_idx"), F.col("v").cast("double").alias("sv"))
    times = tables.read_axis(spark, path, "time").filter("cruise = 'C1'").select(
        "time_idx", "ts", *[F.col(c).cast("double").alias(c) for c in ("latitude", "longitude")]
    )
    depths = tables.read_axis(spark, path, "depth").filter("cruise = 'C1'").select(
        F.col("depth_idx").cast("long").alias("depth_idx"), "depth"
    )
    return cells.drop("i", "v").join(times, "time_idx").join(depths, "depth_idx")


@query(
    "cube_axes",
    """
SELECT cruise, 'time' AS axis, time_idx AS place, ts AS value FROM (
  SELECT p.cruise, p.position + s.start_idx AS time_idx, epoch_us(p.ping_time) / 1e6 AS ts FROM v_placed_ping p
  JOIN (SELECT cruise, file_name, cast(coalesce(sum(n) OVER (PARTITION BY cruise ORDER BY start_time, file_name
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS start_idx FROM v_sound_info) s
    ON p.cruise = s.cruise AND p.file_name = s.file_name)
UNION ALL SELECT cruise, 'depth', depth_idx, depth FROM v_bin""",
)
def cube_axes(spark, d):
    """The stored axes: each time and each depth of a cruise once."""
    path = scratch_path(spark, "axes")
    info = _sound_info(spark, d)
    tables.write_axes(_on_axis(spark, d, info), grid.depth_axis(grid.cruise_dimensions(info)), path)
    times = tables.read_axis(spark, path, "time").select(
        "cruise", F.lit("time").alias("axis"), F.col("time_idx").alias("place"), F.col("ts").alias("value")
    )
    return times.unionByName(
        tables.read_axis(spark, path, "depth").select(
            "cruise", F.lit("depth").alias("axis"), F.col("depth_idx").cast("long").alias("place"), F.col("depth").alias("value")
        )
    )


sql_view(
    "v_sound_frequency",
    """
SELECT DISTINCT s.cruise, cast(s.frequency AS double) AS frequency FROM v_sounding s
JOIN (SELECT cruise, arg_min(file_name, start_time || file_name) AS file_name FROM v_sound_info GROUP BY cruise) f
  ON s.cruise = f.cruise AND s.file_name = f.file_name""",
)


@query(
    "dense_cube",
    """
SELECT g.cruise, g.frequency, g.time_idx, g.depth_idx, c.ts, c.sv
FROM (SELECT t.cruise, f.frequency, t.time_idx, b.depth_idx
  FROM (SELECT cruise, unnest(range(0, width)) AS time_idx FROM v_sound_grid) t
  JOIN v_sound_frequency f ON t.cruise = f.cruise JOIN v_bin b ON t.cruise = b.cruise) g
LEFT JOIN v_cube_cell c
  ON g.cruise = c.cruise AND g.frequency = c.frequency AND g.time_idx = c.time_idx AND g.depth_idx = c.depth_idx
UNION ALL
SELECT c.cruise, c.frequency, c.time_idx, c.depth_idx, c.ts, c.sv FROM v_cube_cell c
WHERE (c.cruise, c.frequency) NOT IN (SELECT (cruise, frequency) FROM v_sound_frequency)""",
)
def dense_cube(spark, d):
    info = _sound_info(spark, d)
    rows = cube.densify(_cube(spark, d), grid.cruise_grid(info), tile=16)
    return _cells(rows).select("cruise", "frequency", "time_idx", "depth_idx", "ts", "sv")


@query(
    "cube_slice",
    f"SELECT {_CELL} FROM v_cube_cell WHERE cruise = 'C1' AND time_idx >= 5 AND time_idx < 23",
)
def cube_slice(spark, d):
    """A slice of the stored cube: other cruises' folders and other time tiles are skipped."""
    path = scratch_path(spark, "cube")
    tables.write_cube(_cube(spark, d), path)
    return _cells(cube.read_slice(tables.read_cube(spark, path), "C1", 5, 23))


@query(
    "depth_major_cube",
    "SELECT cruise, depth_idx, count(*) AS cells, round(coalesce(sum(sv * (time_idx + 1)), 0), 6) AS weighted FROM v_cube_cell GROUP BY ALL",
)
def depth_major_cube(spark, d):
    slabs = cube.depth_major(_cube(spark, d))
    each = F.zip_with("values", "time_idx", lambda v, t: F.coalesce(v.cast("double") * (t + 1), F.lit(0.0)))
    weighted = F.aggregate(each, F.lit(0.0), lambda acc, x: acc + x)
    return slabs.groupBy("cruise", F.col("depth_idx").cast("long").alias("depth_idx")).agg(
        F.sum(F.size("values")).alias("cells"), F.round(F.sum(weighted), 6).alias("weighted")
    )


@query("cube_sink", f"SELECT {_CELL} FROM v_cube_cell")
def cube_sink(spark, d):
    """Write all slices, rewrite the slices of one file, and read the cube back."""
    path = scratch_path(spark, "cube")
    rows = _cube(spark, d)
    tables.write_cube(rows, path)
    tables.write_cube(rows.filter("file_name = 'F1'"), path)
    return _cells(tables.read_cube(spark, path))


@query(
    "sounding_file",
    "SELECT cruise, file_name, channel, ping_idx, len(sv) AS samples FROM v_sounding WHERE cruise = 'C1' AND file_name = 'F5'",
)
def sounding_file(spark, d):
    """All soundings stored below their file's folder, one file read back."""
    path = scratch_path(spark, "soundings")
    tables.write_soundings(soundings(spark, d), path)
    return tables.read_soundings(spark, path, "C1", "F5").select(
        "cruise", "file_name", "channel", "ping_idx", F.size("sv").cast("long").alias("samples")
    )


@query(
    "linear_axis",
    """
SELECT o_orderkey, cast(j AS int) AS place, CASE WHEN j = 0 THEN 0e0 WHEN j = n - 1 THEN stop ELSE j * (stop / (n - 1)) END AS value
FROM (SELECT o_orderkey, o_totalprice AS stop, o_orderkey % 5 AS n, unnest(range(0, o_orderkey % 5)) AS j FROM orders)""",
)
def linear_axis(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.posexplode(arrays.linspace(F.col("o_totalprice"), F.col("o_orderkey") % 5)).alias("place", "value"),
    )


@query(
    "file_stage_status",
    """
SELECT i.file_name, i.cruise AS cruise_name,
  CASE WHEN f.file_name IS NULL THEN 'FAILURE' ELSE 'SUCCESS' END AS pipeline_status,
  CASE WHEN f.file_name IS NOT NULL THEN i.min_echo_range END AS min_echo_range,
  CASE WHEN f.file_name IS NOT NULL THEN i.max_echo_range END AS max_echo_range,
  CASE WHEN f.file_name IS NOT NULL THEN i.n END AS num_ping_time_dropna,
  CASE WHEN f.file_name IS NOT NULL THEN i.start_time END AS start_time,
  CASE WHEN f.file_name IS NOT NULL THEN 'level_1/Ship/' || i.cruise || '/EK60/' || i.file_name || '.zarr' END AS zarr_path,
  CASE WHEN f.file_name IS NOT NULL THEN 'stores' END AS zarr_bucket
FROM v_sound_info i LEFT JOIN (SELECT DISTINCT cruise, file_name FROM v_sounding_fix WHERE latitude IS NOT NULL) f
  ON i.cruise = f.cruise AND i.file_name = f.file_name
UNION ALL
SELECT DISTINCT file_name, cruise, 'FAILURE', NULL::double, NULL::double, NULL::bigint, NULL, NULL, NULL FROM v_sounding_fix
WHERE (cruise, file_name) NOT IN (SELECT (cruise, file_name) FROM v_sound_info)""",
)
def file_stage_status(spark, d):
    """The file stage from series to status log; files without positions or without pings fail."""
    path = scratch_path(spark, "stage")
    stage = file_job.file_stage(view(spark, d, "v_sounding_fix"), sounding_pings(spark, d), soundings(spark, d))
    tables.append_status(file_job.status_rows(stage, "Ship", "EK60", bucket="stores"), path)
    return tables.read_status(spark, path).select(
        "file_name", "cruise_name", "pipeline_status",
        *[F.col(c).cast("double").alias(c) for c in ("min_echo_range", "max_echo_range")],
        "num_ping_time_dropna", "start_time", "zarr_path", "zarr_bucket",
    )
