"""Regridding soundings onto the cruise grid; tiles, slices and dense reads of the cube.

A cube row is one (cruise, time index, frequency) with its whole depth column as an array.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomgrid.functions.regridding import nearest_on_axis
from fathomgrid.session import stored

TILE = 1024
"""Cells per tile edge on the depth and time axes."""
PING_BLOCK = 1024
FILE = ("cruise", "file_name")
AXIS = ("max_depth", "depth_bins")


def regrid(soundings: DataFrame, grid: DataFrame) -> DataFrame:
    """Depth column `sv` of every sounding on its cruise's axis. Row-local after the grid lookup."""
    return _on_axis(soundings.join(grid.select("cruise", *AXIS), "cruise"))


def _on_axis(soundings: DataFrame) -> DataFrame:
    """Regridded columns of soundings that have their axis beside them."""
    return soundings.withColumn("sv", nearest_on_axis("echo_range", "sv", *AXIS)).drop("echo_range", *AXIS)


def ping_block(ping_idx: Column) -> Column:
    """Number of the run of pings that is stored and joined together."""
    return F.floor(ping_idx / F.lit(PING_BLOCK))


def cube_rows(soundings: DataFrame, placed_pings: DataFrame, grid: DataFrame, tile: int = TILE) -> DataFrame:
    """Cube rows of all pings with a position.

    `placed_pings`: cruise, file_name, ping_idx, time_idx, epoch_seconds, latitude, longitude.
    The join comes first, so pings without a position are never regridded.

    Soundings meet the positions of a whole block of pings, which are folded into one map of at
    most `PING_BLOCK` entries. The key is therefore exactly what soundings are bucketed by: a
    bucketed table is not shuffled, any other is shuffled once, and either way a block stays in
    one task, so the sink writes few files per sound file.
    """
    place = F.struct(
        "time_idx",
        F.col("epoch_seconds").alias("ts"),
        F.col("latitude").cast("float").alias("latitude"),
        F.col("longitude").cast("float").alias("longitude"),
    )
    blocks = (
        placed_pings.select(*FILE, ping_block(F.col("ping_idx")).alias("ping_block"), "ping_idx", place.alias("place"))
        .groupBy(*FILE, "ping_block")
        .agg(F.map_from_entries(F.collect_list(F.struct("ping_idx", "place"))).alias("places"))
        # The grid comes to the blocks, so that samples meet one table only and it has their own key.
        .join(grid.select("cruise", *AXIS), "cruise")
    )
    if "ping_block" not in soundings.columns:
        soundings = soundings.withColumn("ping_block", ping_block(F.col("ping_idx")))
    kept = (
        soundings.join(blocks, [*FILE, "ping_block"])
        .withColumn("place", F.try_element_at("places", "ping_idx"))
        .filter(F.col("place").isNotNull())
        .drop("places")
    )
    return _on_axis(kept).select(
        *FILE, "place.time_idx", F.col("frequency").cast("float").alias("frequency"),
        "place.ts", "place.latitude", "place.longitude", "sv",
        time_tile(F.col("place.time_idx"), tile).alias("time_tile"),
    )


def time_tile(time_idx: Column, tile: int = TILE) -> Column:
    return F.floor(time_idx / F.lit(tile))


def whole_tiles(n: Column, tile: int = TILE) -> Column:
    """Size rounded up to a multiple of the tile edge."""
    return F.ceil(n / F.lit(tile)) * F.lit(tile)


def tiled(cube: DataFrame, tile: int = TILE) -> DataFrame:
    """Cut depth columns into tiles: one row per (cruise, frequency, depth tile, time index)."""
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size("sv") / F.lit(tile)).cast("int") - 1)),
        lambda d: F.slice(F.col("sv"), d * F.lit(tile) + F.lit(1), F.lit(tile)),
    )
    keep = [c for c in cube.columns if c not in ("sv", "time_tile")]
    return cube.select(
        *keep,
        time_tile(F.col("time_idx"), tile).alias("time_tile"),
        F.posexplode(pieces).alias("depth_tile", "sv"),
    )


def densify(cube: DataFrame, grid: DataFrame, tile: int = TILE) -> DataFrame:
    """Every (time index, frequency) of the grid, with null columns where nothing was written.

    Only cell keys are compared with the grid, so depth columns are not shuffled: missing cells
    are found by an anti join and appended. Time indexes are generated tile by tile, which spreads
    a wide cruise over many tasks before it is exploded.
    """
    tiles = grid.filter("width > 0").select(
        "cruise", "width", "depth_bins", "frequencies",
        F.explode(
            F.sequence(F.lit(0).cast("long"), time_tile(F.col("width") - 1, tile))
        ).alias("time_tile"),
    )
    cells = (
        tiles.repartition("cruise", "time_tile")
        .withColumn("frequency", F.explode("frequencies"))
        .withColumn("frequency", F.col("frequency").cast("float"))
        .withColumn(
            "time_idx",
            F.explode(
                F.sequence(
                    F.col("time_tile") * tile,
                    F.least((F.col("time_tile") + 1) * tile, F.col("width")) - 1,
                )
            ),
        )
    )
    columns = ["cruise", "frequency", "time_idx", "time_tile", "ts", "latitude", "longitude", "sv"]
    # Its keys are compared and its rows are returned: stored, it is regridded once for both.
    cube = stored(cube.select(*columns), "cube")
    missing = cells.join(
        cube.select("cruise", "frequency", "time_idx"), ["cruise", "frequency", "time_idx"], "left_anti"
    ).select(
        "cruise", "frequency", "time_idx", "time_tile",
        F.lit(None).cast("double").alias("ts"),
        F.lit(None).cast("float").alias("latitude"),
        F.lit(None).cast("float").alias("longitude"),
        F.array_repeat(F.lit(None).cast("float"), F.col("depth_bins").cast("int")).alias("sv"),
    )
    return cube.unionByName(missing)


def read_slice(cube: DataFrame, cruise: str, start: int, end: int, tile: int = TILE) -> DataFrame:
    """Rows [start, end) of a cruise; tile numbers are given too, so stored tiles can be skipped."""
    if end <= start:
        return cube.limit(0)
    return cube.filter(
        (F.col("cruise") == cruise)
        & F.col("time_tile").between(start // tile, (end - 1) // tile)
        & F.col("time_idx").between(start, end - 1)
    )


_SLAB = "cruise string, time_tile bigint, depth_tile int, frequency float, depth_idx int, time_idx array<bigint>, values array<float>"


def _block(pieces: pa.ListArray) -> np.ndarray:
    """Depth pieces, one per row, as a matrix with NaN where there is no value."""
    sizes = pieces.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = pieces.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    out = np.full((len(pieces), int(sizes.max(initial=0))), np.nan, np.float32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _turned(key: tuple, rows: pa.Table) -> pa.Table:
    """Depth x time of one chunk from its time x depth, buffer by buffer."""
    rows = rows.sort_by("time_idx").combine_chunks()
    sv = rows.column("sv").combine_chunks()
    matrix = _block(sv.chunk(0) if isinstance(sv, pa.ChunkedArray) else sv).T
    deep, wide = matrix.shape
    flat = np.ascontiguousarray(matrix).ravel()
    ends = pa.array(np.arange(deep + 1, dtype=np.int32) * wide)
    first = key[2].as_py() * TILE
    times = np.tile(rows.column("time_idx").to_numpy(), deep)
    return pa.table(
        [
            pa.array([key[i].as_py()] * deep, kind)
            for i, kind in enumerate((pa.string(), pa.int64(), pa.int32(), pa.float32()))
        ]
        + [
            pa.array(np.arange(first, first + deep, dtype=np.int32)),
            pa.ListArray.from_arrays(ends, pa.array(times)),
            pa.ListArray.from_arrays(ends, pa.array(flat, mask=np.isnan(flat))),
        ],
        names=["cruise", "time_tile", "depth_tile", "frequency", "depth_idx", "time_idx", "values"],
    )


def depth_major(cube: DataFrame) -> DataFrame:
    """Reorder to (depth, time, frequency): per depth, time tile and frequency, values by time.

    Columns are cut into tiles first, so what a task turns at a time is one chunk of at most a tile each way, some
    4 MB, whatever the cruise's depth and length are; samples are never rows of a shuffle.
    """
    pieces = tiled(cube.select("cruise", "frequency", "time_idx", "sv"))
    return pieces.groupBy("cruise", "time_tile", "depth_tile", "frequency").applyInArrow(_turned, _SLAB).drop("depth_tile")
