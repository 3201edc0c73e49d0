"""Cruise stage: grid from the status log, cube from soundings and positions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid.operators import cube, gps, grid, status
from fathomgrid.operators.ordered import Layout
from fathomgrid.session import reliable, stored
from fathomgrid.sources import tables


@dataclass(frozen=True)
class CruiseStage:
    """`mismatches` lists files whose slice length is not their number of valid pings."""

    grid: DataFrame
    cube: DataFrame
    mismatches: DataFrame
    slices: DataFrame


def cruise_stage(
    log: DataFrame,
    aligned: DataFrame,
    soundings: DataFrame,
    eligible: tuple[str, ...] = status.ELIGIBLE,
    layout: Layout | None = None,
) -> CruiseStage:
    """Grid and cube of every cruise in the log; `layout` is that of the file stage, if at hand.

    One set of eligible statuses sizes the grid and places the slices, so both agree.
    """
    # One row per file, read five times below: computed once.
    files = reliable(
        status.eligible_files(log, eligible)
        .withColumnRenamed("cruise_name", "cruise")
        .withColumns({c: F.col(c).cast("double") for c in ("min_echo_range", "max_echo_range")})
    )
    # Read from tables, whose bytes are known, they are broadcast when that is cheaper than moving samples.
    cruise_grid = stored(grid.cruise_grid(files), "grid")
    slices = stored(grid.file_slices(files), "slices")
    valid = gps.positions_in_file(gps.valid_pings(aligned), layout=layout)
    placed = grid.on_time_axis(valid, slices)
    return CruiseStage(
        cruise_grid,
        cube.cube_rows(soundings, placed, cruise_grid),
        status.reconcile_slices(slices, placed),
        slices,
    )


def run(
    log: DataFrame, aligned: DataFrame, soundings: DataFrame, out: str, layout: Layout | None = None
) -> DataFrame:
    """Write the cube and return the reconciliation rows (none when all is well).

    Slices of files that are no longer eligible are removed, as the others have moved.
    """
    stage = cruise_stage(log, aligned, soundings, layout=layout)
    tables.write_cube(stage.cube, out)
    tables.drop_stale_slices(log.sparkSession, out, stage.slices)
    return stage.mismatches
