"""Common grid of a cruise: size, axes, and each file's slice of the time axis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid.functions import arrays
from fathomgrid.operators.ordered import Layout, running_sum, scan


def cruise_channels(files: DataFrame) -> DataFrame:
    """Sorted distinct channels per cruise. Lists are flattened and made distinct before grouping,
    so a group holds one element per channel, not one per file."""
    pairs = files.select("cruise", F.explode("channels").alias("channel")).distinct()
    return pairs.groupBy("cruise").agg(F.array_sort(F.collect_list("channel")).alias("channels"))


def cruise_frequencies(files: DataFrame) -> DataFrame:
    """Frequencies of the earliest file of each cruise, as numbers."""
    first = F.min_by("frequencies", F.struct("start_time", "file_name"))
    return files.groupBy("cruise").agg(arrays.to_doubles(first).alias("frequencies"))


def cruise_dimensions(files: DataFrame) -> DataFrame:
    """Width, range step, deepest range and both grid heights per cruise.

    Files whose step is not positive are left out of the step, and nowhere else.
    """
    step = F.col("min_echo_range").cast("double")
    sizes = files.groupBy("cruise").agg(
        F.sum("num_ping_time_dropna").alias("width"),
        F.min(F.when(step > 0, step)).alias("step"),
        F.max(F.col("max_echo_range").cast("double")).alias("max_depth"),
    )
    return sizes.withColumns(
        {
            "depth_bins": arrays.depth_bins(F.col("max_depth"), F.col("step")),
            "stored_height": arrays.stored_height(F.col("max_depth"), F.col("step")),
        }
    )


def cruise_grid(files: DataFrame) -> DataFrame:
    """Dimensions with channels and frequencies: one row per cruise."""
    return (
        cruise_dimensions(files)
        .join(cruise_channels(files), "cruise", "left")
        .join(cruise_frequencies(files), "cruise", "left")
    )


def depth_axis(grid: DataFrame) -> DataFrame:
    """Depths of the regridded axis, one row per bin."""
    axis = arrays.regrid_depths(F.col("max_depth"), F.col("depth_bins"))
    return grid.select("cruise", F.posexplode(axis).alias("depth_idx", "depth"))


def stored_depth_axis(grid: DataFrame) -> DataFrame:
    """Depths of the stored axis, one row per bin."""
    axis = arrays.stored_depths(F.col("step"), F.col("stored_height"))
    return grid.select("cruise", F.posexplode(axis).alias("depth_idx", "depth"))


def file_slices(files: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Start and end of each file on its cruise's time axis, files in start order."""
    counted = scan(
        files, ["cruise"], ["start_time", "file_name"],
        [running_sum("end_idx", F.col("num_ping_time_dropna"))], layout,
    )
    return counted.withColumn(
        "start_idx", F.col("end_idx") - F.coalesce("num_ping_time_dropna", F.lit(0).cast("long"))
    )


def on_time_axis(positions: DataFrame, slices: DataFrame) -> DataFrame:
    """Cruise-wide time index of each valid ping: start of its slice plus place in its file."""
    starts = slices.select("cruise", "file_name", "start_idx")
    return (
        positions.join(starts, ["cruise", "file_name"])
        .withColumn("time_idx", F.col("start_idx") + F.col("position"))
        .drop("start_idx")
    )
