"""Statistics of sound files. Samples stay in their arrays; only per-ping results are grouped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid.functions import arrays, names, times

FILE_KEY = ("cruise", "file_name")


def range_steps(soundings: DataFrame) -> DataFrame:
    """Smallest sample spacing and largest range of every ping."""
    return soundings.withColumns(
        {
            "step": arrays.smallest_step(F.col("echo_range")),
            "deepest": arrays.largest(F.col("echo_range")),
        }
    )


def file_statistics(soundings: DataFrame, keys: Sequence[str] = FILE_KEY) -> DataFrame:
    """Range step and maximum, first and last ping by position, channels and frequencies per file.

    The n-th frequency belongs to the n-th channel: both come from one set of pairs, in order of
    `channel_idx` where soundings carry it, else of frequency and channel.
    """
    order = [c for c in ("channel_idx",) if c in soundings.columns]
    pair = F.struct(*order, F.col("frequency").cast("double").alias("frequency"), "channel")
    pairs = F.array_sort(F.collect_set(pair))
    per_ping = range_steps(soundings)
    return per_ping.groupBy(*keys).agg(
        F.min("step").alias("min_echo_range"),
        F.max("deepest").alias("max_echo_range"),
        times.iso_millis(F.min_by("ping_time", "ping_idx")).alias("start_time"),
        times.iso_millis(F.max_by("ping_time", "ping_idx")).alias("end_time"),
        F.transform(pairs, lambda p: p["channel"]).alias("channels"),
        F.transform(pairs, lambda p: p["frequency"]).alias("frequencies"),
    )


def recorded_ranges(stats: DataFrame) -> DataFrame:
    """Ranges as they are recorded: four decimals, half to even."""
    return stats.withColumns(
        {c: arrays.half_even(F.col(c), 4) for c in ("min_echo_range", "max_echo_range")}
    )


def zero_step_files(stats: DataFrame) -> DataFrame:
    """Files with repeated or descending ranges, which cannot define a grid."""
    return stats.filter("min_echo_range <= 0")


def loudest_per_ping(soundings: DataFrame, keys: Sequence[str] = FILE_KEY) -> DataFrame:
    """Largest value over all channels of a ping, and whether the ping has no value at all."""
    return soundings.groupBy(*keys, "ping_idx").agg(
        F.max(arrays.largest(F.col("sv"))).alias("max_sv"),
        F.bool_and(arrays.all_missing(F.col("sv"))).alias("all_missing"),
    )


def cube_shape(soundings: DataFrame, keys: Sequence[str] = FILE_KEY) -> DataFrame:
    """Number of channels, pings and samples per file."""
    pings = soundings.groupBy(*keys, "channel", "ping_idx").agg(F.max(F.size("sv")).alias("samples"))
    return pings.groupBy(*keys).agg(
        F.count_distinct("channel").alias("channels"),
        F.count_distinct("ping_idx").alias("pings"),
        F.max("samples").cast("long").alias("samples"),
    )


def mean_sv(cube: DataFrame, keys: Sequence[str] = FILE_KEY) -> DataFrame:
    """Mean of all present values per file: sums per row first, then one small group."""
    present = arrays.nans_to_nulls(F.col("sv"))
    row_sum = F.aggregate(
        present, F.lit(0.0), lambda acc, x: acc + F.coalesce(x.cast("double"), F.lit(0.0))
    )
    row_count = F.size(F.filter(present, lambda x: x.isNotNull()))
    totals = cube.select(*keys, row_sum.alias("s"), row_count.alias("n")).groupBy(*keys).agg(
        F.sum("s").alias("s"), F.sum("n").alias("n")
    )
    return totals.select(*keys, (F.col("s") / F.nullif(F.col("n"), F.lit(0))).alias("mean_sv"))


def uncalibrated_files(descriptions: DataFrame) -> DataFrame:
    """Calibrated flag from the beam group description."""
    return descriptions.withColumn(
        "calibrated", ~names.described_uncalibrated(F.col("beam_group_descr"))
    )
