"""File stage for many files at once: checks, positions, statistics, status rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid.functions import names
from fathomgrid.operators import filestats, gps
from fathomgrid.operators.ordered import Layout
from fathomgrid.operators.status import FAILURE, SUCCESS
from fathomgrid.session import reliable
from fathomgrid.sources import geojson, tables

FILE = ["cruise", "file_name"]


@dataclass(frozen=True)
class FileStage:
    """Results of the stage; `violations` names each failed file with its reasons.

    `layout` is the size of the largest file, for later steps over the same pings.
    """

    aligned: DataFrame
    statistics: DataFrame
    violations: DataFrame
    layout: Layout


def violations(nmea: DataFrame, pings: DataFrame) -> DataFrame:
    """Files that break a rule, one row each with the sorted reasons."""
    layout = gps.measure_series(pings, nmea)
    checks = {
        "coordinates missing": gps.missing_columns(nmea, pings),
        "positions out of bounds": gps.bounds_violations(nmea),
        "fix times not sorted": gps.order_violations(nmea, layout=layout),
        "ping times not sorted": gps.order_violations(
            pings, position="ping_idx", ts="ping_time", layout=layout
        ),
    }
    found = [rows.select(*FILE, F.lit(reason).alias("reason")) for reason, rows in checks.items()]
    everything = reduce(DataFrame.unionByName, found).distinct()
    return everything.groupBy(*FILE).agg(F.array_sort(F.collect_list("reason")).alias("reasons"))


def file_stage(nmea: DataFrame, pings: DataFrame, soundings: DataFrame) -> FileStage:
    """Align positions and gather statistics; files with violations are left out of both."""
    fixes = gps.fixes_without_nan(nmea)
    # Used three times below, so it is computed once.
    broken = reliable(violations(fixes, pings))
    sound = lambda df: df.join(broken.select(*FILE), FILE, "left_anti")
    layout = gps.measure_series(pings, fixes)
    aligned = gps.align_fixes(sound(pings), sound(fixes), layout=layout)
    # Statistics are per file, so failed files are dropped after the wide rows were reduced.
    stats = sound(filestats.recorded_ranges(filestats.file_statistics(soundings)))
    counts = gps.valid_counts(aligned)
    joined = stats.join(counts, FILE, "left").withColumn(
        "num_ping_time_dropna", F.coalesce("num_ping_time_dropna", F.lit(0).cast("long"))
    )
    return FileStage(aligned, joined, broken, layout)


def status_rows(
    stage: FileStage, ship: str, sensor: str, event_seq: int = 1, bucket: str | None = None
) -> DataFrame:
    """SUCCESS rows with statistics and FAILURE rows, as the status log takes them.

    `bucket` is where the file stores are; the cruise stage reads it from the log.
    """
    named = lambda df: df.withColumnRenamed("cruise", "cruise_name").withColumns(
        {"ship_name": F.lit(ship), "sensor_name": F.lit(sensor)}
    )
    path = names.store_path(
        "level_1", F.col("ship_name"), F.col("cruise_name"), F.col("sensor_name"),
        names.store_name(F.col("file_name")),
    )
    done = tables.status_rows(named(stage.statistics), SUCCESS, event_seq).withColumns(
        {"zarr_path": path, "zarr_bucket": F.lit(bucket).cast("string")}
    )
    failed = tables.status_rows(named(stage.violations).drop("reasons"), FAILURE, event_seq)
    return done.unionByName(failed, allowMissingColumns=True)


def run(
    nmea: DataFrame, pings: DataFrame, soundings: DataFrame,
    ship: str, sensor: str, geojson_path: str, status_path: str, bucket: str | None = None,
) -> None:
    stage = file_stage(nmea, pings, soundings)
    geojson.write_features(stage.aligned, geojson_path)
    tables.append_status(status_rows(stage, ship, sensor, bucket=bucket), status_path)
