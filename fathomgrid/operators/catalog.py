"""Cruise index over an archive listing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid.functions import names, times

# Header tag of the indexed format and the token that selects keys.
RAW_DATAGRAM = "CON0"
SENSOR_TOKEN = "EK60"
RAW_SUFFIX = ".raw"


def union_all(*parts: DataFrame) -> DataFrame:
    """One frame from listings with the same columns, kept by name."""
    return reduce(DataFrame.unionByName, parts)


def select_keys(objects: DataFrame, token: str = SENSOR_TOKEN) -> DataFrame:
    """Key and size of objects whose key holds the token anywhere."""
    return objects.filter(F.contains("key", F.lit(token))).select("key", "size")


def raw_files(objects: DataFrame, suffix: str = RAW_SUFFIX) -> DataFrame:
    """Split archive keys into ship, cruise, sensor and file; keys of another depth are no raw files."""
    key = F.col("key")
    return objects.filter(names.has_index_depth(key) & F.endswith(key, F.lit(suffix))).select(
        "key",
        names.basename(key).alias("filename"),
        names.path_part(key, 4).alias("ship"),
        names.path_part(key, 3).alias("cruise"),
        names.path_part(key, 2).alias("sensor"),
        "size",
        names.name_timestamp(names.basename(key)).alias("start_ts"),
    )


def file_stage_parts(keys: DataFrame) -> DataFrame:
    """Parts of a key counted from its end, with the names of the store built from it."""
    key = F.col("key")
    ship, cruise, sensor = (names.path_part(key, n) for n in (4, 3, 2))
    store = names.store_name(names.basename(key))
    return keys.select(
        "key",
        ship.alias("ship"),
        cruise.alias("cruise"),
        sensor.alias("sensor"),
        names.basename(key).alias("file_name"),
        store.alias("store_name"),
        names.store_path("level_1", ship, cruise, sensor, store).alias("zarr_path"),
    )


def select_suffix(objects: DataFrame, suffix: str | None = RAW_SUFFIX, prefix: str = "") -> DataFrame:
    """Objects below a prefix with a suffix, excluded base names left out."""
    chosen = objects.filter(names.wanted(F.col("key"), suffix))
    return chosen.filter(F.startswith("key", F.lit(prefix))) if prefix else chosen


def representatives(files: DataFrame) -> DataFrame:
    """One key per cruise, the smallest."""
    return files.groupBy("cruise").agg(F.min("key").alias("key"))


def with_datagram(files: DataFrame, headers: DataFrame, datagram: str = RAW_DATAGRAM) -> DataFrame:
    """Give every file its cruise's header tag and keep the files of the wanted format.

    `headers` holds one row per cruise: cruise, datagram.
    """
    matching = headers.filter(F.col("datagram") == datagram).select("cruise", "datagram")
    return files.drop("datagram").join(matching, "cruise")


def calibration_entries(sheet: DataFrame) -> DataFrame:
    """Normalised calibration sheet."""
    return sheet.select(
        names.dataset_cruise(F.col("DATASET_NAME")).alias("dataset_name"),
        F.col("INSTRUMENT_NAME").alias("instrument_name"),
        names.states_calibrated(F.col("CAL_STATE")).alias("calibrated"),
    )


def dataset_names(calibration: DataFrame) -> DataFrame:
    return calibration.select("dataset_name").distinct()


def cruise_names(files: DataFrame) -> DataFrame:
    """Distinct cruises in ascending order."""
    return files.select("cruise").distinct().orderBy("cruise")


def with_calibrated(cruises: DataFrame, calibration: DataFrame) -> DataFrame:
    """Flag cruises that occur in the calibration sheet, whatever state it gives.

    `cal_state` additionally tells whether any entry of the cruise says so. Both sides hold one
    row per cruise, so Spark may pick the join.
    """
    listed = calibration.groupBy(F.col("dataset_name").alias("cruise")).agg(
        F.bool_or("calibrated").alias("cal_state")
    )
    return (
        cruises.join(listed.withColumn("listed", F.lit(True)), "cruise", "left")
        .withColumn("calibrated", F.col("listed").isNotNull())
        .drop("listed")
    )


def cruise_index(
    files: DataFrame, headers: DataFrame, calibration: DataFrame, datagram: str = RAW_DATAGRAM
) -> DataFrame:
    """One row per cruise of the wanted format.

    Files are aggregated first, map-side and then by cruise; header tag and calibration are
    looked up for the few rows that remain. A cruise with any number of files thus costs its
    task one partial row per scan task.
    """
    totals = files.groupBy("cruise").agg(
        F.min("ship").alias("ship"),
        F.min("sensor").alias("sensor"),
        F.count(F.lit(1)).alias("file_count"),
        F.sum("size").alias("total_size"),
        times.iso_seconds(F.min("start_ts")).alias("start_date"),
        times.iso_seconds(F.max("start_ts")).alias("end_date"),
    )
    tagged = totals.join(
        headers.filter(F.col("datagram") == datagram).select("cruise", "datagram"), "cruise"
    )
    return with_calibrated(tagged, calibration).select(
        "cruise", "ship", "sensor", "datagram", "file_count", "total_size", "calibrated",
        "start_date", "end_date",
    )


def calibrated_counts(index: DataFrame) -> DataFrame:
    """Cruises by calibrated flag."""
    return index.groupBy("calibrated").agg(F.count(F.lit(1)).alias("cruises"))
