"""Column expressions over object keys, file names and calibration text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File name patterns, excluded prefix, dataset suffix and calibration marker.
DATE_PATTERN = r"D(\d{8})"
TIME_PATTERN = r"T(\d{6})"
NAME_TIME_FORMAT = "yyyyMMddHHmmss"
EXCLUDED_PREFIX = "NOISE"
DATASET_SUFFIX = "_EK60"
CALIBRATED_TEXT = "Calibrated"
UNCALIBRATED_TEXT = "uncalibrated"
INDEX_DEPTH = 6


def basename(key: Column) -> Column:
    return F.element_at(F.split(key, "/"), -1)


def has_index_depth(key: Column) -> Column:
    """An archive key has exactly six parts: data/raw/ship/cruise/sensor/file."""
    return F.size(F.split(key, "/")) == INDEX_DEPTH


def path_part(key: Column, from_end: int) -> Column:
    """Part of a path counted from its end: 1 file, 2 sensor, 3 cruise, 4 ship; null if too short."""
    parts = F.split(key, "/")
    return F.try_element_at(parts, F.lit(-from_end))


def name_timestamp(filename: Column) -> Column:
    """Start time in a file name; null when a part is missing or is no calendar time.

    Date and time are looked up independently, each at its first occurrence.
    """
    day = F.regexp_extract(filename, DATE_PATTERN, 1)
    clock = F.regexp_extract(filename, TIME_PATTERN, 1)
    return F.try_to_timestamp(F.concat(day, clock), F.lit(NAME_TIME_FORMAT))


def wanted(key: Column, suffix: str | None) -> Column:
    """Key has the suffix (None: any) and its base name is not an excluded one."""
    keep = ~F.startswith(basename(key), F.lit(EXCLUDED_PREFIX))
    return keep if suffix is None else keep & F.endswith(key, F.lit(suffix))


def store_name(filename: Column) -> Column:
    """File name with its last extension replaced by .zarr; a leading dot is no extension."""
    return F.concat(F.regexp_replace(filename, r"(?<=[^.])\.[^.]*$", ""), F.lit(".zarr"))


def store_path(level: str, ship: Column, cruise: Column, sensor: Column, store: Column) -> Column:
    return F.concat_ws("/", F.lit(level), ship, cruise, sensor, store)


def dataset_cruise(dataset: Column) -> Column:
    """Cruise name in a calibration dataset name."""
    return F.substring_index(dataset, DATASET_SUFFIX, 1)


def states_calibrated(cal_state: Column) -> Column:
    return F.contains(cal_state, F.lit(CALIBRATED_TEXT))


def described_uncalibrated(description: Column) -> Column:
    """The marker counts anywhere but at the very start of the text."""
    return F.instr(description, UNCALIBRATED_TEXT) > 1


def header_tag(content: Column) -> Column:
    """Bytes 3 to 7 of a file as text, NULs stripped from both ends."""
    tag = F.decode(F.substring(content, 4, 5), "UTF-8")
    return F.regexp_replace(tag, "^\u0000+|\u0000+$", "")
