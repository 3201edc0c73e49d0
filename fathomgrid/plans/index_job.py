"""Cruise index of an archive: listing to stored index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fathomgrid.operators import catalog
from fathomgrid.sources import archive, tables


def index_objects(objects: DataFrame, root: str, calibration_path: str) -> DataFrame:
    """Index rows of listed objects (key, size), for instance an inventory table of a large archive.

    Keys are relative to `root`, the folder that holds data/raw.
    """
    spark = objects.sparkSession
    files = catalog.raw_files(catalog.select_keys(objects))
    headers = archive.header_tags(catalog.representatives(files), root)
    calibration = catalog.calibration_entries(archive.read_calibration(spark, calibration_path))
    return catalog.cruise_index(files, headers, calibration)


def index_archive(spark: SparkSession, root: str, calibration_path: str) -> DataFrame:
    """Index rows of the archive below `root`, which is listed first; the driver holds that listing."""
    return index_objects(archive.list_objects(spark, root), root, calibration_path)


def run(
    spark: SparkSession, root: str, calibration_path: str, out: str, objects: DataFrame | None = None
) -> None:
    """Rebuild the index from `objects`, or from a listing of `root`."""
    found = archive.list_objects(spark, root) if objects is None else objects
    tables.write_index(index_objects(found, root, calibration_path), out)
