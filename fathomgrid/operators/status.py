"""File status log: latest state per file, eligibility, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Status vocabulary.
PROCESSING = "PROCESSING"
SUCCESS = "SUCCESS"
FAILURE = "FAILURE"
POPULATING = "POPULATING_CRUISE_ZARR"
NONE = "NONE"

ELIGIBLE = (SUCCESS, POPULATING)
KEY = ("file_name", "cruise_name")


def latest_status(log: DataFrame) -> DataFrame:
    """Last row written per (file, cruise); the whole row wins, attributes are not merged.

    An aggregate rather than a ranking: repeated writes collapse before the shuffle.
    """
    rest = [c for c in log.columns if c not in KEY]
    newest = F.max_by(F.struct(*rest), F.struct("pipeline_time", "event_seq"))
    return (
        log.groupBy(*KEY).agg(newest.alias("row")).select(*KEY, "row.*").select(*log.columns)
    )


def status_of(files: DataFrame, log: DataFrame) -> DataFrame:
    """Status of each requested (file, cruise); NONE where nothing was ever written."""
    current = latest_status(log).select(*KEY, "pipeline_status")
    return files.join(current, list(KEY), "left").withColumn(
        "pipeline_status", F.coalesce("pipeline_status", F.lit(NONE))
    )


def is_eligible(status: Column, eligible: tuple[str, ...] = ELIGIBLE) -> Column:
    return status.isin(*eligible)


def not_excluded(status: Column) -> Column:
    """The sizing step's own wording: neither failed nor in progress."""
    return (status != FAILURE) & (status != PROCESSING)


def eligible_files(log: DataFrame, eligible: tuple[str, ...] = ELIGIBLE) -> DataFrame:
    """Latest rows with a status that later stages may use."""
    return latest_status(log).filter(is_eligible(F.col("pipeline_status"), eligible))


def in_start_order(files: DataFrame) -> DataFrame:
    return files.orderBy("start_time", "file_name")


def cruises_without_files(log: DataFrame, eligible: tuple[str, ...] = ELIGIBLE) -> DataFrame:
    """Check rows: cruises of which no file is eligible."""
    usable = F.sum(is_eligible(F.col("pipeline_status"), eligible).cast("long"))
    return (
        latest_status(log)
        .groupBy("cruise_name")
        .agg(F.count(F.lit(1)).alias("files"), usable.alias("usable"))
        .filter("usable = 0")
    )


def lookup_paths(requested: DataFrame, files: DataFrame) -> DataFrame:
    """File rows for requested store paths, with `known` false where the path does not exist."""
    found = files.withColumn("known", F.lit(True))
    return requested.join(found, "zarr_path", "left").withColumn(
        "known", F.coalesce("known", F.lit(False))
    )


def pending_files(files: DataFrame, log: DataFrame, overwrite: bool = False) -> DataFrame:
    """Files still to be processed: those without SUCCESS, or all when overwriting."""
    if overwrite:
        return files
    done = latest_status(log).filter(F.col("pipeline_status") == SUCCESS).select(*KEY)
    return files.join(done, list(KEY), "left_anti")


def reconcile(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose row counts differ between two frames, with both counts.

    Each side is counted first, so the join handles one row per key.
    """
    want = expected.groupBy(*keys).agg(F.count(F.lit(1)).alias("expected"))
    have = actual.groupBy(*keys).agg(F.count(F.lit(1)).alias("actual"))
    return _mismatches(want, have, keys)


def reconcile_slices(slices: DataFrame, valid_pings: DataFrame) -> DataFrame:
    """Files whose number of valid pings is not the length of their slice."""
    keys = ["cruise", "file_name"]
    want = slices.select(*keys, (F.col("end_idx") - F.col("start_idx")).alias("expected"))
    have = valid_pings.groupBy(*keys).agg(F.count(F.lit(1)).alias("actual"))
    return _mismatches(want, have, keys)


def _mismatches(want: DataFrame, have: DataFrame, keys: list[str]) -> DataFrame:
    zero = F.lit(0).cast("long")
    return (
        want.join(have, keys, "full_outer")
        .select(
            *keys,
            F.coalesce("expected", zero).alias("expected"),
            F.coalesce("actual", zero).alias("actual"),
        )
        .filter("expected <> actual")
    )
