"""Instants, ISO text and epoch numbers (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 as a double, fraction kept."""
    return epoch_micros(ts) / F.lit(1e6)


def iso_millis(ts: Column) -> Column:
    """ISO text with milliseconds (cut, not rounded) and Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_nanos(ts: Column) -> Column:
    """Feature id form: nine fraction digits, no zone."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("000"))


def stamped(df):
    """Add the processing time to every record."""
    return df.withColumn("pipeline_time", F.current_timestamp())
