"""GPS fixes aligned to pings, and checks on both series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid.functions import arrays, geo, times
from fathomgrid.operators.ordered import Layout, last_seen, measure, previous, running_sum, scan

FILE_KEY = ("cruise", "file_name")


def fixes_without_nan(nmea: DataFrame) -> DataFrame:
    return nmea.withColumns(
        {c: arrays.nan_to_null(F.col(c)) for c in ("latitude", "longitude")}
    )


def measure_series(
    pings: DataFrame, nmea: DataFrame, keys: Sequence[str] = FILE_KEY, limit: int | None = None
) -> Layout:
    """Size of the largest file over both series; it bounds every later step on its pings too."""
    return measure(pings.select(*keys).unionByName(nmea.select(*keys)), keys, limit)


def align_fixes(
    pings: DataFrame,
    nmea: DataFrame,
    keys: Sequence[str] = FILE_KEY,
    layout: Layout | None = None,
) -> DataFrame:
    """Backward as-of join: each ping takes the last fix at or before it.

    `pings` has the keys, ping_idx and ping_time; `nmea` the keys, seq, ts, latitude, longitude.
    A ping before the first fix has no position. A fix without position counts as the last fix
    and is not skipped. Fixes at one instant: the highest seq wins.

    Both series go through one ordered pass per file, so data are shuffled once and no pair of
    rows is ever formed.
    """
    keys = list(keys)
    fix = F.struct("latitude", "longitude")
    right = nmea.select(
        *keys,
        F.col("ts").alias("__at"),
        F.lit(0).alias("__kind"),
        F.col("seq").cast("long").alias("__seq"),
        fix.alias("__fix"),
        F.lit(None).cast("long").alias("ping_idx"),
        F.lit(None).cast(pings.schema["ping_time"].dataType).alias("ping_time"),
    )
    left = pings.select(
        *keys,
        F.col("ping_time").alias("__at"),
        F.lit(1).alias("__kind"),
        F.col("ping_idx").cast("long").alias("__seq"),
        F.lit(None).cast(right.schema["__fix"].dataType).alias("__fix"),
        F.col("ping_idx").cast("long").alias("ping_idx"),
        "ping_time",
    )
    both = right.unionByName(left)
    seen = scan(both, keys, ["__at", "__kind", "__seq"], [last_seen("__last", F.col("__fix"))], layout)
    return seen.filter("__kind = 1").select(
        *keys,
        "ping_idx",
        "ping_time",
        F.col("__last.latitude").alias("latitude"),
        F.col("__last.longitude").alias("longitude"),
    )


def with_geometry(aligned: DataFrame) -> DataFrame:
    return aligned.withColumn("geometry", geo.point(F.col("longitude"), F.col("latitude")))


def valid_pings(aligned: DataFrame) -> DataFrame:
    """Pings with a position, with epoch seconds."""
    return aligned.dropna(subset=["latitude", "longitude"]).withColumn(
        "epoch_seconds", times.epoch_seconds(F.col("ping_time"))
    )


def valid_counts(aligned: DataFrame, keys: Sequence[str] = FILE_KEY) -> DataFrame:
    """Pings with a latitude per file."""
    return aligned.groupBy(*keys).agg(F.count("latitude").alias("num_ping_time_dropna"))


def positions_in_file(
    valid: DataFrame, keys: Sequence[str] = FILE_KEY, layout: Layout | None = None
) -> DataFrame:
    """Zero-based place of each valid ping within its file."""
    ranked = scan(valid, list(keys), ["ping_idx"], [running_sum("__n", F.lit(1).cast("long"))], layout)
    return ranked.withColumn("position", F.col("__n") - 1).drop("__n")


def match_times(times_wanted: DataFrame, pings: DataFrame, keys: Sequence[str] = FILE_KEY) -> DataFrame:
    """Ping index for each wanted time that occurs exactly; the first ping wins among equal times."""
    keys = list(keys)
    first = pings.groupBy(*keys, "ping_time").agg(F.min("ping_idx").alias("ping_idx"))
    return times_wanted.join(first, [*keys, "ping_time"])


def bounds_violations(fixes: DataFrame) -> DataFrame:
    """Rows with a latitude or longitude out of range."""
    return fixes.filter(~geo.in_bounds(F.col("latitude"), F.col("longitude")))


def order_violations(
    series: DataFrame,
    keys: Sequence[str] = FILE_KEY,
    position: str = "seq",
    ts: str = "ts",
    layout: Layout | None = None,
) -> DataFrame:
    """Rows earlier than the row before them; equal times are in order."""
    checked = scan(series, list(keys), [position], [previous("previous_ts", F.col(ts))], layout)
    return checked.filter(F.col("previous_ts") > F.col(ts))


def missing_columns(nmea: DataFrame, pings: DataFrame, keys: Sequence[str] = FILE_KEY) -> DataFrame:
    """Files that lack positions or times altogether, with what they have."""
    keys = list(keys)
    some = lambda c: F.bool_or(F.col(c).isNotNull())
    fixes = nmea.groupBy(*keys).agg(
        (some("latitude") & some("longitude")).alias("has_position"), some("ts").alias("has_fix_time")
    )
    series = pings.groupBy(*keys).agg(some("ping_time").alias("has_ping_time"))
    flags = ("has_position", "has_fix_time", "has_ping_time")
    return (
        fixes.join(series, keys, "full_outer")
        .select(*keys, *[F.coalesce(f, F.lit(False)).alias(f) for f in flags])
        .filter("NOT (has_position AND has_fix_time AND has_ping_time)")
    )


def features(aligned: DataFrame) -> DataFrame:
    """One GeoJSON feature per ping; the id is the ping time."""
    lat, lon = F.col("latitude"), F.col("longitude")
    feature = F.struct(
        times.iso_nanos(F.col("ping_time")).alias("id"),
        F.lit("Feature").alias("type"),
        F.struct(lat.alias("latitude"), lon.alias("longitude")).alias("properties"),
        geo.point(lon, lat).alias("geometry"),
    )
    return aligned.withColumn("feature", feature)


COLLECTION_HEAD = '{"type":"FeatureCollection","features":['
COLLECTION_TAIL = "]}"
_AS_JSON = {"ignoreNullFields": "false"}


def collection_lines(
    aligned: DataFrame, keys: Sequence[str] = FILE_KEY, layout: Layout | None = None
) -> DataFrame:
    """The lines of one FeatureCollection per file: the keys, part (1 features, 2 the end), ping_idx and line.

    In the order of part and ping_idx the lines of a file are a document: the first opens it, every further feature
    begins with a comma, the last line closes it. So a document of any length is rows, and none is an array.
    """
    follows = scan(features(aligned), list(keys), ["ping_idx"], [previous("__before", F.col("ping_idx"))], layout)
    feature = F.to_json("feature", _AS_JSON)
    line = lambda part, text: F.struct(F.lit(part).alias("part"), text.alias("line"))
    first = F.array(
        line(1, F.concat(F.lit(COLLECTION_HEAD + "\n"), feature)), line(2, F.lit(COLLECTION_TAIL))
    )
    later = F.array(line(1, F.concat(F.lit(","), feature)))
    return follows.select(*keys, "ping_idx", F.inline(F.when(F.col("__before").isNull(), first).otherwise(later)))


def feature_collections(aligned: DataFrame, keys: Sequence[str] = FILE_KEY) -> DataFrame:
    """One row per file with its collection, for files that fit in a row; `collection_lines` has no such bound."""
    ordered = F.array_sort(F.collect_list(F.struct("ping_idx", "feature")))
    return features(aligned).groupBy(*keys).agg(
        F.struct(
            F.lit("FeatureCollection").alias("type"),
            F.transform(ordered, lambda f: f["feature"]).alias("features"),
        ).alias("collection")
    )
