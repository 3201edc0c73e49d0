"""GPS alignment and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomgrid import schemas
from fathomgrid.functions import times
from fathomgrid.operators import gps
from fathomgrid.session import scratch_path
from fathomgrid.sources import geojson
from workload.registry import query, sql_view
from workload.views import view

sql_view(
    "v_aligned",
    """
SELECT p.cruise, p.file_name, p.ping_idx, p.ping_time, f.latitude, f.longitude
FROM v_ping p ASOF LEFT JOIN v_fix f
  ON p.cruise = f.cruise AND p.file_name = f.file_name AND p.ping_time >= f.ts""",
)
sql_view("v_valid", "SELECT * FROM v_aligned WHERE latitude IS NOT NULL AND longitude IS NOT NULL")


def _aligned(spark, d, layout=None):
    return gps.align_fixes(view(spark, d, "v_ping"), view(spark, d, "v_fix"), layout=layout)


@query("gps_asof", "SELECT * FROM v_aligned")
def gps_asof(spark, d):
    return _aligned(spark, d)


@query("valid_pings", "SELECT *, epoch_us(ping_time) / 1e6 AS epoch_seconds FROM v_valid")
def valid_pings(spark, d):
    return gps.valid_pings(_aligned(spark, d))


@query(
    "valid_counts",
    "SELECT cruise, file_name, count(latitude) AS num_ping_time_dropna FROM v_aligned GROUP BY cruise, file_name",
)
def valid_counts(spark, d):
    return gps.valid_counts(_aligned(spark, d))


@query(
    "ping_positions",
    "SELECT *, row_number() OVER (PARTITION BY cruise, file_name ORDER BY ping_idx) - 1 AS position FROM v_valid",
)
def ping_positions(spark, d):
    layout = gps.measure_series(view(spark, d, "v_ping"), view(spark, d, "v_fix"))
    valid = gps.valid_pings(_aligned(spark, d, layout)).drop("epoch_seconds")
    return gps.positions_in_file(valid, layout=layout)


@query(
    "time_match",
    """
SELECT v.cruise, v.file_name, v.ping_time, p.ping_idx
FROM (SELECT cruise, file_name, date_trunc('day', ping_time) AS ping_time FROM v_valid) v
JOIN (SELECT cruise, file_name, date_trunc('day', ping_time) AS ping_time, min(ping_idx) AS ping_idx
      FROM v_ping GROUP BY ALL) p USING (cruise, file_name, ping_time)""",
)
def time_match(spark, d):
    # Times are cut to the day, so that several pings share one.
    day = F.date_trunc("day", "ping_time").cast("timestamp_ntz")
    wanted = gps.valid_pings(_aligned(spark, d)).select("cruise", "file_name", day.alias("ping_time"))
    return gps.match_times(wanted, view(spark, d, "v_ping").withColumn("ping_time", day))


@query(
    "bounds_violations",
    "SELECT * FROM v_fix WHERE latitude < -90 OR latitude > 90 OR longitude < -180 OR longitude > 180",
)
def bounds_violations(spark, d):
    return gps.bounds_violations(view(spark, d, "v_fix"))


@query(
    "order_violations",
    """
SELECT * FROM (
  SELECT cruise, file_name, seq, ts, lag(ts) OVER (PARTITION BY cruise, file_name ORDER BY seq) AS previous_ts
  FROM (SELECT cruise, file_name, seq, CASE WHEN seq % 7 = 0 THEN ts + INTERVAL 2 DAY ELSE ts END AS ts FROM v_fix))
WHERE previous_ts > ts""",
)
def order_violations(spark, d):
    # Every seventh fix is given a late clock.
    late = view(spark, d, "v_fix").selectExpr(
        "cruise", "file_name", "seq", "case when seq % 7 = 0 then ts + interval 2 day else ts end AS ts"
    )
    return gps.order_violations(late)


@query(
    "missing_columns",
    """
SELECT coalesce(f.cruise, p.cruise) AS cruise, coalesce(f.file_name, p.file_name) AS file_name,
  coalesce(pos, false) AS has_position, coalesce(ft, false) AS has_fix_time, coalesce(pt, false) AS has_ping_time
FROM (SELECT cruise, file_name, bool_or(latitude IS NOT NULL) AND bool_or(longitude IS NOT NULL) AS pos,
        bool_or(ts IS NOT NULL) AS ft FROM (SELECT cruise, file_name, longitude,
          CASE WHEN file_name LIKE '%3' THEN NULL ELSE latitude END AS latitude,
          CASE WHEN file_name LIKE '%7' THEN NULL ELSE ts END AS ts FROM v_fix) GROUP BY ALL) f
FULL JOIN (SELECT cruise, file_name, bool_or(ping_time IS NOT NULL) AS pt FROM v_ping GROUP BY ALL) p
  ON f.cruise = p.cruise AND f.file_name = p.file_name
WHERE NOT (coalesce(pos, false) AND coalesce(ft, false) AND coalesce(pt, false))""",
)
def missing_columns(spark, d):
    # Some files lose their positions, others their times.
    fixes = view(spark, d, "v_fix").selectExpr(
        "cruise", "file_name", "longitude",
        "case when file_name like '%3' then null else latitude end AS latitude",
        "case when file_name like '%7' then null else ts end AS ts",
    )
    return gps.missing_columns(fixes, view(spark, d, "v_ping"))


@query(
    "iso_times",
    """
SELECT ping_idx, strftime(ping_time, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso_ms,
  strftime(ping_time, '%Y-%m-%dT%H:%M:%SZ') AS iso_s,
  strftime(ping_time, '%Y-%m-%dT%H:%M:%S.%f') || '000' AS iso_ns FROM v_ping""",
)
def iso_times(spark, d):
    t = F.col("ping_time")
    return view(spark, d, "v_ping").select(
        "ping_idx",
        times.iso_millis(t).alias("iso_ms"),
        times.iso_seconds(t).alias("iso_s"),
        times.iso_nanos(t).alias("iso_ns"),
    )


@query(
    "point_geometry",
    "SELECT ping_idx, CASE WHEN latitude IS NOT NULL THEN 'Point' END AS kind, longitude AS lon, latitude AS lat FROM v_aligned",
)
def point_geometry(spark, d):
    g = F.col("geometry")
    return gps.with_geometry(_aligned(spark, d)).select(
        "ping_idx", g["type"].alias("kind"), g["coordinates"][0].alias("lon"), g["coordinates"][1].alias("lat")
    )


@query(
    "feature_collections",
    """
SELECT cruise, file_name, count(*) AS features, count(latitude) AS located,
  md5(string_agg(strftime(ping_time, '%Y-%m-%dT%H:%M:%S.%f') || '000', ',' ORDER BY ping_idx)) AS ids
FROM v_aligned GROUP BY ALL""",
)
def feature_collections(spark, d):
    """Files' documents, from their lines: no document is an array."""
    opened = F.regexp_replace(F.substring_index("line", "\n", -1), "^,", "")
    feature = F.from_json(opened, schemas.FEATURE)
    lines = gps.collection_lines(_aligned(spark, d)).filter("part = 1").withColumn("f", feature)
    # The digest of ids in ping order is for comparison only.
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ping_idx", "f.id"))), lambda x: x["id"]), ",")
    return lines.groupBy("cruise", "file_name").agg(
        F.count(F.lit(1)).alias("features"), F.count("f.geometry").alias("located"), F.md5(ids).alias("ids")
    )


@query(
    "geojson_roundtrip",
    "SELECT cruise, file_name, ping_time, latitude, longitude, epoch_us(ping_time) / 1e6 AS epoch_seconds FROM v_valid",
)
def geojson_roundtrip(spark, d):
    """Positions written as GeoJSON features and read back with their times."""
    path = scratch_path(spark, "geojson")
    geojson.write_features(_aligned(spark, d), path)
    return geojson.spatiotemporal_index(geojson.read_features(spark, path)).select(
        "cruise", "file_name", F.col("ping_time").cast("timestamp_ntz").alias("ping_time"),
        "latitude", "longitude", "epoch_seconds",
    )


@query(
    "collection_roundtrip",
    "SELECT cruise, file_name, ping_time, latitude, longitude FROM v_valid",
)
def collection_roundtrip(spark, d):
    """The same through one document per file: written as lines, joined into single files, and read back."""
    path, target = scratch_path(spark, "collections"), scratch_path(spark, "documents")
    geojson.write_collections(_aligned(spark, d), path)
    documents = geojson.export_documents(spark, path, target)
    back = geojson.read_collections(spark, f"{target}/*/*/geo.json").withColumn("path", F.input_file_name())
    named = back.select(
        F.element_at(F.split("path", "/"), -3).alias("cruise"), F.element_at(F.split("path", "/"), -2).alias("file_name"),
        "id", "latitude", "longitude", "geometry",
    ).join(documents.select("cruise", "file_name"), ["cruise", "file_name"], "left_semi")
    return geojson.spatiotemporal_index(named).select(
        "cruise", "file_name", F.col("ping_time").cast("timestamp_ntz").alias("ping_time"), "latitude", "longitude"
    )
