"""Tracklines, tiles and geohash cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomgrid.functions import geo
from fathomgrid.operators import tiles, tracks
from fathomgrid.operators.ordered import measure
from fathomgrid.session import scratch_path
from fathomgrid.sources import tables
from workload.registry import ORACLES, query, sql_view
from workload.views import table, view

GAP_MS = 43_200_000
"""Half a day: positions of the event tables lie hours apart."""

sql_view(
    "v_segment",
    f"""
SELECT cruise, seq, ts, longitude, latitude, cast(sum(cut) OVER (PARTITION BY cruise ORDER BY ts, seq) AS bigint) AS segment
FROM (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY cruise ORDER BY ts, seq)
    >= {GAP_MS}000 THEN 1 ELSE 0 END AS cut FROM v_track)""",
)
# Points that moved, with the point before; a step of more than half a turn crosses the antimeridian.
sql_view(
    "v_moved",
    """
SELECT *, coalesce(abs(x - px) > 180, false) AS crossing FROM (
  SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM (
    SELECT cruise, segment, seq, ts, round(longitude, 5) AS x, round(latitude, 5) AS y FROM v_segment)
  WINDOW w AS (PARTITION BY cruise, segment ORDER BY ts, seq))
WHERE px IS NULL OR px <> x OR py <> y""",
)
sql_view(
    "v_sided",
    """
SELECT *, round(py + coalesce((border - px) / nullif(x + 360 * sign(px) - px, 0), 0) * (y - py), 5) AS height FROM (
  SELECT *, CASE WHEN crossing THEN 180e0 * sign(px) END AS border,
    cast(sum(cast(crossing AS int)) OVER (PARTITION BY cruise, segment ORDER BY ts, seq) AS bigint) AS side
  FROM v_moved)""",
)
sql_view(
    "v_point",
    """
SELECT * EXCLUDE (sub), row_number() OVER (PARTITION BY cruise, segment, side ORDER BY ts, seq, sub) - 1 AS point_idx FROM (
  SELECT cruise, segment, side, seq, ts, 2 AS sub, x AS longitude, y AS latitude FROM v_sided
  UNION ALL
  SELECT cruise, segment, side - 1, seq, ts, 0, border, height FROM v_sided WHERE crossing AND (border <> px OR height <> py)
  UNION ALL
  SELECT cruise, segment, side, seq, ts, 1, -border, height FROM v_sided WHERE crossing AND (-border <> x OR height <> y))""",
)

_TILE_X = "greatest(0, least(cast(pow(2, z) AS bigint) - 1, cast(floor((longitude + 180) / 360 * pow(2, z)) AS bigint)))"
_TILE_Y = (
    "greatest(0, least(cast(pow(2, z) AS bigint) - 1, cast(floor((1 - asinh(tan(radians("
    "greatest(-85.05112878e0, least(85.05112878e0, latitude))))) / pi()) / 2 * pow(2, z)) AS bigint)))"
)
_HIGH = (
    "(1 - asinh(tan(radians(greatest(-85.05112878e0, least(85.05112878e0, {lat}))))) / pi()) / 2 * pow(2, z)"
)
_KEY = "cruise, segment, side"


def _cut_at(a: str, b: str) -> str:
    return (
        f"list_transform(range(cast(floor(least({a}, {b})) AS bigint) + 1, cast(ceil(greatest({a}, {b})) AS bigint)), "
        f"lambda k: (k - {a}) / ({b} - {a}))"
    )


def _stretches(points: str) -> str:
    """SQL of the stretches of `points` (line, z, point_idx, longitude, latitude, n of points of the whole line)."""
    lon, lat = (
        lambda t: f"CASE WHEN {t} = 0 THEN lon0 WHEN {t} = 1 THEN lon1 ELSE lon0 + {t} * (lon1 - lon0) END",
        lambda t: f"CASE WHEN {t} = 0 THEN lat0 WHEN {t} = 1 THEN lat1 ELSE "
        f"degrees(atan(sinh(pi() * (1 - 2 * (v0 + {t} * (v1 - v0)) / pow(2, z))))) END",
    )
    ends = ", ".join(
        f"round({make(t)}, 6) AS {t}_{name}" for t in ("start", "stop") for name, make in (("lon", lon), ("lat", lat))
    )
    return f"""
SELECT {_KEY}, z, x, y, cast(sum(moved) OVER (PARTITION BY {_KEY}, z ORDER BY from_idx, start) AS bigint) AS part,
  from_idx, to_idx, round(start, 6) AS start_at, round(stop, 6) AS stop_at, {ends} FROM (
  SELECT *, CASE WHEN (x, y) <> lag((x, y)) OVER (PARTITION BY {_KEY}, z ORDER BY from_idx, start) THEN 1 ELSE 0 END AS moved FROM (
    SELECT *, greatest(0, least(cast(pow(2, z) AS bigint) - 1, cast(floor(u0 + (start + stop) / 2 * (u1 - u0)) AS bigint))) AS x,
      greatest(0, least(cast(pow(2, z) AS bigint) - 1, cast(floor(v0 + (start + stop) / 2 * (v1 - v0)) AS bigint))) AS y FROM (
      SELECT * EXCLUDE (cuts), cuts[i] AS start, cuts[i + 1] AS stop FROM (
        SELECT *, unnest(range(1, len(cuts))) AS i FROM (
          SELECT *, list_sort(list_distinct(list_concat([0e0], {_cut_at('u0', 'u1')}, {_cut_at('v0', 'v1')}, [1e0]))) AS cuts FROM (
            SELECT *, (lon0 + 180) / 360 * pow(2, z) AS u0, {_HIGH.format(lat='lat0')} AS v0,
              (lon1 + 180) / 360 * pow(2, z) AS u1, {_HIGH.format(lat='lat1')} AS v1 FROM (
              SELECT {_KEY}, z, n, coalesce(lag(point_idx) OVER w, point_idx) AS from_idx, point_idx AS to_idx,
                coalesce(lag(longitude) OVER w, longitude) AS lon0, coalesce(lag(latitude) OVER w, latitude) AS lat0,
                longitude AS lon1, latitude AS lat1, lag(point_idx) OVER w IS NULL AS is_first
              FROM ({points}) WINDOW w AS (PARTITION BY {_KEY}, z ORDER BY point_idx))
            WHERE NOT is_first OR n = 1))))))"""


sql_view(
    "v_stretch",
    _stretches(
        f"SELECT *, cast(unnest(range(0, {tracks.MAX_ZOOM + 1})) AS int) AS z FROM "
        f"(SELECT *, count(*) OVER (PARTITION BY {_KEY}) AS n FROM v_point)"
    ),
)
# Textbook line simplification, division by division; cap is the largest tolerance at which a point is kept.
_IMPORTANCE = f"""
placed AS MATERIALIZED (
  SELECT {_KEY}, longitude AS x, latitude AS y, point_idx AS i FROM v_point
), span AS (
  SELECT {_KEY}, 0::bigint AS a, max(i) AS b, 'inf'::double AS cap FROM placed GROUP BY ALL
  UNION ALL
  SELECT {_KEY}, unnest([a, m]) AS a, unnest([m, b]) AS b, least(cap, away) AS cap FROM (
    SELECT {_KEY}, a, b, cap, arg_max(i, (d, -i)) AS m, max(d) AS away FROM (
      SELECT *, sqrt((px - t * dx) * (px - t * dx) + (py - t * dy) * (py - t * dy)) AS d FROM (
        SELECT *, CASE WHEN dx * dx + dy * dy > 0
          THEN greatest(0e0, least(1e0, (px * dx + py * dy) / (dx * dx + dy * dy))) ELSE 0e0 END AS t FROM (
          SELECT s.*, p.i, p.x - f.x AS px, p.y - f.y AS py, l.x - f.x AS dx, l.y - f.y AS dy
          FROM span s
          JOIN placed p ON s.cruise = p.cruise AND s.segment = p.segment AND s.side = p.side AND p.i > s.a AND p.i < s.b
          JOIN placed f ON s.cruise = f.cruise AND s.segment = f.segment AND s.side = f.side AND f.i = s.a
          JOIN placed l ON s.cruise = l.cruise AND s.segment = l.segment AND s.side = l.side AND l.i = s.b)))
    GROUP BY {_KEY}, a, b, cap)
), importance AS (
  SELECT {_KEY}, i, max(cap) AS cap FROM (
    SELECT {_KEY}, a AS i, cap FROM span UNION ALL SELECT {_KEY}, b, cap FROM span)
  GROUP BY ALL
)"""


def _split(spark, d):
    return tracks.split_tracks(view(spark, d, "v_track"), GAP_MS)


def _points(spark, d):
    points = view(spark, d, "v_track")
    layout = measure(points, ["cruise"])
    return tracks.track_points(tracks.split_tracks(points, GAP_MS, layout=layout), layout=layout)


def _stored(spark, rows, name):
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _tile_rows(spark, d):
    return tiles.tile_lines(_stored(spark, _points(spark, d), "points"))


def _shown(rows):
    """Ends of stretches to six decimals: both engines' map projections differ in the last bits."""
    near = [F.round(c, 6).alias(c) for c in ("start_lon", "start_lat", "stop_lon", "stop_lat")]
    return rows.select(
        *tracks.LINE, *tiles.TILE_KEY, "part", "from_idx", "to_idx",
        F.round("start", 6).alias("start_at"), F.round("stop", 6).alias("stop_at"), *near,
    )


@query("track_split", "SELECT * FROM v_segment")
def track_split(spark, d):
    return _split(spark, d)


@query("track_points", "SELECT * FROM v_point")
def track_points(spark, d):
    return _points(spark, d)


@query(
    "coordinate_precision",
    "SELECT seq, round(longitude / 7e0, 5) AS lon, round(latitude / 7e0, 5) AS lat FROM v_track",
)
def coordinate_precision(spark, d):
    return view(spark, d, "v_track").select(
        "seq",
        geo.coordinate(F.col("longitude") / 7.0).alias("lon"),
        geo.coordinate(F.col("latitude") / 7.0).alias("lat"),
    )


@query(
    "tracklines",
    """
SELECT cruise, segment, side, count(*) AS points, min(ts) AS first_ts, max(ts) AS last_ts,
  arg_min(longitude, point_idx) AS first_lon, arg_max(latitude, point_idx) AS last_lat,
  cast(sum(cast(round(longitude * 1e5) AS bigint) * (point_idx + 1)) AS bigint) AS checksum
FROM v_point GROUP BY cruise, segment, side""",
)
def tracklines(spark, d):
    """Whole lines, one row each; the checksum weighs every longitude with its place."""
    p = F.col("points")
    places = F.transform(p, lambda q, i: F.round(q["lon"] * 1e5).cast("long") * (i + 1))
    return tracks.line_strings(_points(spark, d)).select(
        *tracks.LINE, F.size(p).cast("long").alias("points"),
        p[0]["ts"].alias("first_ts"), F.element_at(p, -1)["ts"].alias("last_ts"),
        p[0]["lon"].alias("first_lon"), F.element_at(p, -1)["lat"].alias("last_lat"),
        F.aggregate(places, F.lit(0).cast("long"), lambda acc, x: acc + x).alias("checksum"),
    )


_LEVELS = ", ".join(
    f"({z}, {tracks.tolerance_at(z, smallest=0.02, largest=0.5)!r}::double)" for z in range(tracks.MAX_ZOOM + 1)
)


@query(
    "simplified_lines",
    f"""
WITH RECURSIVE {_IMPORTANCE}
SELECT z, {_KEY}, count(*) AS points, cast(sum(i) AS bigint) AS kept
FROM importance, (VALUES {_LEVELS}) l(z, tolerance) WHERE cap > tolerance GROUP BY ALL""",
)
def simplified_lines(spark, d):
    """Number of points kept per zoom level, and the sum of their places in the line."""
    weighed = tracks.with_importance(_stored(spark, _points(spark, d), "points"))
    kept = tracks.simplify_by_zoom(weighed, smallest=0.02, largest=0.5)
    return kept.groupBy("z", *tracks.LINE).agg(
        F.count(F.lit(1)).alias("points"), F.sum("point_idx").alias("kept")
    )


@query(
    "tile_points",
    f"""
SELECT z, x, y, count(*) AS points FROM (
  SELECT z, {_TILE_X} AS x, {_TILE_Y} AS y
  FROM (SELECT longitude, latitude, cast(unnest(range(0, {tracks.MAX_ZOOM + 1})) AS int) AS z FROM v_track))
GROUP BY z, x, y""",
)
def tile_points(spark, d):
    return (
        tiles.tile_points(view(spark, d, "v_track"))
        .groupBy("z", "x", "y")
        .agg(F.count(F.lit(1)).alias("points"))
    )


_STRETCH = f"{_KEY}, z, x, y, part, from_idx, to_idx, start_at, stop_at, start_lon, start_lat, stop_lon, stop_lat"


@query("tile_lines", f"SELECT {_STRETCH} FROM v_stretch")
def tile_lines(spark, d):
    """Every edge of every line in every tile it crosses."""
    return _shown(_tile_rows(spark, d))


_PRODUCTION = ", ".join(f"({z}, {t!r}::double)" for z, t in enumerate(tracks.tolerances()))
_KEPT = f"""
SELECT {_KEY}, z, i AS point_idx, x AS longitude, y AS latitude, n FROM (
  SELECT p.*, c.cap, count(*) OVER (PARTITION BY p.cruise, p.segment, p.side) AS n FROM placed p
  JOIN importance c ON p.cruise = c.cruise AND p.segment = c.segment AND p.side = c.side AND p.i = c.i)
JOIN (VALUES {_PRODUCTION}) l(z, tolerance) ON cap > tolerance"""


@query("tile_merge", f"WITH RECURSIVE {_IMPORTANCE} SELECT {_STRETCH} FROM ({_stretches(_KEPT)})")
def tile_merge(spark, d):
    """The published tiles: simplified per zoom level, half of the cruises taken from an earlier run."""
    points = _stored(spark, _points(spark, d), "points")
    weighed = _stored(spark, tracks.with_importance(points), "weighed")
    stage = tiles.tile_lines(weighed, tracks.tolerances())
    rows = _stored(spark, stage, "tiles")
    earlier = rows.withColumn("part", F.when(F.col("cruise").endswith("1"), -1).otherwise(F.col("part")))
    fresh = rows.filter(F.col("cruise").endswith("1"))
    return _shown(tiles.merge_tiles(tiles.replace_cruises(earlier, fresh)))


_SUMMARY = """
SELECT z, x, y, count(DISTINCT cruise) AS cruises, count(DISTINCT (cruise, segment, side, part)) AS parts, count(*) AS stretches"""


@query(
    "tile_replacement",
    f"""
{_SUMMARY} FROM (
  SELECT * FROM v_stretch WHERE cruise NOT IN
    (SELECT 'C' || cast(c_custkey AS string) FROM customer WHERE c_mktsegment = 'BUILDING')
  UNION ALL
  SELECT * FROM v_stretch WHERE segment = 0 AND cruise IN
    (SELECT 'C' || cast(c_custkey AS string) FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 3 > 0))
GROUP BY z, x, y""",
)
def tile_replacement(spark, d):
    """Cruises of one market segment are published again, with their first segment only; some have none."""
    rows, fresh, again = _republished(spark, d)
    return tiles.tile_summary(tiles.replace_cruises(rows, fresh, again))


ORACLES["tile_publish"] = ORACLES["tile_replacement"]


@query("tile_publish")
def tile_publish(spark, d):
    """The same in a store of tiles: what the republished cruises touch is written again, the rest stays as it is."""
    rows, fresh, again = _republished(spark, d)
    path = scratch_path(spark, "tile-store")
    tables.publish_tiles(spark, path, rows)
    tables.publish_tiles(spark, path, fresh, again)
    return tiles.tile_summary(tables.read_tiles(spark, path))


def _republished(spark, d):
    rows = _stored(spark, _tile_rows(spark, d), "tiles")
    again = (
        table(spark, d, "customer")
        .filter("c_mktsegment = 'BUILDING'")
        .selectExpr("'C' || cast(c_custkey as string) AS cruise", "c_custkey % 3 > 0 AS has_tiles")
    )
    fresh = rows.filter("segment = 0").join(again.filter("has_tiles"), "cruise", "left_semi").select(*rows.columns)
    return rows, fresh, again


@query(
    "geohash_cells",
    """
SELECT array_to_string(list_transform(range(0, 5), lambda k: substr('0123456789bcdefghjkmnpqrstuvwxyz', 1 + cast(list_sum(
    list_transform(range(k * 5, k * 5 + 5), lambda b:
      (((CASE WHEN b % 2 = 0 THEN lon_cell >> (12 - b // 2) ELSE lat_cell >> (11 - b // 2) END) & 1) << (4 - b % 5)))) AS int), 1)), '')
    AS geohash, cruise, count(*) AS ping_count, min(ts) AS first_ts, max(ts) AS last_ts
FROM (SELECT cruise, ts, cast(floor((longitude + 180) / 360 * 8192) AS bigint) AS lon_cell,
  cast(floor((latitude + 90) / 180 * 4096) AS bigint) AS lat_cell FROM v_track)
GROUP BY 1, 2""",
)
def geohash_cells(spark, d):
    return tiles.geohash_cells(view(spark, d, "v_track"))
