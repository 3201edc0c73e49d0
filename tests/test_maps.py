"""Tracklines, simplification, tiles and geohash cells."""

import datetime as dt
import math
import random

import numpy as np
from pyspark.sql import functions as F

from fathomgrid.functions import geo
from fathomgrid.operators import tiles, tracks
from fathomgrid.plans import map_job

T0 = dt.datetime(2020, 1, 1)


def track(spark, rows):
    """rows: cruise, seconds, lon, lat"""
    return spark.createDataFrame(
        [(c, i, T0 + dt.timedelta(seconds=s), lon, lat) for i, (c, s, lon, lat) in enumerate(rows)],
        "cruise string, seq long, ts timestamp, longitude double, latitude double",
    )


def test_split_at_exactly_the_gap(spark):
    points = track(spark, [("a", s, 0.0, 0.0) for s in (0, 899, 1799, 2698.999, 3599)])
    got = [r["segment"] for r in tracks.split_tracks(points).orderBy("seq").collect()]
    assert got == [0, 0, 1, 1, 2]


def test_repeats_are_dropped_within_a_segment(spark):
    rows = [("a", 0, 1.000001, 1.0), ("a", 1, 1.000002, 1.0), ("a", 2, 1.1, 1.0), ("a", 3, 1.0, 1.0), ("a", 2000, 1.0, 1.0),
            ("a", 2001, None, 1.0), ("a", 2002, 1.0, 1.0)]
    points = tracks.track_points(tracks.split_tracks(track(spark, rows)))
    got = sorted((r["segment"], r["point_idx"], r["longitude"]) for r in points.collect())
    assert got == [(0, 0, 1.0), (0, 1, 1.1), (0, 2, 1.0), (1, 0, 1.0)]


def lines_of(spark, rows):
    return tracks.track_points(tracks.split_tracks(track(spark, rows)))


def test_a_line_is_whole_at_any_length(spark):
    for n in (1, 2, 500):
        lines = tracks.line_strings(lines_of(spark, [("a", i, i / 10, 0.0) for i in range(n)])).collect()
        assert [[p["lon"] for p in r["points"]] for r in lines] == [[i / 10 for i in range(n)]]


def test_antimeridian_cuts_a_segment(spark):
    rows = [("a", 0, 179.0, 0.0), ("a", 60, 179.9, 1.0), ("a", 120, -179.9, 2.0), ("a", 180, 179.5, 3.0),
            ("b", 0, 180.0, 5.0), ("b", 60, -170.0, 6.0), ("c", 0, -179.0, 0.0), ("c", 60, -180.0, 1.0), ("c", 120, 180.0, 1.0)]
    got = {}
    for r in lines_of(spark, rows).orderBy("cruise", "side", "point_idx").collect():
        got.setdefault((r["cruise"], r["side"]), []).append((r["longitude"], round(r["latitude"], 5)))
    assert got == {
        ("a", 0): [(179.0, 0.0), (179.9, 1.0), (180.0, 1.5)],
        ("a", 1): [(-180.0, 1.5), (-179.9, 2.0), (-180.0, 2.16667)],
        ("a", 2): [(180.0, 2.16667), (179.5, 3.0)],
        ("b", 0): [(180.0, 5.0)],
        ("b", 1): [(-180.0, 5.0), (-170.0, 6.0)],
        ("c", 0): [(-179.0, 0.0), (-180.0, 1.0)],
        ("c", 1): [(180.0, 1.0)],
    }


def recursive(xs, ys, tolerance):
    """Textbook line simplification by recursion."""
    if len(xs) < 3:
        return list(range(len(xs)))
    best, far = -1.0, 0
    dx, dy = xs[-1] - xs[0], ys[-1] - ys[0]
    for i in range(1, len(xs) - 1):
        px, py = xs[i] - xs[0], ys[i] - ys[0]
        t = 0.0 if dx == dy == 0 else max(0.0, min(1.0, (px * dx + py * dy) / (dx * dx + dy * dy)))
        away = math.sqrt((px - t * dx) ** 2 + (py - t * dy) ** 2)
        if away > best:
            best, far = away, i
    if best <= tolerance:
        return [0, len(xs) - 1]
    left = recursive(xs[: far + 1], ys[: far + 1], tolerance)
    right = recursive(xs[far:], ys[far:], tolerance)
    return left[:-1] + [far + i for i in right]


def test_importance_answers_every_tolerance():
    rng = random.Random(11)
    for _ in range(60):
        n = rng.randrange(1, 60)
        xs = np.cumsum([rng.uniform(-0.2, 1) for _ in range(n)])
        ys = np.cumsum([rng.uniform(-1, 1) for _ in range(n)])
        kept = tracks.point_importance(xs, ys)
        for tolerance in (0.0, 0.05, 0.3, 2.0):
            assert [i for i in range(n) if kept[i] > tolerance] == recursive(list(xs), list(ys), tolerance)


def test_simplify_in_spark(spark):
    rng = random.Random(2)
    rows = [("a", i, rng.uniform(0, 5), rng.uniform(0, 5)) for i in range(40)]
    weighed = tracks.with_importance(lines_of(spark, rows))
    got = [(r["longitude"], r["latitude"]) for r in tracks.simplify(weighed, 1.0).orderBy("point_idx").collect()]
    xs, ys = [round(r[2], 5) for r in rows], [round(r[3], 5) for r in rows]
    assert got == [(xs[i], ys[i]) for i in recursive(xs, ys, 1.0)]
    by_zoom = {r["z"]: r["count"] for r in tracks.simplify_by_zoom(weighed, 3, 0.1, 3.0).groupBy("z").count().collect()}
    assert list(sorted(by_zoom)) == [0, 1, 2, 3] and by_zoom[0] <= by_zoom[1] <= by_zoom[2] <= by_zoom[3]


def test_importance_does_not_depend_on_the_span_a_task_takes(spark):
    rng = random.Random(5)
    rows = [(c, i, rng.uniform(0, 5) + i / 9, rng.uniform(0, 3)) for c in "ab" for i in range(150)]
    points = lines_of(spark, rows).persist()
    shown = lambda df: sorted((r["cruise"], r["point_idx"], r["importance"]) for r in df.collect())
    whole = shown(tracks.with_importance(points))
    assert whole == shown(tracks.with_importance(points, span_points=20)) == shown(tracks.with_importance(points, span_points=1))
    xs, ys = [round(r[2], 5) for r in rows[:150]], [round(r[3], 5) for r in rows[:150]]
    assert [i for c, _, i in whole if c == "a"] == list(tracks.point_importance(np.array(xs), np.array(ys)))


def test_tolerances():
    assert tracks.tolerance_at(0) == 0.1
    assert math.isclose(tracks.tolerance_at(7), 0.001)
    assert math.isclose(tracks.tolerance_at(1, 2), 0.01)


def test_tile_edges(spark):
    rows = [(0.0, 90.0), (180.0, -90.0), (-180.0, 0.0), (179.999, 85.06), (-77.03, 38.9)]
    df = spark.createDataFrame(rows, "longitude double, latitude double")
    got = {(r["longitude"], r["z"]): (r["x"], r["y"]) for r in tiles.tile_points(df, 3).collect()}
    assert got[(0.0, 3)] == (4, 0)
    assert got[(180.0, 3)] == (7, 7)
    assert got[(-180.0, 3)] == (0, 4)
    assert got[(179.999, 0)] == (0, 0) and got[(179.999, 3)] == (7, 0)
    assert got[(-77.03, 3)] == (2, 3)


def stretches(rows, z):
    """(x, y) and longitudes of the stretches of one zoom level, in the order of the line."""
    found = sorted((r for r in rows if r["z"] == z), key=lambda r: (r["segment"], r["side"], r["from_idx"], r["start"]))
    return [((r["x"], r["y"]), r["part"], round(r["start_lon"], 6), round(r["stop_lon"], 6)) for r in found]


def test_an_edge_is_in_every_tile_it_crosses(spark):
    rows = tiles.tile_lines(lines_of(spark, [("a", 0, -60.0, 10.0), ("a", 60, 60.0, 10.0)]), 4).collect()
    assert [x for (x, _), *_ in stretches(rows, 4)] == [5, 6, 7, 8, 9, 10]
    assert [(s[2], s[3]) for s in stretches(rows, 4)] == [(-60.0, -45.0), (-45.0, -22.5), (-22.5, 0.0), (0.0, 22.5), (22.5, 45.0), (45.0, 60.0)]
    assert stretches(rows, 0) == [((0, 0), 0, -60.0, 60.0)]


def test_a_line_that_comes_back_has_two_parts(spark):
    rows = tiles.tile_lines(lines_of(spark, [("a", 0, -10.0, 10.0), ("a", 60, 10.0, 10.0), ("a", 120, -20.0, 10.0)]), 1).collect()
    assert stretches(rows, 1) == [
        ((0, 0), 0, -10.0, 0.0), ((1, 0), 1, 0.0, 10.0), ((1, 0), 1, 10.0, 0.0), ((0, 0), 2, 0.0, -20.0)
    ]


def test_a_lone_point_keeps_its_tile(spark):
    rows = tiles.tile_lines(tracks.with_importance(lines_of(spark, [("a", 0, 5.0, 5.0)])), [0.1, 0.01]).collect()
    assert [(r["z"], r["x"], r["y"], r["start_lon"], r["stop_lat"]) for r in sorted(rows, key=lambda r: r["z"])] == [
        (0, 0, 0, 5.0, 5.0), (1, 1, 0, 5.0, 5.0)
    ]


def test_stretches_cover_every_edge(spark):
    rng = random.Random(8)
    lines = lines_of(spark, [("a", i, rng.uniform(-170, 170), rng.uniform(-80, 80)) for i in range(30)])
    rows = tiles.tile_lines(lines, 5).collect()
    for z in range(6):
        edges = {}
        for r in rows:
            if r["z"] == z:
                edges.setdefault((r["side"], r["from_idx"]), []).append(r)
        for parts in edges.values():
            parts.sort(key=lambda r: r["start"])
            assert parts[0]["start"] == 0 and parts[-1]["stop"] == 1
            for a, b in zip(parts, parts[1:]):
                assert a["stop"] == b["start"] and abs(a["x"] - b["x"]) <= 1 and abs(a["y"] - b["y"]) <= 1
                assert (a["x"], a["y"]) != (b["x"], b["y"])


def test_merge_and_replacement(spark):
    rows = tiles.tile_lines(lines_of(spark, [(f"c{i % 7}", i, i / 3 - 50, i / 5) for i in range(210)]), 3)
    merged = tiles.merge_tiles(rows)
    key = lambda r: tuple(r[c] for c in (*tiles.TILE_KEY, *tracks.LINE, "part", *tiles.ORDER))
    got = [key(r) for r in merged.collect()]
    assert got == sorted(key(r) for r in rows.collect())
    fresh = rows.filter("cruise = 'c1' and z = 0")
    again = tiles.replace_cruises(rows, fresh)
    assert again.filter("cruise = 'c1'").count() == fresh.count()
    assert again.count() == rows.filter("cruise <> 'c1'").count() + fresh.count()
    # A published cruise without tiles of its own loses the earlier ones.
    gone = tiles.replace_cruises(rows, rows.filter("false"), spark.createDataFrame([("c2",)], "cruise string"))
    assert gone.filter("cruise = 'c2'").count() == 0 and gone.filter("cruise = 'c3'").count() > 0


def encode(lat, lon, n):
    """Geohash by repeated halving."""
    box = [[-180.0, 180.0], [-90.0, 90.0]]
    bits = ""
    for i in range(5 * n):
        value, side = (lon, 0) if i % 2 == 0 else (lat, 1)
        mid = sum(box[side]) / 2
        bits += "1" if value >= mid else "0"
        box[side][0 if value >= mid else 1] = mid
    return "".join(geo.GEOHASH_ALPHABET[int(bits[i : i + 5], 2)] for i in range(0, 5 * n, 5))


def test_geohash_vectors(spark):
    rng = random.Random(9)
    places = [(42.605, -5.603), (57.64911, 10.40744), (90.0, 180.0), (-90.0, -180.0), (0.0, 0.0)]
    places += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(200)]
    df = spark.createDataFrame(places, "lat double, lon double")
    for n in (1, 5, 6, 7, 12):
        for r in df.select("lat", "lon", geo.geohash(F.col("lat"), F.col("lon"), n).alias("g")).collect():
            lat, lon = min(r["lat"], 89.9999999999), min(r["lon"], 179.9999999999)
            assert r["g"] == encode(lat, lon, n)
    known = df.select(geo.geohash(F.col("lat"), F.col("lon"), 7)).head(2)
    assert known[0][0].startswith("ezs42") and known[1][0] == "u4pruyd"


def test_map_stage(spark):
    rng = random.Random(4)
    rows = [(c, i * 60 + (i // 50) * 3600, -70 + i * 0.05 + rng.uniform(0, 0.1), 40 + rng.uniform(0, 0.5)) for c in "ab" for i in range(120)]
    stage = map_job.map_stage(track(spark, rows))
    assert stage.points.select(*tracks.LINE).distinct().count() == 6
    assert stage.cells.agg(F.sum("ping_count")).first()[0] == 240
    merged = map_job.publish(stage)
    assert merged.filter("z = 0").select(*tracks.LINE).distinct().count() == 6
    ends = merged.groupBy("z").agg(F.count_distinct(*tracks.LINE, "to_idx").alias("n")).orderBy("z").collect()
    assert ends[0]["n"] < ends[-1]["n"] <= 240


def test_publishing_touches_its_own_folders_only(spark, tmp_path):
    """Other cruises' folders keep their files; a cruise that leaves a folder leaves no row and no empty folder."""
    import glob
    import os

    from fathomgrid.sources import tables

    path = str(tmp_path / "tiles")
    rows = spark.range(3000).selectExpr(
        "concat('C', cast(id % 30 as string)) AS cruise", "0L AS segment", "0L AS side", "cast(id % 5 as int) AS z",
        "cast(id % 7 as bigint) % shiftleft(1L, cast(id % 5 as int)) AS x", "0L AS y", "0L AS part", "id AS from_idx",
    )
    assert tables.publish_tiles(spark, path, rows) > 20
    stamp = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/rows/**/part-*", recursive=True)}
    before = stamp()
    noted = spark.read.parquet(f"{path}/where").filter("cruise in ('C3', 'C4')").select(*tables.TILE_FOLDERS).distinct()
    own = {f"/z={r[0]}/x_range={r[1]}/cruise_part={r[2]}/" for r in noted.collect()}
    fresh = rows.filter("cruise = 'C3' and z = 4").withColumn("part", F.lit(9).cast("long"))
    published = spark.createDataFrame([("C3",), ("C4",)], "cruise string")
    assert tables.publish_tiles(spark, path, fresh, published) == len(own)
    after = stamp()
    inside = lambda f: any(o in f for o in own)
    assert {f: t for f, t in before.items() if not inside(f)} == {f: t for f, t in after.items() if not inside(f)}
    got = sorted(map(tuple, tables.read_tiles(spark, path).select(*rows.columns).collect()))
    want = rows.filter("cruise not in ('C3', 'C4')").unionByName(fresh)
    assert got == sorted(map(tuple, want.collect()))
    # A second publication of the same changes nothing but its own files.
    tables.publish_tiles(spark, path, fresh, published)
    assert sorted(map(tuple, tables.read_tiles(spark, path).select(*rows.columns).collect())) == got
    assert tables.publish_tiles(spark, path, fresh.filter("false"), spark.createDataFrame([("none",)], "cruise string")) == 0
