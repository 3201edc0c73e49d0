"""Chunked windows give what plain windows give, for any cut."""

import random

import pytest
from pyspark.sql import functions as F

from fathomgrid.operators import gps, grid, tracks
from fathomgrid.operators.ordered import (
    Layout,
    last_seen,
    measure,
    previous,
    running_sum,
    scan,
)


def columns():
    return [
        last_seen("last", F.col("v")),
        previous("prev", F.col("v")),
        running_sum("total", F.col("n")),
    ]


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows; another key is null; values have gaps; orders tie in the first part."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 else rng.choice(["a", "b", "c", None])
        value = None if rng.random() < 0.7 else float(i)
        rows.append((key, rng.randrange(40), i, value, rng.randrange(5) or None))
    return spark.createDataFrame(rows, "k string, t long, id long, v double, n long").repartition(6)


def test_measure(spark, skewed):
    layout = measure(skewed, ["k"], limit=1500)
    assert (layout.rows, layout.largest, layout.chunked) == (3000, 2000, True)
    assert not measure(skewed, ["k"], limit=2000).chunked
    assert measure(skewed.limit(0), ["k"]).rows == 0


@pytest.mark.parametrize("limit", [90, 700])
def test_scan_chunked_equals_plain(skewed, limit):
    plain = scan(skewed, ["k"], ["t", "id"], columns(), Layout(3000, 1))
    cut = scan(skewed, ["k"], ["t", "id"], columns(), Layout(3000, 2000, limit))
    key = lambda r: r[2]
    assert sorted(map(tuple, plain.collect()), key=key) == sorted(map(tuple, cut.collect()), key=key)
    assert plain.columns == cut.columns


def test_scan_matches_python(skewed):
    got = {r["id"]: r for r in scan(skewed, ["k"], ["t", "id"], columns(), Layout(3000, 2000, 200)).collect()}
    by_key = {}
    for r in got.values():
        by_key.setdefault(r["k"], []).append(r)
    for group in by_key.values():
        last, before, total = None, None, 0
        for i, r in enumerate(sorted(group, key=lambda r: (r["t"], r["id"]))):
            last = r["v"] if r["v"] is not None else last
            total += r["n"] or 0
            assert (r["last"], r["prev"], r["total"]) == (last, before, total)
            before = r["v"]


def test_asof_chunked(spark):
    pings = spark.range(4000).selectExpr(
        "'C' AS cruise", "if(id % 3 = 0, 'small', 'hot') AS file_name", "id AS ping_idx",
        "timestamp_seconds(id * 7 % 5000) AS ping_time",
    )
    fixes = spark.range(300).selectExpr(
        "'C' AS cruise", "if(id % 5 = 0, 'small', 'hot') AS file_name", "id AS seq",
        "timestamp_seconds(id * 13 % 4900 + 20) AS ts",
        "if(id % 6 = 0, null, cast(id as double)) AS latitude", "cast(id as double) AS longitude",
    )
    plain = gps.align_fixes(pings, fixes, layout=Layout(4300, 1))
    cut = gps.align_fixes(pings, fixes, layout=Layout(4300, 3000, 400))
    order = ["cruise", "file_name", "ping_idx"]
    assert plain.orderBy(order).collect() == cut.orderBy(order).collect()


def test_tracks_chunked(spark):
    points = spark.range(3000).selectExpr(
        "if(id % 10 = 0, 'b', 'a') AS cruise", "id AS seq", "timestamp_seconds(id * 60 + floor(id / 400) * 5000) AS ts",
        "cast(floor(id / 3) % 170 as double) AS longitude", "cast(floor(id / 7) % 80 as double) AS latitude",
    )

    def chain(layout):
        split = tracks.split_tracks(points, layout=layout)
        return tracks.track_points(split, layout=layout).orderBy("seq").collect()

    assert chain(Layout(3000, 1)) == chain(Layout(3000, 2700, 500))


def test_slices_chunked(spark):
    files = spark.range(2000).selectExpr(
        "if(id % 4 = 0, 'b', 'a') AS cruise", "concat('F', lpad(cast(id as string), 6, '0')) AS file_name",
        "concat('2007-01-0', cast(id % 9 as string)) AS start_time", "id % 6 AS num_ping_time_dropna",
    )
    plain = grid.file_slices(files, Layout(2000, 1)).orderBy("file_name").collect()
    assert plain == grid.file_slices(files, Layout(2000, 1500, 300)).orderBy("file_name").collect()
