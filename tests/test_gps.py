"""As-of alignment and checks against hand-built series."""

import bisect
import datetime as dt
import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from fathomgrid.operators import gps
from fathomgrid.session import LISTING_TASKS
from fathomgrid.sources import folders, geojson

T0 = dt.datetime(2007, 7, 11, 18, 0, 0)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def pings(spark, rows):
    return spark.createDataFrame(
        [("C", f, i, at(s)) for f, i, s in rows], "cruise string, file_name string, ping_idx long, ping_time timestamp"
    )


def fixes(spark, rows):
    return spark.createDataFrame(
        [("C", f, q, at(s), lat, lon) for f, q, s, lat, lon in rows],
        "cruise string, file_name string, seq long, ts timestamp, latitude double, longitude double",
    )


def test_alignment_edges(spark):
    got = gps.align_fixes(
        pings(spark, [("a", 0, 0), ("a", 1, 10), ("a", 2, 15), ("a", 3, 20), ("a", 4, 25), ("b", 0, 5)]),
        fixes(
            spark,
            [("a", 0, 10, 1.0, 2.0), ("a", 1, 10, 3.0, 4.0), ("a", 2, 18, None, None), ("a", 3, 25, 5.0, 6.0)],
        ),
    )
    rows = {(r["file_name"], r["ping_idx"]): (r["latitude"], r["longitude"]) for r in got.collect()}
    assert rows == {
        ("a", 0): (None, None),  # before the first fix
        ("a", 1): (3.0, 4.0),  # equal time: matched, highest seq
        ("a", 2): (3.0, 4.0),
        ("a", 3): (None, None),  # a fix without position is not skipped
        ("a", 4): (5.0, 6.0),
        ("b", 0): (None, None),  # no fixes at all
    }


def test_alignment_random(spark):
    rng = random.Random(5)
    f = [(name, i, rng.randrange(500), float(i), -float(i)) for name in "abc" for i in range(80)]
    p = [(name, i, rng.randrange(-20, 520)) for name in "abc" for i in range(200)]
    got = gps.align_fixes(pings(spark, p), fixes(spark, f)).collect()
    for r in got:
        mine = sorted((x[2], x[1], x[3]) for x in f if x[0] == r["file_name"])
        second = (r["ping_time"] - T0).total_seconds()
        place = bisect.bisect_right([m[0] for m in mine], second) - 1
        assert r["latitude"] == (mine[place][2] if place >= 0 else None)
    assert len(got) == 600


def test_alignment_shuffles_once(spark):
    p = pings(spark, [("a", 0, 0)])
    df = gps.align_fixes(p, fixes(spark, [("a", 0, 10, 1.0, 2.0)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_checks(spark):
    f = fixes(
        spark,
        [("a", 0, 0, 91.0, 0.0), ("a", 1, 5, 10.0, 181.0), ("a", 2, 5, 10.0, 0.0), ("a", 3, 4, None, None), ("b", 0, 0, None, None)],
    )
    assert sorted(r["seq"] for r in gps.bounds_violations(f).collect()) == [0, 1]
    assert [(r["file_name"], r["seq"]) for r in gps.order_violations(f).collect()] == [("a", 3)]
    missing = {r["file_name"]: (r["has_position"], r["has_fix_time"], r["has_ping_time"])
               for r in gps.missing_columns(f, pings(spark, [("a", 0, 1), ("c", 0, 1)])).collect()}
    assert missing == {"b": (False, True, False), "c": (False, False, True)}


def test_nan_counts_as_missing(spark):
    clean = gps.fixes_without_nan(fixes(spark, [("a", 0, 0, float("nan"), 1.0)])).first()
    assert clean["latitude"] is None and clean["longitude"] == 1.0


def test_first_ping_wins_on_equal_times(spark):
    p = pings(spark, [("a", 3, 1), ("a", 4, 1), ("a", 5, 2)])
    wanted = p.select("cruise", "file_name", "ping_time").distinct()
    assert sorted(r["ping_idx"] for r in gps.match_times(wanted, p).collect()) == [3, 5]


def test_geojson_documents(spark, tmp_path):
    aligned = gps.align_fixes(
        pings(spark, [("a", i, i) for i in range(5)]), fixes(spark, [("a", 0, 2, 40.5, -70.25)])
    )
    path = str(tmp_path / "geo")
    geojson.write_collections(aligned, path)
    documents = [json.loads(r["value"]) for r in spark.read.text(path, wholetext=True).collect()]
    assert [len(d["features"]) for d in documents] == [5]
    assert [f["id"] for f in documents[0]["features"]] == sorted(f["id"] for f in documents[0]["features"])
    feature = next(f for d in documents for f in d["features"] if f["id"] == "2007-07-11T18:00:00.000000000")
    assert feature == {
        "id": "2007-07-11T18:00:00.000000000", "type": "Feature",
        "properties": {"latitude": None, "longitude": None}, "geometry": None,
    }
    back = geojson.spatiotemporal_index(geojson.read_collections(spark, path))
    rows = {r["ping_time"]: r for r in back.collect()}
    assert sorted(rows) == [at(2), at(3), at(4)]
    assert rows[at(3)]["geometry"]["coordinates"] == [-70.25, 40.5]
    assert rows[at(3)]["epoch_seconds"] == 1184176803.0
    lines = str(tmp_path / "features")
    geojson.write_features(aligned, lines)
    assert spark.read.text(lines).count() == 5
    same = geojson.spatiotemporal_index(geojson.read_features(spark, lines)).select(*back.columns)
    assert sorted(map(str, same.collect())) == sorted(map(str, back.collect()))


def test_document_of_a_hot_file(spark, tmp_path):
    """A third of all pings in one file: its lines are many tasks' work, and one readable document."""
    n = 6000
    rows = spark.range(n).selectExpr(
        "if(id % 3 = 0, 'C1', concat('C', cast(id % 5 as string))) AS cruise",
        "if(id % 3 = 0, 'hot', concat('F', cast(id % 40 as string))) AS file_name", "id AS ping_idx",
        "timestamp_seconds(1184176800 + id) AS ping_time", "if(id % 7 = 0, null, 1.5D) AS latitude", "2.5D AS longitude",
    )
    path, target = str(tmp_path / "lines"), str(tmp_path / "documents")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        geojson.write_collections(rows.repartition(5), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    made = {r["file_name"]: r for r in geojson.export_documents(spark, path, target).collect() if r["file_name"] == "hot"}
    assert made["hot"]["parts"] > 1
    found = 0
    for name in glob.glob(f"{target}/*/*/geo.json"):
        with open(name) as f:
            document = json.load(f)
        ids = [x["id"] for x in document["features"]]
        assert document["type"] == "FeatureCollection" and ids == sorted(ids)
        found += len(ids)
        if "/hot/" in name:
            assert len(ids) == n // 3 and os.path.getsize(name) == made["hot"]["bytes"]
    assert found == n
    assert geojson.read_collections(spark, f"{target}/*/*/geo.json").count() == n
    assert geojson.read_collections(spark, path).select("cruise", "file_name").distinct().count() == len(glob.glob(f"{target}/*/*/geo.json"))
    # A file written again replaces its own document and no other.
    geojson.write_collections(rows.filter("file_name = 'hot' and ping_idx < 30"), path)
    assert geojson.read_collections(spark, path).count() == n - n // 3 + 10


def test_geojson_pretty_printed(spark, tmp_path):
    document = {
        "type": "FeatureCollection",
        "features": [
            {"id": "2007-07-12T15:24:16.032000000", "type": "Feature",
             "properties": {"latitude": None, "longitude": None}, "geometry": None},
            {"id": "2007-07-12T15:24:17.032000000", "type": "Feature", "properties": {"latitude": 1.0, "longitude": 2.0},
             "geometry": {"type": "Point", "coordinates": [2.0, 1.0]}},
        ],
    }
    (tmp_path / "geo.json").write_text(json.dumps(document, indent=2))
    rows = geojson.spatiotemporal_index(geojson.read_collections(spark, str(tmp_path / "geo.json"), True)).collect()
    assert [(r["latitude"], r["epoch_seconds"]) for r in rows] == [(1.0, 1184253857.032)]


def test_valid_ping_positions(spark):
    aligned = gps.align_fixes(
        pings(spark, [("a", i * 10, i) for i in range(6)]), fixes(spark, [("a", 0, 2, 1.0, 1.0)])
    )
    rows = gps.positions_in_file(gps.valid_pings(aligned)).orderBy("ping_idx").collect()
    assert [(r["ping_idx"], r["position"]) for r in rows] == [(20, 0), (30, 1), (40, 2), (50, 3)]
    assert gps.valid_counts(aligned).first()["num_ping_time_dropna"] == 4
    assert aligned.filter(F.col("latitude").isNull()).count() == 2


def test_many_folders_are_listed_in_few_tasks(spark, tmp_path):
    """A listing's result grows with the folders, not with a report per folder."""
    n, path, sc = 2 * LISTING_TASKS, str(tmp_path / "features"), spark.sparkContext
    aligned = spark.range(n).selectExpr(
        "'A' AS cruise", "concat('f', id) AS file_name", "id AS ping_idx",
        "timestamp_ntz '2024-01-01 00:00:00' AS ping_time", "1e0 AS latitude", "2e0 AS longitude",
    )
    geojson.write_features(aligned.coalesce(1), path)
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key, None)
    sc.setJobGroup("listing", "listing")
    try:
        features = geojson.read_features(spark, path)
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("listing")]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tasks = [sc.statusTracker().getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
    assert tasks and max(tasks) <= LISTING_TASKS
    assert features.count() == n and spark.conf.get(key, None) == before


def test_folders_are_those_of_partition_by(spark, tmp_path):
    """Folder names and lines as Spark's own writer leaves them, whatever the names are; others' folders stay."""
    names = ["f", "", None, "a/b=c d%'\"#*:?\\{[]^\x7f\t\n", "größe", "__HIVE_DEFAULT_PARTITION__"]
    rows = spark.createDataFrame(
        [(c, f, f"{c}-{n}-{i}") for c in ("A", None) for n, f in enumerate(names) for i in range(3)],
        "cruise string, file_name string, value string",
    )
    own, there = str(tmp_path / "own"), str(tmp_path / "there")
    rows.write.partitionBy(*geojson.FOLDERS).text(own)

    def write(df):
        sent = df.withColumns(folders.folder_columns(geojson.FOLDERS)).repartition(3)
        folders.write_folders(sent, geojson.FOLDERS, there, folders.TextFile, ".txt")

    write(rows.unionByName(rows))
    write(rows)
    below = lambda top: sorted(os.path.relpath(d, top) for d, _, _ in os.walk(top))
    lines = lambda top: sorted(map(tuple, spark.read.text(top).collect()), key=str)
    assert below(there) == below(own) and lines(there) == lines(own)
    assert os.path.exists(f"{there}/_SUCCESS")
    write(rows.filter("file_name = 'f' and cruise = 'A'").limit(1))
    assert spark.read.text(there).filter("file_name = 'f' and cruise = 'A'").count() == 1
    assert spark.read.text(there).count() == rows.count() - 2
    write(rows.limit(0))
    assert spark.read.text(there).count() == rows.count() - 2


def test_a_write_that_fails_changes_no_folder(spark, tmp_path):
    path = str(tmp_path / "there")
    good = spark.range(8).selectExpr("'A' AS cruise", "concat('f', id) AS file_name", "cast(id AS string) AS value")
    folders.write_folders(good, geojson.FOLDERS, path, folders.TextFile, ".txt")
    bad = good.repartition(4, "file_name").withColumn("value", F.expr("if(file_name = 'f7', raise_error('lost'), 'new')"))
    with pytest.raises(Exception, match="lost"):
        folders.write_folders(bad, geojson.FOLDERS, path, folders.TextFile, ".txt")
    assert {r["value"] for r in spark.read.text(path).collect()} == {str(i) for i in range(8)}


def test_documents_keep_the_names_of_their_files(spark, tmp_path):
    path, target = str(tmp_path / "lines"), str(tmp_path / "documents")
    aligned = spark.range(4).selectExpr(
        "'0707' AS cruise", "concat('00', id div 2) AS file_name", "id AS ping_idx",
        "timestamp_ntz '2024-01-01 00:00:00' AS ping_time", "1e0 AS latitude", "2e0 AS longitude",
    )
    geojson.write_collections(aligned, path)
    made = geojson.export_documents(spark, path, target).collect()
    assert sorted((r["cruise"], r["file_name"]) for r in made) == [("0707", "000"), ("0707", "001")]
    assert geojson.read_collections(spark, f"{target}/0707/001/geo.json").count() == 2
