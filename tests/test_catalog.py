"""Names, listing, header tags, calibration, index."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fathomgrid.functions import names
from fathomgrid.operators import catalog
from fathomgrid.plans import index_job
from fathomgrid.sources import archive


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("s"))).collect()]


def test_name_timestamp(spark):
    got = column(
        spark,
        [
            "EX1608_EK60-D20161205-T040300.raw",
            "L0005-D20040302-T200108-EK60.raw",
            "SaKe2015-D20150719-T190837.raw",
            "D20151319-T190837.raw",
            "D20150719.raw",
            "T190837-D20150719.raw",
            "notes.raw",
        ],
        names.name_timestamp,
    )
    assert got == [
        dt.datetime(2016, 12, 5, 4, 3), dt.datetime(2004, 3, 2, 20, 1, 8), dt.datetime(2015, 7, 19, 19, 8, 37),
        None, None, dt.datetime(2015, 7, 19, 19, 8, 37), None,
    ]


def test_store_names(spark):
    got = column(spark, ["D20070711-T182032.raw", "a.b.raw", "plain", ".hidden"], names.store_name)
    assert got == ["D20070711-T182032.zarr", "a.b.zarr", "plain.zarr", ".hidden.zarr"]


def test_text_flags(spark):
    marker = column(spark, ["uncalibrated", "x uncalibrated", "fine"], names.described_uncalibrated)
    assert marker == [False, True, False]
    assert column(spark, ["Calibrated w/ data", "uncalibrated"], names.states_calibrated) == [True, False]
    assert column(spark, ["HB0707_EK60_x", "HB0707"], names.dataset_cruise) == ["HB0707", "HB0707"]


def test_wanted(spark):
    keys = ["a/NOISE_D1.raw", "a/D1.raw", "NOISE/D1.raw", "a/D1.idx"]
    assert column(spark, keys, lambda k: names.wanted(k, ".raw")) == [False, True, True, False]
    assert column(spark, keys, lambda k: names.wanted(k, None)) == [False, True, True, True]


@pytest.fixture()
def raw_archive(tmp_path):
    """Two cruises; one is of the other format."""
    files = {
        "data/raw/Bigelow/HB0707/EK60/D20070711-T182032.raw": b"len\x00CON0rest",
        "data/raw/Bigelow/HB0707/EK60/D20070712-T004447.raw": b"len\x00CON0more!",
        "data/raw/Bigelow/HB0707/EK60/nested/D20070713-T004447.raw": b"len\x00CON0",
        "data/raw/Bigelow/HB1802/EK60/D20180513-T150250.raw": b"len\x00XML0",
        "data/raw/Bigelow/HB0707/EK60/readme.txt": b"EK60",
        "data/raw/Bigelow/HB0805/ME70/D20080101-T000000.raw": b"len\x00CON0",
    }
    for key, content in files.items():
        path = tmp_path / "archive" / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return str(tmp_path / "archive")


def test_listing(spark, raw_archive):
    objects = archive.list_objects(spark, raw_archive)
    assert {r["key"]: r["size"] for r in objects.collect()}["data/raw/Bigelow/HB1802/EK60/D20180513-T150250.raw"] == 8
    assert objects.count() == 6
    plan = objects._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_index_of_an_archive(spark, raw_archive, tmp_path):
    sheet = tmp_path / "sheet.csv"
    sheet.write_text("DATASET_NAME,INSTRUMENT_NAME,CAL_STATE\nHB0707_EK60,EK60,uncalibrated\n")
    rows = index_job.index_archive(spark, raw_archive, str(sheet)).collect()
    assert [r.asDict() for r in rows] == [
        {
            "cruise": "HB0707", "ship": "Bigelow", "sensor": "EK60", "datagram": "CON0", "file_count": 2,
            "total_size": 12 + 13, "calibrated": True,
            "start_date": "2007-07-11T18:20:32Z", "end_date": "2007-07-12T00:44:47Z",
        }
    ]
    index_job.run(spark, raw_archive, str(tmp_path / "no-such.csv"), str(tmp_path / "index"))
    assert [r["calibrated"] for r in spark.read.parquet(str(tmp_path / "index")).collect()] == [False]


def test_header_tag_strips_only_the_ends(spark):
    df = spark.createDataFrame([(bytearray(b"abc\x00CO\x00N"),), (bytearray(b"abcXML0\x00"),)], "content binary")
    assert [r[0] for r in df.select(names.header_tag(F.col("content"))).collect()] == ["CO\x00N", "XML0"]


def test_empty_listing_gives_empty_index(spark):
    files = catalog.raw_files(spark.createDataFrame([], "key string, size long"))
    headers = spark.createDataFrame([], "cruise string, datagram string")
    calibration = spark.createDataFrame([], "dataset_name string, instrument_name string, calibrated boolean")
    assert catalog.cruise_index(files, headers, calibration).count() == 0
    assert archive.header_tags(catalog.representatives(files), "/nowhere").count() == 0


def test_index_ignores_unparsed_dates(spark):
    files = catalog.raw_files(
        spark.createDataFrame(
            [("data/raw/S/C/EK60/x.raw", 1), ("data/raw/S/C/EK60/D20200101-T000000.raw", 2)], "key string, size long"
        )
    )
    headers = spark.createDataFrame([("C", "CON0")], "cruise string, datagram string")
    calibration = spark.createDataFrame([("D", "", True)], "dataset_name string, instrument_name string, calibrated boolean")
    row = catalog.cruise_index(files, headers, calibration).first()
    assert (row["start_date"], row["end_date"], row["file_count"]) == ("2020-01-01T00:00:00Z",) * 2 + (2,)


def test_addresses_of_stores():
    """Addresses as Spark writes them, for the stores that tasks open."""
    from fathomgrid.sources import stores

    s3 = {"endpoint": "https://s3.example.org", "region": "eu-west-1", "tls": None, "provider": None}
    assert stores.address("/a/b/") == stores.address("file:///a/b") == stores.address("file:/a/b")
    assert stores.address("dbfs:/mnt/x").folder == "/dbfs/mnt/x"
    for scheme in ("s3", "s3a", "s3n"):
        place = stores.address(f"{scheme}://bucket/data/raw/", s3)
        assert (place.kind, place.folder) == ("s3", "bucket/data/raw")
        assert place.options == {"scheme": "https", "endpoint_override": "s3.example.org", "region": "eu-west-1"}
        assert type(place.open()).__name__ == "S3FileSystem"
    plain = stores.address("s3a://b/k", {**s3, "endpoint": "http://127.0.0.1:1", "provider": "x.AnonymousAWSCredentialsProvider"})
    assert plain.options["scheme"] == "http" and plain.options["anonymous"]
    assert stores.address("hdfs://host:8020/a/b").folder == "/a/b"


def test_session_settings_reach_the_store(spark):
    from fathomgrid.sources import stores

    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.s3a.endpoint.region", "us-west-2")
    try:
        assert stores.address_in(spark, "s3a://archive/x").options["region"] == "us-west-2"
    finally:
        conf.unset("fs.s3a.endpoint.region")


def test_listing_by_tasks_is_the_listing(spark, tmp_path):
    """Keys, sizes and times as Spark's own listing gives them, at whatever level the folders are walked."""
    from fathomgrid.sources import archive

    names = ["a.raw", "S1/b.raw", "S1/C1/c.raw", "S1/C1/EK60/d.raw", "S1/C1/EK60/deep/er/e.raw", "S2/C 2/f g.raw", "S2/x.txt",
             "_skip/h.raw", "S1/.hidden/i.raw", "S1/C1/_temporary/j.raw", "S3/empty/k.txt"]
    for n, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * (n + 1))
    whole = lambda df: sorted(map(tuple, df.select("key", "size", "modified").collect()))
    want = whole(archive.list_objects(spark, str(tmp_path), "*.raw"))
    assert len(want) == 6
    for levels in (0, 1, 2, 6):
        assert whole(archive.list_by_folder(spark, str(tmp_path), "*.raw", levels)) == want
    assert archive.list_by_folder(spark, f"file:{tmp_path}/none").count() == 0
