"""Archive listing and cruise index."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomgrid.operators import catalog
from fathomgrid.session import scratch_path
from fathomgrid.sources import archive, tables
from workload.registry import query, sql_view
from workload.views import shared, table, view

sql_view("v_cruise", "SELECT DISTINCT 'CR' || lpad(cast(o_custkey % 40 as string), 2, '0') AS cruise FROM orders")
sql_view("v_selected", "SELECT key, size FROM v_keys WHERE contains(key, 'EK60')")
sql_view(
    "v_file",
    r"""
SELECT key, filename, ship, cruise, sensor, size,
  CASE WHEN d <> '' AND t <> '' THEN try_strptime(d || t, '%Y%m%d%H%M%S') END AS start_ts
FROM (
  SELECT key, p[6] AS filename, p[3] AS ship, p[4] AS cruise, p[5] AS sensor, size,
    regexp_extract(p[6], 'D(\d{8})', 1) AS d, regexp_extract(p[6], 'T(\d{6})', 1) AS t
  FROM (SELECT key, size, string_split(key, '/') AS p FROM v_selected)
  WHERE len(p) = 6 AND p[6] LIKE '%.raw'
)""",
)
sql_view(
    "v_header",
    "SELECT cruise, CASE WHEN cast(substr(cruise, 3) AS int) % 4 = 0 THEN 'XML0' ELSE 'CON0' END "
    "AS datagram FROM v_cruise",
)
# Suppliers stand for entries of the sheet; their nations name 25 of the 40 cruises.
shared(
    "v_sheet",
    "supplier",
    {
        "DATASET_NAME": "'CR' || lpad(cast(s_nationkey as string), 2, '0') || "
        "case when s_suppkey % 2 = 0 then '_EK60' else '_EK60_2' end",
        "INSTRUMENT_NAME": "s_name",
        "CAL_STATE": "case s_suppkey % 4 when 0 then 'Calibrated w/ calibration data' "
        "when 1 then 'Calibrated w/o calibration data' else 'uncalibrated' end",
    },
)
sql_view(
    "v_calibration",
    "SELECT split_part(DATASET_NAME, '_EK60', 1) AS dataset_name, INSTRUMENT_NAME AS instrument_name, "
    "contains(CAL_STATE, 'Calibrated') AS calibrated FROM v_sheet",
)
sql_view("v_con_file", "SELECT f.*, h.datagram FROM v_file f JOIN v_header h USING (cruise) WHERE datagram = 'CON0'")
sql_view(
    "v_index",
    """
SELECT cruise, min(ship) AS ship, min(sensor) AS sensor, min(datagram) AS datagram,
  count(*) AS file_count, cast(sum(size) AS bigint) AS total_size,
  cruise IN (SELECT dataset_name FROM v_calibration) AS calibrated,
  strftime(min(start_ts), '%Y-%m-%dT%H:%M:%SZ') AS start_date,
  strftime(max(start_ts), '%Y-%m-%dT%H:%M:%SZ') AS end_date
FROM v_con_file GROUP BY cruise""",
)


def _files(spark, d):
    return catalog.raw_files(catalog.select_keys(view(spark, d, "v_keys")))


def _cruises(spark, d):
    cruise = "'CR' || lpad(cast(o_custkey % 40 as string), 2, '0') AS cruise"
    return table(spark, d, "orders").selectExpr(cruise).distinct()


def _headers(spark, d):
    number = F.substring("cruise", 3, 9).cast("int")
    return _cruises(spark, d).withColumn("datagram", F.when(number % 4 == 0, "XML0").otherwise("CON0"))


def _sheet(spark, d):
    return view(spark, d, "v_sheet")


def _ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("key_filter", "SELECT * FROM v_selected")
def key_filter(spark, d):
    return catalog.select_keys(view(spark, d, "v_keys"))


@query(
    "suffix_scan",
    "SELECT key, size FROM v_keys WHERE key LIKE '%.raw' AND string_split(key, '/')[-1] NOT LIKE 'NOISE%'",
)
def suffix_scan(spark, d):
    return catalog.select_suffix(view(spark, d, "v_keys"), ".raw")


@query(
    "prefix_scan",
    "SELECT key, size FROM v_keys WHERE key LIKE 'data/raw/Ship\\_2/%' ESCAPE '\\' "
    "AND string_split(key, '/')[-1] NOT LIKE 'NOISE%'",
)
def prefix_scan(spark, d):
    return catalog.select_suffix(view(spark, d, "v_keys"), None, "data/raw/Ship_2/")


@query("raw_file_parts", "SELECT * FROM v_file")
def raw_file_parts(spark, d):
    return _ntz(_files(spark, d), "start_ts")


@query(
    "file_stage_parts",
    r"""
SELECT key, p[-4] AS ship, p[-3] AS cruise, p[-2] AS sensor, p[-1] AS file_name,
  regexp_replace(p[-1], '\.[^.]*$', '') || '.zarr' AS store_name,
  'level_1/' || p[-4] || '/' || p[-3] || '/' || p[-2] || '/'
    || regexp_replace(p[-1], '\.[^.]*$', '') || '.zarr' AS zarr_path
FROM (SELECT key, string_split(key, '/') AS p FROM v_keys)""",
)
def file_stage_parts(spark, d):
    return catalog.file_stage_parts(view(spark, d, "v_keys"))


# A second archive: one listing per source, each read once.
shared(
    "v_other_keys",
    "part",
    {
        "key": "'data/raw/Ship_' || cast(p_partkey % 7 as string) || '/PT' || cast(p_size as string) || '/EK60/D'"
        " || cast(20100101 + p_partkey % 28 as string) || '-T010203.raw'",
        "size": "cast(p_partkey * 17 as bigint)",
    },
)


@query("union_listings", "SELECT key, size FROM v_keys UNION ALL SELECT key, size FROM v_other_keys")
def union_listings(spark, d):
    return catalog.union_all(view(spark, d, "v_keys"), view(spark, d, "v_other_keys"))


@query("distinct_cruises", "SELECT DISTINCT cruise FROM v_file ORDER BY cruise")
def distinct_cruises(spark, d):
    return catalog.cruise_names(_files(spark, d))


@query("distinct_datasets", "SELECT DISTINCT dataset_name FROM v_calibration")
def distinct_datasets(spark, d):
    return catalog.dataset_names(catalog.calibration_entries(_sheet(spark, d)))


@query("representative_keys", "SELECT cruise, min(key) AS key FROM v_file GROUP BY cruise")
def representative_keys(spark, d):
    return catalog.representatives(_files(spark, d))


@query("datagram_propagation", "SELECT key, cruise, datagram FROM v_con_file")
def datagram_propagation(spark, d):
    return catalog.with_datagram(_files(spark, d), _headers(spark, d)).select("key", "cruise", "datagram")


@query("calibration_entries", "SELECT * FROM v_calibration")
def calibration_entries(spark, d):
    return catalog.calibration_entries(_sheet(spark, d))


@query(
    "calibrated_membership",
    """
SELECT c.cruise, k.cal_state, k.cruise IS NOT NULL AS calibrated
FROM (SELECT DISTINCT cruise FROM v_file) c
LEFT JOIN (SELECT dataset_name AS cruise, bool_or(calibrated) AS cal_state FROM v_calibration GROUP BY 1) k
  ON c.cruise = k.cruise""",
)
def calibrated_membership(spark, d):
    cruises = _files(spark, d).select("cruise").distinct()
    return catalog.with_calibrated(cruises, catalog.calibration_entries(_sheet(spark, d)))


def _index(spark, d):
    return catalog.cruise_index(
        _files(spark, d), _headers(spark, d), catalog.calibration_entries(_sheet(spark, d))
    )


@query("cruise_index", "SELECT * FROM v_index")
def cruise_index(spark, d):
    return _index(spark, d)


@query("calibrated_counts", "SELECT calibrated, count(*) AS cruises FROM v_index GROUP BY calibrated")
def calibrated_counts(spark, d):
    return catalog.calibrated_counts(_index(spark, d))


@query("index_sink", "SELECT * FROM v_index")
def index_sink(spark, d):
    path = scratch_path(spark, "index")
    tables.write_index(_index(spark, d), path)
    tables.write_index(_index(spark, d), path)
    return spark.read.parquet(path)


@query("calibration_sheet", "SELECT * FROM v_calibration")
def calibration_sheet(spark, d):
    path = scratch_path(spark, "sheet")
    _sheet(spark, d).write.option("header", "true").csv(path)
    return catalog.calibration_entries(archive.read_calibration(spark, path))


@query("archive_listing", "SELECT ship, cruise FROM v_file GROUP BY ship, cruise")
def archive_listing(spark, d):
    path = scratch_path(spark, "archive")
    _files(spark, d).select("ship", "cruise", "key").write.partitionBy("ship", "cruise").text(path)
    objects = archive.list_objects(spark, path, "*.txt").filter("size > 0")
    folder = lambda name: F.regexp_extract("key", f"{name}=([^/]+)", 1).alias(name)
    return objects.select(folder("ship"), folder("cruise")).distinct()


@query("folder_listing", "SELECT ship, cruise FROM v_file GROUP BY ship, cruise")
def folder_listing(spark, d):
    """The same archive listed by tasks, ship by ship and cruise by cruise."""
    path = scratch_path(spark, "archive")
    _files(spark, d).select("ship", "cruise", "key").write.partitionBy("ship", "cruise").text(path)
    objects = archive.list_by_folder(spark, path, "*.txt").filter("size > 0")
    folder = lambda name: F.regexp_extract("key", f"{name}=([^/]+)", 1).alias(name)
    return objects.select(folder("ship"), folder("cruise")).distinct()


@query("header_tags", "SELECT cruise, datagram FROM v_header")
def header_tags(spark, d):
    path = scratch_path(spark, "headers")
    # One stub file per cruise whose bytes 3-7 are a NUL and the tag.
    stubs = _headers(spark, d).select("cruise", F.concat(F.lit("len\u0000"), "datagram").alias("value"))
    stubs.repartition("cruise").write.partitionBy("cruise").text(path)
    files = archive.list_objects(spark, path, "*.txt").withColumn(
        "cruise", F.regexp_extract("key", "cruise=([^/]+)", 1)
    )
    return archive.header_tags(catalog.representatives(files), path).select("cruise", "datagram")
