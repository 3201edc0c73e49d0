"""File status log and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomgrid.operators import grid, status
from fathomgrid.session import scratch_path
from fathomgrid.sources import tables
from workload.registry import query, sql_view
from workload.views import table, view

_COLUMNS = "file_name, cruise_name, ship_name, sensor_name, pipeline_status, event_seq, zarr_path, num_ping_time_dropna"
sql_view(
    "v_latest",
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY file_name, cruise_name "
    "ORDER BY pipeline_time DESC, event_seq DESC) AS rn FROM v_status) WHERE rn = 1",
)
# Files asked for: every customer number below twice the users seen, so some were never written.
sql_view(
    "v_asked",
    "SELECT 'F' || cast(c_custkey AS string) AS file_name, 'C' || cast(c_custkey % 10 AS string) AS cruise_name "
    "FROM customer",
)


def _asked(spark, d):
    return table(spark, d, "customer").selectExpr(
        "'F' || cast(c_custkey as string) AS file_name", "'C' || cast(c_custkey % 10 as string) AS cruise_name"
    )


@query("latest_status", "SELECT * FROM v_latest")
def latest_status(spark, d):
    return status.latest_status(view(spark, d, "v_status"))


@query("status_snapshot", "SELECT * FROM v_latest")
def status_snapshot(spark, d):
    """The latest rows from the second of two snapshots and what was appended after it."""
    log, snapshot = scratch_path(spark, "status-log"), scratch_path(spark, "snapshot")
    rows = view(spark, d, "v_status")
    for part in range(4):
        tables.append_status(rows.filter(F.col("event_seq") % 4 == part), log)
        if part in (0, 2):
            tables.compact_status(spark, log, snapshot)
    latest = tables.read_latest_status(spark, log, snapshot).select(*rows.columns)
    return latest.withColumn("pipeline_time", F.col("pipeline_time").cast("timestamp_ntz"))


@query(
    "processing_status",
    "SELECT a.file_name, a.cruise_name, coalesce(l.pipeline_status, 'NONE') AS pipeline_status "
    "FROM v_asked a LEFT JOIN v_latest l USING (file_name, cruise_name)",
)
def processing_status(spark, d):
    return status.status_of(_asked(spark, d), view(spark, d, "v_status"))


@query(
    "eligible_files",
    f"SELECT {_COLUMNS} FROM v_latest WHERE pipeline_status IN ('SUCCESS', 'POPULATING_CRUISE_ZARR')",
)
def eligible_files(spark, d):
    return status.eligible_files(view(spark, d, "v_status")).drop("pipeline_time")


@query(
    "regrid_ready_files", f"SELECT {_COLUMNS} FROM v_latest WHERE pipeline_status = 'POPULATING_CRUISE_ZARR'"
)
def regrid_ready_files(spark, d):
    return status.eligible_files(view(spark, d, "v_status"), (status.POPULATING,)).drop("pipeline_time")


@query(
    "not_excluded_files",
    f"SELECT {_COLUMNS} FROM v_latest WHERE pipeline_status <> 'FAILURE' AND pipeline_status <> 'PROCESSING'",
)
def not_excluded_files(spark, d):
    latest = status.latest_status(view(spark, d, "v_status"))
    return latest.filter(status.not_excluded(F.col("pipeline_status"))).drop("pipeline_time")


@query(
    "cruises_without_files",
    "SELECT cruise_name, count(*) AS files, cast(0 AS bigint) AS usable FROM v_latest GROUP BY cruise_name "
    "HAVING count(*) FILTER (pipeline_status = 'POPULATING_CRUISE_ZARR' AND event_seq % 5 = 0) = 0",
)
def cruises_without_files(spark, d):
    # Only every fifth populated row counts as such, which leaves some cruises without any.
    log = view(spark, d, "v_status").withColumn(
        "pipeline_status",
        F.when(
            (F.col("pipeline_status") == status.POPULATING) & (F.col("event_seq") % 5 != 0), status.PROCESSING
        ).otherwise(F.col("pipeline_status")),
    )
    return status.cruises_without_files(log, (status.POPULATING,))


@query(
    "path_lookup",
    """
SELECT r.zarr_path, l.file_name, l.pipeline_status, l.zarr_path IS NOT NULL AS known
FROM (SELECT 'level_1/' || cruise_name || '/' || file_name || '.zarr' AS zarr_path FROM v_asked) r
LEFT JOIN v_latest l ON r.zarr_path = l.zarr_path""",
)
def path_lookup(spark, d):
    asked = _asked(spark, d).select(
        F.concat(F.lit("level_1/"), "cruise_name", F.lit("/"), "file_name", F.lit(".zarr")).alias("zarr_path")
    )
    found = status.lookup_paths(asked, status.latest_status(view(spark, d, "v_status")))
    return found.select("zarr_path", "file_name", "pipeline_status", "known")


_PENDING = (
    "SELECT file_name, cruise_name FROM v_asked WHERE (file_name, cruise_name) NOT IN "
    "(SELECT (file_name, cruise_name) FROM v_latest WHERE pipeline_status = 'SUCCESS')"
)


@query("pending_files", _PENDING)
def pending_files(spark, d):
    return status.pending_files(_asked(spark, d), view(spark, d, "v_status"))


@query("pending_files_overwrite", "SELECT file_name, cruise_name FROM v_asked")
def pending_files_overwrite(spark, d):
    return status.pending_files(_asked(spark, d), view(spark, d, "v_status"), overwrite=True)


@query(
    "write_reconciliation",
    """
SELECT coalesce(e.cruise, a.cruise) AS cruise, coalesce(e.n, 0) AS expected, coalesce(a.n, 0) AS actual
FROM (SELECT cruise, count(*) AS n FROM v_fix GROUP BY cruise) e
FULL JOIN (SELECT cruise, count(*) AS n FROM v_ping GROUP BY cruise) a ON e.cruise = a.cruise
WHERE coalesce(e.n, 0) <> coalesce(a.n, 0)""",
)
def write_reconciliation(spark, d):
    return status.reconcile(view(spark, d, "v_fix"), view(spark, d, "v_ping"), ["cruise"])


sql_view("v_lines", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey")


@query(
    "slice_reconciliation",
    """
SELECT cruise, file_name, num_ping_time_dropna AS expected, coalesce(n.n, 0) AS actual
FROM v_usable_info f LEFT JOIN v_lines n ON cast(substr(file_name, 2) AS bigint) = n.l_orderkey
WHERE num_ping_time_dropna <> coalesce(n.n, 0)
UNION ALL
SELECT 'C' || cast(o_custkey AS string), 'F' || lpad(cast(l_orderkey AS string), 12, '0'), 0, n.n
FROM v_lines n JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'P'""",
)
def slice_reconciliation(spark, d):
    # Lines of an order stand for the pings found in its file.
    found = table(spark, d, "lineitem").join(
        table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).selectExpr(
        "'C' || cast(o_custkey as string) AS cruise",
        "'F' || lpad(cast(o_orderkey as string), 12, '0') AS file_name",
    )
    return status.reconcile_slices(grid.file_slices(view(spark, d, "v_usable_info")), found)


@query("status_sink", f"SELECT {_COLUMNS}, true AS stamped FROM v_latest")
def status_sink(spark, d):
    """Append the log in two parts and read the latest rows back."""
    path = scratch_path(spark, "status")
    log = view(spark, d, "v_status")
    done = F.col("pipeline_status") == status.SUCCESS
    tables.append_status(log.filter(done), path)
    tables.append_status(log.filter(~done), path)
    latest = status.latest_status(tables.read_status(spark, path))
    return latest.select(
        *_COLUMNS.split(", "), F.col("pipeline_time").isNotNull().alias("stamped")
    )


@query(
    "status_marks",
    "SELECT file_name, cruise_name, 'PROCESSING' AS pipeline_status, true AS recent FROM v_asked",
)
def status_marks(spark, d):
    """Mark files as being processed: a stamped row each."""
    path = scratch_path(spark, "marks")
    tables.append_status(tables.status_rows(_asked(spark, d), status.PROCESSING), path)
    return tables.read_status(spark, path).select(
        "file_name", "cruise_name", "pipeline_status",
        (F.col("pipeline_time") > F.lit("2025-01-01").cast("timestamp")).alias("recent"),
    )
