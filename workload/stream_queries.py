"""Stage messages, completion and failures: batch forms and real streams over the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomgrid.operators import catalog, status
from fathomgrid.session import scratch_path
from fathomgrid.sources import tables
from fathomgrid.streaming import accumulator, messages, sinks
from workload.catalog_queries import _files, _headers
from workload.registry import query, sql_view
from workload.views import table, view

# --- messages ------------------------------------------------------------------------------------

_FIELDS = {
    "prefix": "'dev'",
    "ship_name": "'Ship_' || cast(user_id % 5 as string)",
    "cruise_name": "'CR' || lpad(cast(user_id % 40 as string), 2, '0')",
    "sensor_name": "'EK60'",
    "input_bucket": "'in-' || event_type",
    "output_bucket": "'out'",
    "input_file_name": "'D' || cast(event_id as string) || '.raw'",
}
# Errors are broken text, signups lack a field when their value is low.
_KIND = "case when event_type = 'error' then 'broken' when event_type = 'signup' and value < 2e1 then 'short' else 'good' end"
sql_view(
    "v_message",
    f"SELECT event_id AS event_seq, ts AS event_time, {_KIND} AS kind, "
    + ", ".join(f"{e} AS {c}" for c, e in _FIELDS.items())
    + " FROM events",
)


def _notifications(spark: SparkSession, d: str) -> DataFrame:
    """Notification texts: event_seq, event_time, value."""
    fields = table(spark, d, "events").selectExpr(
        "event_id AS event_seq", "cast(ts as timestamp) AS event_time", f"{_KIND} AS kind",
        *[f"{e} AS {c}" for c, e in _FIELDS.items()],
    )
    whole = {c: F.col(c) for c in _FIELDS}
    short = {c: F.col(c) for c in _FIELDS if c != "sensor_name"}
    text = messages.notification(**whole)
    return fields.select(
        "event_seq", "event_time",
        F.when(F.col("kind") == "broken", F.substring(text, 1, 40))
        .when(F.col("kind") == "short", messages.notification(**short))
        .otherwise(text)
        .alias("value"),
    )


def _stream_of(spark: SparkSession, df: DataFrame, name: str, batches: int = 3) -> DataFrame:
    """`df` as a file stream read in several batches, each of as many files as the data have parts."""
    path = scratch_path(spark, name)
    parts = max(1, df.rdd.getNumPartitions())
    df.repartition(batches * parts).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", str(parts)).parquet(path)


_GOOD = "kind = 'good'"


@query(
    "message_fields",
    "SELECT event_seq, " + ", ".join(
        f"CASE WHEN kind = 'broken' {'OR kind = ' + chr(39) + 'short' + chr(39) if c == 'sensor_name' else ''} "
        f"THEN NULL ELSE {c} END AS {c}" for c in _FIELDS
    ) + f", {_GOOD} AS valid FROM v_message",
)
def message_fields(spark, d):
    return messages.parse_messages(_notifications(spark, d)).drop("value", "event_time")


@query(
    "cruise_fan_out",
    f"""
SELECT f.key, r.ship_name, r.cruise_name FROM v_file f
JOIN (SELECT DISTINCT ship_name, cruise_name, sensor_name FROM v_message WHERE {_GOOD}) r
  ON f.ship = r.ship_name AND f.cruise = r.cruise_name AND f.sensor = r.sensor_name""",
)
def cruise_fan_out(spark, d):
    """Requests repeat, so they are made distinct; each then gives one event per file."""
    requests = (
        messages.parse_messages(_notifications(spark, d))
        .filter("valid")
        .select("ship_name", "cruise_name", "sensor_name")
        .distinct()
    )
    return messages.fan_out(requests, _files(spark, d)).select("key", "ship_name", "cruise_name")


@query(
    "fan_out_stream",
    f"""
SELECT f.key, r.ship_name, r.cruise_name FROM v_file f
JOIN (SELECT DISTINCT ship_name, cruise_name, sensor_name FROM v_message WHERE {_GOOD}) r
  ON f.ship = r.ship_name AND f.cruise = r.cruise_name AND f.sensor = r.sensor_name""",
)
def fan_out_stream(spark, d):
    """The same events from a stream whose requests repeat across batches; each file has one event."""
    base = scratch_path(spark, "fan-out")
    requests = messages.parse_messages(_stream_of(spark, _notifications(spark, d), "notifications"))
    events = messages.fan_out(messages.first_requests(requests), _files(spark, d))
    sinks.run_available(events.select("key", "ship_name", "cruise_name"), f"{base}/rows", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/rows").select("key", "ship_name", "cruise_name")


@query(
    "failure_rows",
    """
SELECT event_seq, CASE WHEN kind = 'short' THEN input_file_name END AS file_name,
  CASE WHEN kind = 'short' THEN cruise_name END AS cruise_name, 'FAILURE' AS pipeline_status,
  'malformed message' AS reason
FROM v_message WHERE kind <> 'good'""",
)
def failure_rows(spark, d):
    rows = messages.failures(messages.parse_messages(_notifications(spark, d)))
    return rows.select("event_seq", "file_name", "cruise_name", "pipeline_status", "reason")


@query(
    "failure_stream",
    """
SELECT event_seq, CASE WHEN kind = 'short' THEN input_file_name END AS file_name, 'FAILURE' AS pipeline_status
FROM v_message WHERE kind <> 'good'""",
)
def failure_stream(spark, d):
    """The same failure rows from a stream, read back from its sink."""
    base = scratch_path(spark, "failures")
    stream = _stream_of(spark, _notifications(spark, d), "notifications")
    sinks.run_available(
        messages.failures(messages.parse_messages(stream)), f"{base}/rows", f"{base}/checkpoint"
    )
    return spark.read.parquet(f"{base}/rows").select("event_seq", "file_name", "pipeline_status")


# --- completion ----------------------------------------------------------------------------------

# Four users make a cruise. Each kind of event of a user is a file, finished by its events and failed by
# errors; every thirteenth event names a file that is not listed, and some users list a file that no
# event finishes.
_CRUISE = "'C' || cast(cast(floor(cast(user_id as double) / 4e0) as bigint) as string)"
_LISTED = "'F' || cast(user_id as string) || '-' || event_type"
_NEVER = f"case when user_id % 7 = 0 then 'X' || cast(user_id as string) else {_LISTED} end"
_NAMED = f"case when event_id % 13 = 0 then 'stray' || cast(event_id % 3 as string) else {_LISTED} end"
sql_view(
    "v_member",
    f"SELECT {_CRUISE} AS cruise_name, {_LISTED} AS file_name FROM events "
    f"UNION SELECT {_CRUISE}, {_NEVER} FROM events",
)
sql_view("v_expected", "SELECT cruise_name, count(*) AS expected FROM v_member GROUP BY cruise_name")
sql_view(
    "v_finish",
    f"SELECT {_CRUISE} AS cruise_name, {_NAMED} AS file_name, ts AS event_time, event_type, event_id FROM events",
)
sql_view(
    "v_complete",
    """
SELECT cruise_name, count(f.file_name) AS finished, count(*) AS expected FROM v_member m
LEFT JOIN (SELECT DISTINCT cruise_name, file_name FROM v_finish) f USING (cruise_name, file_name)
GROUP BY cruise_name HAVING count(f.file_name) = count(*)""",
)


def _members(spark, d):
    events = table(spark, d, "events")
    rest = ("'Ship' AS ship", "'EK60' AS sensor")
    listed = events.selectExpr(f"{_CRUISE} AS cruise", f"{_LISTED} AS filename", *rest)
    return listed.union(events.selectExpr(f"{_CRUISE} AS cruise", f"{_NEVER} AS filename", *rest)).distinct()


def _finishes(spark, d):
    events = table(spark, d, "events").selectExpr(
        f"{_CRUISE} AS cruise_name", f"{_NAMED} AS file_name", "cast(ts as timestamp) AS event_time", "event_type"
    )
    return messages.finished_events(
        events.filter("event_type <> 'error'"), events.filter("event_type = 'error'")
    )


@query("expected_files", "SELECT * FROM v_expected")
def expected_files(spark, d):
    return accumulator.expected_files(_members(spark, d))


@query("completed_cruises", "SELECT * FROM v_complete")
def completed_cruises(spark, d):
    return accumulator.completed_cruises(_finishes(spark, d), _members(spark, d))


@query(
    "completion_stream",
    "SELECT cruise_name, finished AS files, 'raw-to-zarr' AS stage, cast(1 AS bigint) AS notices FROM v_complete",
)
def completion_stream(spark, d):
    """Completion notices of a stream in several batches; repeated and stray finishes occur across them."""
    notices = accumulator.run_accumulator(
        _stream_of(spark, _finishes(spark, d), "finishes"),
        lambda: _members(spark, d),
        scratch_path(spark, "accumulator"),
    )
    return notices.groupBy("cruise_name", "files", "stage").agg(F.count(F.lit(1)).alias("notices"))


# Messages of even users' cruises that were cut short are not listed, so that their cruises complete.
_USER = "'U' || cast(user_id as string)"
sql_view(
    "v_message_file",
    f"SELECT {_USER} AS cruise, 'D' || cast(event_id AS string) || '.raw' AS filename, "
    f"event_type = 'error' AS broken, user_id FROM events",
)


@query(
    "message_completion",
    """
SELECT cruise AS cruise_name, count(*) FILTER (NOT broken) AS files, cast(1 AS bigint) AS notices FROM v_message_file
GROUP BY cruise HAVING any_value(user_id) % 2 = 0 AND count(*) FILTER (NOT broken) > 0
  OR count(*) FILTER (broken) = 0""",
)
def message_completion(spark, d):
    """From notification texts to completed cruises in one stream: a malformed message fails its file,
    and a failed file counts as finished where the message still tells which it is."""
    fields = {**_FIELDS, "cruise_name": _USER}
    made = table(spark, d, "events").selectExpr(
        "event_id AS event_seq", "cast(ts as timestamp) AS event_time", f"{_KIND} AS kind", "user_id", "event_type",
        *[f"{e} AS {c}" for c, e in fields.items()],
    )
    text = messages.notification(**{c: F.col(c) for c in fields})
    short = messages.notification(**{c: F.col(c) for c in fields if c != "sensor_name"})
    value = F.when(F.col("kind") == "broken", F.substring(text, 1, 40)).when(F.col("kind") == "short", short).otherwise(text)
    listed = made.filter("not (event_type = 'error' and user_id % 2 = 0)").select(
        F.col("cruise_name").alias("cruise"), F.col("input_file_name").alias("filename")
    )
    stream = _stream_of(spark, made.select("event_seq", "event_time", value.alias("value")), "notifications")
    parsed = messages.parse_messages(stream)
    finished = messages.finished_events(messages.failures(parsed, done=status.SUCCESS))
    notices = accumulator.run_accumulator(finished, lambda: listed, scratch_path(spark, "accumulator"))
    return notices.groupBy("cruise_name", "files").agg(F.count(F.lit(1)).alias("notices"))


@query(
    "aggregated_status",
    "SELECT m.file_name, m.cruise_name, 'SUCCESS' AS pipeline_status FROM v_member m JOIN v_complete USING (cruise_name)",
)
def aggregated_status(spark, d):
    members = _members(spark, d)
    done = accumulator.completed_cruises(_finishes(spark, d), members)
    return accumulator.status_after_completion(done, members).select(
        "file_name", "cruise_name", "pipeline_status"
    )


@query(
    "aggregator_stream",
    "SELECT m.file_name, m.cruise_name, 'SUCCESS' AS pipeline_status, true AS stamped "
    "FROM v_member m JOIN v_complete USING (cruise_name)",
)
def aggregator_stream(spark, d):
    """Status rows that a stream of finishes writes when a cruise is complete."""
    base = scratch_path(spark, "aggregator")
    accumulator.run_aggregator(
        _stream_of(spark, _finishes(spark, d), "regridded"), lambda: _members(spark, d), base
    )
    return tables.read_status(spark, f"{base}/status").select(
        "file_name", "cruise_name", "pipeline_status", F.col("pipeline_time").isNotNull().alias("stamped")
    )


@query(
    "completion_notices",
    "SELECT cruise_name, 'regrid' AS stage, finished AS files, true AS stamped FROM v_complete",
)
def completion_notices(spark, d):
    done = accumulator.completed_cruises(_finishes(spark, d), _members(spark, d))
    return accumulator.completion_notices(done, "regrid").select(
        "cruise_name", "stage", "files", F.col("notice_time").isNotNull().alias("stamped")
    )


@query("repeat_removal", "SELECT DISTINCT file_name, cruise_name, event_type AS stage FROM v_finish")
def repeat_removal(spark, d):
    """First event per file, cruise and stage of a stream; none is too late."""
    events = table(spark, d, "events").selectExpr(
        f"{_CRUISE} AS cruise_name", f"{_NAMED} AS file_name", "event_type AS stage",
        "cast(ts as timestamp) AS event_time",
    )
    base = scratch_path(spark, "repeats")
    unique = messages.without_repeats(_stream_of(spark, events, "stages"))
    sinks.run_available(unique, f"{base}/rows", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/rows").select("file_name", "cruise_name", "stage")


@query(
    "status_stream",
    "SELECT file_name, cruise_name, pipeline_status, event_seq, pipeline_time FROM v_latest",
)
def status_stream(spark, d):
    """Status rows appended by a stream, stamped with their event's time; the latest per file counts."""
    base = scratch_path(spark, "status-stream")
    rows = view(spark, d, "v_status").withColumn("event_time", F.col("pipeline_time")).drop("pipeline_time")
    sinks.status_from_stream(_stream_of(spark, rows, "marks"), f"{base}/rows", f"{base}/checkpoint", "event_time")
    log = spark.read.parquet(f"{base}/rows")
    return status.latest_status(log).select("file_name", "cruise_name", "pipeline_status", "event_seq", "pipeline_time")


_LINE = (
    "case when event_type = 'error' and value > 8e1 then 'RequestId: ' || cast(event_id as string) || ' Error: "
    "Runtime exited with error: signal: killed' when event_type = 'error' then cast(event_id as string) || "
    "' Task timed out after 900.10 seconds' else 'REPORT ' || event_type end"
)


@query(
    "log_failures",
    """
SELECT event_id, CASE WHEN value > 80 THEN 'memory' ELSE 'time' END AS reason, 'FAILURE' AS pipeline_status
FROM events WHERE event_type = 'error'""",
)
def log_failures(spark, d):
    lines = table(spark, d, "events").selectExpr("event_id", f"{_LINE} AS line")
    return messages.classify_log_lines(lines).select("event_id", "reason", "pipeline_status")


def _log_lines(spark, d):
    """Log lines of runs, with the file each worked on."""
    return table(spark, d, "events").selectExpr(
        "event_id", f"{_CRUISE} AS cruise_name", f"{_NAMED} AS file_name", "cast(ts as timestamp) AS event_time", f"{_LINE} AS line"
    )


@query(
    "log_failure_stream",
    f"""
SELECT event_id, {_NAMED} AS file_name, {_CRUISE} AS cruise_name, CASE WHEN value > 80 THEN 'memory' ELSE 'time' END AS reason,
  'FAILURE' AS pipeline_status FROM events WHERE event_type = 'error'""",
)
def log_failure_stream(spark, d):
    """Failures found in a stream of log lines, read back from their sink."""
    base = scratch_path(spark, "log-failures")
    failed = messages.classify_log_lines(_stream_of(spark, _log_lines(spark, d), "log"))
    sinks.run_available(failed, f"{base}/rows", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/rows").select("event_id", "file_name", "cruise_name", "reason", "pipeline_status")


@query(
    "log_failure_completion",
    "SELECT cruise_name, finished AS files, cast(1 AS bigint) AS notices FROM v_complete",
)
def log_failure_completion(spark, d):
    """Completion of cruises where failures are known from log lines only: two streams into one count."""
    lines = _log_lines(spark, d)
    log = messages.classify_log_lines(_stream_of(spark, lines, "log"))
    done = _stream_of(spark, lines.filter("line like 'REPORT %'").drop("line"), "done")
    notices = accumulator.run_accumulator(
        messages.finished_events(done, log), lambda: _members(spark, d), scratch_path(spark, "accumulator")
    )
    return notices.groupBy("cruise_name", "files").agg(F.count(F.lit(1)).alias("notices"))


@query(
    "request_files",
    f"""
SELECT f.filename, f.cruise FROM v_file f WHERE f.sensor = 'EK60' AND (f.ship, f.cruise) IN
  (SELECT (ship_name, cruise_name) FROM v_message WHERE {_GOOD})
  AND f.cruise IN (SELECT cruise FROM v_header WHERE datagram = 'CON0')""",
)
def request_files(spark, d):
    """Files that requested cruises still have to process: the first stage's work list."""
    wanted = (
        messages.parse_messages(_notifications(spark, d))
        .filter("valid")
        .select(F.col("ship_name").alias("ship"), F.col("cruise_name").alias("cruise"),
                F.col("sensor_name").alias("sensor"))
        .distinct()
    )
    files = catalog.with_datagram(_files(spark, d), _headers(spark, d))
    return files.join(wanted, ["ship", "cruise", "sensor"], "left_semi").select("filename", "cruise")
