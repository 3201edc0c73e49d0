"""Stage messages: parsing, fan-out to files, failure routing, duplicate removal."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomgrid import schemas
from fathomgrid.operators.status import FAILURE

# Log texts that mark a killed or an overdue run.
KILLED_TEXT = "signal: killed"
OVERDUE_TEXT = "Task timed out"

FIELDS = tuple(schemas.STAGE_MESSAGE.fieldNames())


def parse_messages(notifications: DataFrame, value: str = "value") -> DataFrame:
    """Open the JSON text inside each notification.

    Adds the message fields and `valid`, false when either layer is no JSON or a field is absent.
    The other columns of the input are kept. Works on batch and streaming frames.
    """
    outer = F.from_json(F.col(value), schemas.NOTIFICATION)
    text = F.try_element_at(outer["Records"], F.lit(1))["Sns"]["Message"]
    # Opened by a generator, each text is parsed once however many fields are used or filtered.
    opened = notifications.select("*", F.inline(F.array(F.from_json(text, schemas.STAGE_MESSAGE))))
    return opened.withColumn("valid", reduce(and_, [F.col(f).isNotNull() for f in FIELDS]))


def notification(**fields: Column) -> Column:
    """Notification text for a stage message with the given fields."""
    message = F.to_json(F.struct(*[fields[f].alias(f) for f in FIELDS if f in fields]))
    return F.to_json(
        F.struct(F.array(F.struct(F.struct(message.alias("Message")).alias("Sns"))).alias("Records"))
    )


REQUEST = ("ship_name", "cruise_name", "sensor_name")
SALTS = 16
"""Parts the file list of a cruise is joined in, so that a hot cruise is no single join key."""


def first_requests(requests: DataFrame, delay: str | None = None) -> DataFrame:
    """Valid requests of a stream, each cruise once however often and in however many batches it is asked for.

    A `delay` forgets requests by a watermark on event_time, so that a cruise can be asked for again later.
    """
    return without_repeats(requests.filter("valid"), REQUEST, delay)


def fan_out(requests: DataFrame, files: DataFrame, salts: int = SALTS) -> DataFrame:
    """One event per raw file of the requested cruise: stream or table of requests, static list of files.

    Each request gives its events, so repeats are removed first (`first_requests`, or `distinct` on a table).
    Requests are few and files many per cruise: requests are copied to every salt of their cruise's files.
    The side to ship is Spark's choice.
    """
    listed = files.select(
        *[c for c in ("key",) if c in files.columns],
        F.col("ship").alias("ship_name"), F.col("cruise").alias("cruise_name"),
        F.col("sensor").alias("sensor_name"), F.col("filename").alias("file_name"),
    ).withColumn("__salt", F.pmod(F.xxhash64("file_name"), F.lit(salts)))
    wanted = requests.filter("valid") if "valid" in requests.columns else requests
    copied = wanted.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return copied.join(listed, [*REQUEST, "__salt"]).drop("__salt")


def requested_file(events: DataFrame) -> DataFrame:
    """Only the files their message names."""
    return events.filter(F.col("file_name") == F.col("input_file_name"))


def failures(parsed: DataFrame, reason: str = "malformed message", done: str | None = None) -> DataFrame:
    """Status rows for messages that cannot be processed; what could be read is kept.

    With a status `done`, those that can be processed have rows too, of that status and without a reason: both kinds
    from one reading and parsing of a stream, which a union of two selections of it would take twice.
    """
    failed = ~F.col("valid")
    return (parsed.filter(failed) if done is None else parsed).select(
        *[c for c in ("event_seq", "event_time") if c in parsed.columns],
        F.col("input_file_name").alias("file_name"),
        "ship_name",
        "cruise_name",
        "sensor_name",
        F.when(failed, FAILURE).otherwise(done).alias("pipeline_status"),
        F.when(failed, reason).alias("reason"),
    )


def finished_events(*outcomes: DataFrame) -> DataFrame:
    """Completions and failures together: a failed file still counts towards its cruise."""
    columns = ["cruise_name", "file_name", "event_time"]
    return reduce(DataFrame.unionByName, [o.select(*columns) for o in outcomes]).dropna(
        subset=["cruise_name", "file_name"]
    )


def without_repeats(
    events: DataFrame,
    keys: tuple[str, ...] = ("file_name", "cruise_name", "stage"),
    delay: str | None = None,
) -> DataFrame:
    """First event per file, cruise and stage, however late it comes.

    One key per file and stage is remembered for good. A `delay` bounds that by a watermark on
    event_time; then events later than it are dropped, which is for the caller to decide.
    """
    if delay is None:
        return events.dropDuplicates(list(keys))
    return events.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(keys))


def classify_log_lines(lines: DataFrame, text: str = "line") -> DataFrame:
    """Failure rows for log lines that tell of a killed or an overdue run."""
    reason = F.when(F.contains(text, F.lit(KILLED_TEXT)), "memory").when(
        F.contains(text, F.lit(OVERDUE_TEXT)), "time"
    )
    return (
        lines.withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .withColumn("pipeline_status", F.lit(FAILURE))
    )

