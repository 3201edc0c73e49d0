"""Cruise completion: report a cruise once, when all its files are finished."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fathomgrid.functions import times
from fathomgrid.operators.status import SUCCESS
from fathomgrid.session import keyed_state
from fathomgrid.sources import tables
from fathomgrid.streaming.sinks import batch_writer

KEYS = ["cruise_name", "file_name"]
SALTS = 64
"""Parts the cruises are counted in: a call of the processor takes the rows of a part, not of one cruise."""
BUCKETS = 512
"""Entries of a part's state: the cruises of an entry are read and written in one call."""
COMBINED = 500_000
"""Rows a task keeps before it adds them up by cruise."""

NOTICES = "cruise_name string, stage string, files long, notice_time timestamp, batch_id long"
LISTED = "cruise_name string, file_name string, expected long"


def expected_files(files: DataFrame) -> DataFrame:
    """Number of distinct files per cruise."""
    return files.groupBy(F.col("cruise").alias("cruise_name")).agg(
        F.count_distinct("filename").alias("expected")
    )


def listed_files(files: DataFrame) -> DataFrame:
    """Distinct (cruise_name, file_name) of a file list."""
    return files.select(F.col("cruise").alias("cruise_name"), F.col("filename").alias("file_name")).distinct()


def completed_cruises(finished: DataFrame, files: DataFrame) -> DataFrame:
    """Batch form: cruises of which every listed file is finished.

    Finishes count only for files of the list. Repeats fall out in a distinct over (cruise, file),
    which spreads a large cruise.
    """
    seen = finished.select(*KEYS).distinct().withColumn("__seen", F.lit(1))
    met = listed_files(files).join(seen, KEYS, "left")
    totals = met.groupBy("cruise_name").agg(
        F.count("__seen").alias("finished"), F.count(F.lit(1)).alias("expected")
    )
    return totals.filter("finished = expected")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """None where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def publish_listing(files: DataFrame, path: str) -> None:
    """Append to the log of listed files those it does not have, with the files their cruise has by now.

    A cruise that is listed in several steps is complete when the last number published is reached.
    """
    known = _read(files.sparkSession, path, LISTED)
    if known is None:
        fresh = together = listed_files(files)
    else:
        fresh = listed_files(files).join(known.select(*KEYS), KEYS, "left_anti")
        together = known.select(*KEYS).unionByName(fresh).distinct()
    counts = together.groupBy("cruise_name").agg(F.count(F.lit(1)).alias("expected"))
    rows = fresh.join(counts, "cruise_name").select(*KEYS, "expected")
    if known is None or not rows.isEmpty():
        rows.write.mode("append").parquet(path)


COUNTS = ["bucket", "cruise_name", "met", "expected"]


def _by_cruise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cruise_name, met, expected) added up by cruise, some `COMBINED` rows at a time."""

    def summed(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        table = pa.Table.from_batches(held).group_by("cruise_name").aggregate([("met", "sum"), ("expected", "max")])
        columns = [table.column(c) for c in ("cruise_name", "met_sum", "expected_max")]
        # As the rows that come, so that both can be added up again.
        return pa.Table.from_arrays(columns, schema=held[0].schema).to_batches()

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= COMBINED:
            held = summed(held)
            rows = sum(b.num_rows for b in held)
            if 2 * rows >= COMBINED:
                yield from held
                held, rows = [], 0
    if held:
        yield from summed(held)


class _Cruises(StatefulProcessor):
    """Per part of the cruises: how many files of each are met, how many there are, and whether that was reported."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        # Each call for state costs some hundred times what a cruise in it does, so cruises share entries:
        # {cruise: [met, expected, reported]} as JSON.
        self.totals = handle.getMapState("totals", "bucket long", "cruises string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        told: dict[int, dict[str, tuple[int, int]]] = defaultdict(dict)
        for part in rows:
            for bucket, name, met, expected in zip(*(part[c].tolist() for c in COUNTS), strict=True):
                before = told[bucket].get(name, (0, 0))
                told[bucket][name] = (before[0] + met, max(before[1], expected))
        full = []
        for bucket, cruises in told.items():
            found = self.totals.getValue((bucket,))
            totals = json.loads(found[0]) if found else {}
            for name, (more, number) in cruises.items():
                met, expected, reported = totals.get(name, (0, 0, False))
                met, expected = met + more, max(expected, number)
                done = not reported and met >= expected > 0
                totals[name] = (met, expected, reported or done)
                if done:
                    full.append((name, met, expected))
            self.totals.updateValue((bucket,), (json.dumps(totals),))
        if full:
            yield pd.DataFrame(full, columns=["cruise_name", "finished", "expected"])

    def close(self) -> None:
        pass


def completions(finished: DataFrame, listed: DataFrame, salts: int = SALTS) -> DataFrame:
    """Stream of cruises (cruise_name, finished, expected), each once, when all their listed files are finished.

    `finished` is a stream of (cruise_name, file_name), `listed` one of (cruise_name, file_name, expected) as
    `publish_listing` writes it. Repeats change nothing; finishes of files that are not listed are held until
    they are. The files of a cruise that are listed and finished are those listed and those finished less those that
    are one or the other, so three distinct streams count them without a join, and files of a hot cruise are keys of
    their own. A batch touches the state of the files it names and of their cruises, whatever came before. `finished`
    is read twice. Its query is started within `keyed_state`, or in a session that keeps state in RocksDB.
    """
    known = listed.dropna(subset=KEYS)
    done = finished.select(*KEYS).dropna(subset=KEYS)
    either = known.select(*KEYS).unionByName(done)

    def tells(rows: DataFrame, met: int, expected: Column) -> DataFrame:
        return rows.select("cruise_name", F.lit(met).cast("long").alias("met"), expected.cast("long").alias("expected"))

    counts = (
        tells(known.select(*KEYS).dropDuplicates(KEYS), 1, F.lit(0))
        .unionByName(tells(done.dropDuplicates(KEYS), 1, F.lit(0)))
        .unionByName(tells(either.dropDuplicates(KEYS), -1, F.lit(0)))
        .unionByName(tells(known, 0, F.col("expected")))
    )
    # A cruise's rows meet once as columns, so that the processor gets one row of each.
    summed = counts.repartition("cruise_name").mapInArrow(_by_cruise, counts.schema)
    hashed = F.xxhash64("cruise_name")
    parted = summed.withColumns(
        {"part": F.pmod(hashed, F.lit(salts)), "bucket": F.pmod(F.shiftrightunsigned(hashed, 32), F.lit(BUCKETS))}
    )
    return parted.groupBy("part").transformWithStateInPandas(
        _Cruises(), "cruise_name string, finished long, expected long", "Append", "None"
    )


def completion_writer(base: str, stage: str, then: Callable[[DataFrame, int], None] | None = None):
    """`foreachBatch` function that writes a notice per completed cruise; a replayed batch writes the same ones.

    `then` receives the completed cruises and must be as repeatable.
    """
    write_notices = batch_writer(f"{base}/notices")

    def write(completed: DataFrame, batch_id: int) -> None:
        if then is not None:
            # Both sinks take the same rows, so the state is asked once.
            completed.persist()
            then(completed, batch_id)
        write_notices(completion_notices(completed, stage), batch_id)
        completed.unpersist()

    return write


def run_accumulator(
    finished: DataFrame,
    listing: Callable[[], DataFrame],
    base: str,
    stage: str = "raw-to-zarr",
    then: Callable[[DataFrame, int], None] | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Process all available finishes and return the completion notices written so far.

    `listing` returns the file list (cruise, filename) as it is now; what is new in it is published to
    `base`/listed once per run, and read from there as a stream. A query that never ends follows the same log, to
    which whoever lists files publishes.
    """
    spark = finished.sparkSession
    publish_listing(listing(), f"{base}/listed")
    reader = spark.readStream.schema(LISTED)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    with keyed_state(spark):
        query = (
            completions(finished, reader.parquet(f"{base}/listed"))
            .writeStream.outputMode("append")
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(completion_writer(base, stage, then))
            .start()
        )
    query.awaitTermination()
    notices = _read(spark, f"{base}/notices", NOTICES)
    return spark.createDataFrame([], NOTICES) if notices is None else notices


def completion_notices(completed: DataFrame, stage: str) -> DataFrame:
    """Notice rows for completed cruises."""
    return completed.select(
        "cruise_name",
        F.lit(stage).alias("stage"),
        F.col("finished").alias("files"),
        F.current_timestamp().alias("notice_time"),
    )


def status_after_completion(
    completed: DataFrame, files: DataFrame, status: str = SUCCESS
) -> DataFrame:
    """New status rows for every file of each completed cruise."""
    listed = files.select(
        F.col("filename").alias("file_name"), F.col("cruise").alias("cruise_name"),
        F.col("ship").alias("ship_name"), F.col("sensor").alias("sensor_name"),
    )
    return listed.join(completed.select("cruise_name"), "cruise_name").withColumn(
        "pipeline_status", F.lit(status)
    )


def run_aggregator(
    finished: DataFrame, listing: Callable[[], DataFrame], base: str, stage: str = "regrid"
) -> DataFrame:
    """Last stage: when all files of a cruise are regridded, mark each of them, and report the cruise.

    `listing` has ship and sensor beside cruise and filename. Status rows are written below
    `base`/status by batch; returns the notices.
    """
    write_status = batch_writer(f"{base}/status", tables.as_status)

    def mark(completed: DataFrame, batch_id: int) -> None:
        write_status(times.stamped(status_after_completion(completed, listing())), batch_id)

    return run_accumulator(finished, listing, base, stage, mark)
