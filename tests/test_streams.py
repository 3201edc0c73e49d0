"""Messages, completion and status streams."""

import datetime as dt
import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fathomgrid.operators import status
from fathomgrid.session import SETTINGS, STATE_PARTITIONS, keyed_state
from fathomgrid.streaming import accumulator, messages, sinks

T0 = dt.datetime(2023, 5, 23, 13, 0, 0)
FIELDS = {
    "prefix": "dev", "ship_name": "Bigelow", "cruise_name": "HB0707", "sensor_name": "EK60",
    "input_bucket": "in", "output_bucket": "out", "input_file_name": "D20070711-T182032.raw",
}


def wrapped(inner):
    return json.dumps({"Records": [{"Sns": {"Message": inner}}]})


def test_messages(spark):
    texts = [
        wrapped(json.dumps(FIELDS)),
        wrapped(json.dumps({k: v for k, v in FIELDS.items() if k != "prefix"})),
        wrapped("no json"),
        "no json",
        json.dumps({"Records": []}),
        None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "event_seq long, value string")
    rows = messages.parse_messages(df).orderBy("event_seq").collect()
    assert [r["valid"] for r in rows] == [True] + [False] * 5
    assert {k: rows[0][k] for k in FIELDS} == FIELDS
    failed = messages.failures(messages.parse_messages(df)).orderBy("event_seq").collect()
    assert [r["event_seq"] for r in failed] == [1, 2, 3, 4, 5]
    assert failed[0]["cruise_name"] == "HB0707" and failed[0]["pipeline_status"] == "FAILURE"


def test_notification_round_trip(spark):
    df = spark.createDataFrame([tuple(FIELDS.values())], list(FIELDS)).select(
        messages.notification(**{f: F.col(f) for f in FIELDS}).alias("value")
    )
    row = messages.parse_messages(df).first()
    assert row["valid"] and {k: row[k] for k in FIELDS} == FIELDS


def test_fan_out_of_a_stream(spark, tmp_path):
    spark.createDataFrame([(wrapped(json.dumps(FIELDS)),), ("broken",)], "value string").write.text(str(tmp_path / "in"))
    files = spark.createDataFrame(
        [("Bigelow", "HB0707", "EK60", f"D{i}.raw") for i in range(3)] + [("Bigelow", "HB0805", "EK60", "D9.raw")],
        "ship string, cruise string, sensor string, filename string",
    )
    parsed = messages.parse_messages(spark.readStream.text(str(tmp_path / "in")))
    sinks.run_available(messages.fan_out(parsed, files), str(tmp_path / "out"), str(tmp_path / "cp"))
    events = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["file_name"] for r in events.collect()) == ["D0.raw", "D1.raw", "D2.raw"]
    assert messages.requested_file(events).count() == 0


def test_repeated_requests_fan_out_once(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    files = spark.range(500).selectExpr(
        "'Bigelow' AS ship", "'HB0707' AS cruise", "'EK60' AS sensor", "concat('D', cast(id as string)) AS filename"
    )
    for _ in range(3):
        spark.createDataFrame([(wrapped(json.dumps(FIELDS)),)] * 4, "value string").coalesce(1).write.mode("append").text(source)
        parsed = messages.parse_messages(spark.readStream.text(source))
        sinks.run_available(messages.fan_out(messages.first_requests(parsed), files), base, str(tmp_path / "cp"))
    events = spark.read.parquet(base)
    assert events.count() == events.select("file_name").distinct().count() == 500
    # A hot cruise is as many join keys as there are salts.
    salted = messages.fan_out(messages.parse_messages(spark.read.text(source)).limit(1), files, salts=8)
    assert salted.count() == 500


def put(spark, path, rows):
    """One file of finishes; each call is a later batch."""
    spark.createDataFrame(
        [(c, f, T0) for c, f in rows], "cruise_name string, file_name string, event_time timestamp"
    ).coalesce(1).write.mode("append").parquet(path)


FILES = [("A", "f0"), ("A", "f1"), ("A", "f1"), ("A", "f2"), ("B", "g0"), ("B", "g1")]


def file_list(spark, rows=FILES):
    return spark.createDataFrame(rows, "cruise string, filename string")


def accumulate(spark, source, base, listing):
    stream = spark.readStream.schema("cruise_name string, file_name string, event_time timestamp").parquet(source)
    rows = accumulator.run_accumulator(stream, listing, base).collect()
    return sorted((r["cruise_name"], r["files"]) for r in rows)


def test_completion_is_reported_once_across_restarts(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "acc")
    run = lambda: accumulate(spark, source, base, lambda: file_list(spark))
    put(spark, source, [("A", "f0"), ("A", "f0"), ("A", "f1"), ("B", "g0")])
    assert run() == []
    put(spark, source, [("A", "f0"), ("A", "f1"), ("X", "unknown")])
    assert run() == []
    put(spark, source, [("A", "f2")])
    assert run() == [("A", 3)]
    put(spark, source, [("A", "f2"), ("B", "g1"), ("B", "g0")])
    assert run() == [("A", 3), ("B", 2)]
    assert run() == [("A", 3), ("B", 2)]


def test_stray_files_complete_nothing(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "acc")
    listing = lambda: file_list(spark, [("A", "f0"), ("A", "f1")])
    put(spark, source, [("A", "f0"), ("A", "stray")])
    assert accumulate(spark, source, base, listing) == []
    put(spark, source, [("A", "f1"), ("A", "stray")])
    assert accumulate(spark, source, base, listing) == [("A", 2)]
    finished = spark.createDataFrame([("A", "f0"), ("A", "stray")], "cruise_name string, file_name string")
    assert accumulator.completed_cruises(finished, listing()).count() == 0


def test_finishes_of_a_cruise_listed_later_are_held(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "acc")
    put(spark, source, [("L", "x0"), ("L", "x1"), ("A", "f0")])
    assert accumulate(spark, source, base, lambda: file_list(spark)) == []
    later = lambda: file_list(spark, [*FILES, ("L", "x0"), ("L", "x1")])
    put(spark, source, [("A", "f1")])
    assert accumulate(spark, source, base, later) == [("L", 2)]
    put(spark, source, [("L", "x1"), ("A", "f2")])
    assert accumulate(spark, source, base, later) == [("A", 3), ("L", 2)]


def test_replayed_batch_gives_the_same_notices(spark, tmp_path):
    """A batch that fails after its status was written is run again, with the same rows."""
    source, base, broken = str(tmp_path / "in"), str(tmp_path / "acc"), [True]
    put(spark, source, [("A", "f0"), ("A", "f1"), ("A", "f2"), ("C", "held")])
    seen = []

    def then(completed, batch_id):
        seen.append((batch_id, sorted(tuple(r) for r in completed.collect())))
        if broken.pop() if broken else False:
            raise RuntimeError("lost")

    schema = "cruise_name string, file_name string, event_time timestamp"
    run = lambda: accumulator.run_accumulator(
        spark.readStream.schema(schema).parquet(source), lambda: file_list(spark), base, then=then
    )
    with pytest.raises(StreamingQueryException):
        run()
    put(spark, source, [("B", "g0"), ("B", "g1")])
    rows = sorted((r["cruise_name"], r["files"], r["batch_id"]) for r in run().collect())
    assert seen[0] == seen[1] == (0, [("A", 3, 3)]) and rows == [("A", 3, 0), ("B", 2, 1)]


def test_a_list_that_comes_in_pieces_completes_nothing_early(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "acc")
    files = [("A", f"f{i}") for i in range(40)]
    put(spark, source, files[:39])
    stream = lambda: spark.readStream.schema("cruise_name string, file_name string, event_time timestamp").parquet(source)
    listing = lambda: file_list(spark, files).repartition(8)
    assert accumulator.run_accumulator(stream(), listing, base, files_per_batch=1).count() == 0
    put(spark, source, files[39:])
    rows = accumulator.run_accumulator(stream(), listing, base, files_per_batch=1).collect()
    assert [(r["cruise_name"], r["files"]) for r in rows] == [("A", 40)]


def test_a_list_that_grows_before_completion_raises_the_number(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "acc")
    put(spark, source, [("A", "f0")])
    assert accumulate(spark, source, base, lambda: file_list(spark, [("A", "f0"), ("A", "f1")])) == []
    put(spark, source, [("A", "f1")])
    more = lambda: file_list(spark, [("A", "f0"), ("A", "f1"), ("A", "f9")])
    assert accumulate(spark, source, base, more) == []
    put(spark, source, [("A", "f9")])
    assert accumulate(spark, source, base, more) == [("A", 3)]


def test_cost_of_a_batch_does_not_grow_with_history(spark, tmp_path):
    """Later batches touch as much state and take as long as earlier ones, and no table is rewritten."""
    source, base, n = str(tmp_path / "in"), str(tmp_path / "acc"), int(os.environ.get("STREAM_BATCHES", "45"))
    rows = spark.range(n * 5).selectExpr(
        "concat('C', cast(id div 10 as string)) AS cruise_name", "concat('f', cast(id as string)) AS file_name",
        "timestamp '2023-05-23 13:00:00' AS event_time",
    )
    rows.repartitionByRange(n, F.expr("cast(substr(file_name, 2) as long)")).write.parquet(source)
    accumulator.publish_listing(rows.selectExpr("cruise_name AS cruise", "file_name AS filename"), f"{base}/listed")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    listed = spark.readStream.schema(accumulator.LISTED).parquet(f"{base}/listed")
    try:
        query = (
            accumulator.completions(stream, listed, salts=2).writeStream.option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).foreachBatch(accumulator.completion_writer(base, "stage")).start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    took = [p["batchDuration"] for p in progress]
    touched = [sum(s["numRowsUpdated"] for s in p["stateOperators"]) for p in progress]
    assert spark.read.parquet(f"{base}/notices").count() == n * 5 // 10
    third = n // 3
    early, late = (sorted(x)[third // 2] for x in (took[-3 * third : -2 * third], took[-third:]))
    assert len(took) >= 2 * third and late < 1.5 * early + 100, (early, late)
    assert max(touched[-2 * third :]) <= 40 and sum(touched[-third:]) <= 1.2 * sum(touched[-2 * third : -third])


def test_cruises_share_entries_of_state(spark, tmp_path):
    """A batch asks the state once for many cruises, and each is still counted and reported by itself."""
    source, base, n = str(tmp_path / "in"), str(tmp_path / "acc"), 4 * accumulator.BUCKETS
    files = [(f"C{i}", f"f{i}-{j}") for i in range(n) for j in range(2)]
    listing = lambda: file_list(spark, files)
    put(spark, source, [f for f in files if f[1].endswith("-0")])
    accumulator.publish_listing(listing(), f"{base}/listed")
    stream = lambda: spark.readStream.schema("cruise_name string, file_name string, event_time timestamp").parquet(source)
    listed = lambda: spark.readStream.schema(accumulator.LISTED).parquet(f"{base}/listed")

    def run():
        with keyed_state(spark):
            query = (
                accumulator.completions(stream(), listed(), salts=1).writeStream.trigger(availableNow=True)
                .option("checkpointLocation", f"{base}/checkpoint").foreachBatch(accumulator.completion_writer(base, "stage")).start()
            )
        query.awaitTermination()
        states = [s for p in query.recentProgress for s in p["stateOperators"] if s["operatorName"].startswith("transform")]
        notices = spark.read.schema(accumulator.NOTICES).parquet(f"{base}/notices").select("cruise_name", "files").collect()
        return max(s["numRowsUpdated"] for s in states), notices

    touched, rows = run()
    assert 0 < touched <= accumulator.BUCKETS and rows == []
    put(spark, source, [f for f in files if f[1].endswith("-1") and f[0] != "C7"])
    _, rows = run()
    assert sorted(tuple(r) for r in rows) == sorted((f"C{i}", 2) for i in range(n) if i != 7)
    put(spark, source, [("C7", "f7-1"), ("C8", "f8-1")])
    _, rows = run()
    assert sorted(tuple(r) for r in rows) == sorted((f"C{i}", 2) for i in range(n))


@pytest.mark.parametrize("most", [1, 7, 100, 10_000])
def test_counts_are_added_up_in_parts(monkeypatch, most):
    monkeypatch.setattr(accumulator, "COMBINED", most)
    schema = pa.schema([("cruise_name", pa.string()), pa.field("met", pa.int64(), False), pa.field("expected", pa.int64(), False)])
    rows = [(f"C{i * i % 11}", i % 2, i % 5) for i in range(200)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows[i : i + 9]], schema) for i in range(0, 200, 9)]
    found, made = {}, 0
    for batch in accumulator._by_cruise(iter(batches)):
        assert batch.schema == schema
        made += batch.num_rows
        for name, met, expected in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            before = found.get(name, (0, 0))
            found[name] = (before[0] + met, max(before[1], expected))
    want = {n: (sum(m for c, m, _ in rows if c == n), max(e for c, _, e in rows if c == n)) for n, *_ in rows}
    assert found == want and (most < 10_000 or made == len(want))


def test_messages_of_both_outcomes_are_parsed_once(spark, tmp_path):
    fields = {"prefix": "p", "ship_name": "S", "sensor_name": "EK60", "input_bucket": "i", "output_bucket": "o"}
    texts = [
        json.dumps(fields | {"cruise_name": "A", "input_file_name": "f0"}),
        json.dumps({**fields, "cruise_name": "A", "input_file_name": "f1"} | {"sensor_name": None}),
        json.dumps({k: v for k, v in fields.items() if k != "ship_name"} | {"cruise_name": "B", "input_file_name": "g"}),
        json.dumps(fields | {"cruise_name": "B"}),
        "{broken",
    ]
    notes = spark.createDataFrame([(i, T0, wrapped(t)) for i, t in enumerate(texts)], "event_seq long, event_time timestamp, value string")
    parsed = messages.parse_messages(notes)
    done = parsed.filter("valid").withColumn("file_name", F.col("input_file_name"))
    apart = messages.finished_events(done, messages.failures(parsed))
    both = messages.failures(parsed, done="SUCCESS")
    assert sorted(messages.finished_events(both).collect()) == sorted(apart.collect()) and apart.count() == 3
    assert both.filter("reason is not null").collect() == messages.failures(parsed).collect()
    assert [r["event_seq"] for r in both.filter("pipeline_status = 'SUCCESS' and reason is null").collect()] == [0]
    # The query reads its messages once a batch.
    source = str(tmp_path / "in")
    notes.repartition(1).write.parquet(source)
    stream = messages.parse_messages(spark.readStream.schema(notes.schema).parquet(source))
    query = sinks.run_available(
        messages.finished_events(messages.failures(stream, done="SUCCESS")), str(tmp_path / "out"), str(tmp_path / "cp")
    )
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(texts)


def test_failures_complete_a_cruise(spark):
    done = spark.createDataFrame([("A", "f0", T0)], "cruise_name string, file_name string, event_time timestamp")
    failed = spark.createDataFrame(
        [("A", "f1", T0), (None, None, T0)], "cruise_name string, file_name string, event_time timestamp"
    )
    finished = messages.finished_events(done, failed)
    complete = accumulator.completed_cruises(finished, file_list(spark, [("A", "f0"), ("A", "f1"), ("B", "g")]))
    assert [(r["cruise_name"], r["finished"]) for r in complete.collect()] == [("A", 2)]
    listed = spark.createDataFrame([("A", "f0"), ("A", "f1"), ("B", "g")], "cruise string, filename string").withColumns(
        {"ship": F.lit("s"), "sensor": F.lit("EK60")}
    )
    rows = accumulator.status_after_completion(complete, listed).collect()
    assert sorted((r["file_name"], r["pipeline_status"]) for r in rows) == [("f0", "SUCCESS"), ("f1", "SUCCESS")]


def test_repeats_and_status_rows(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "file_name string, cruise_name string, stage string, pipeline_status string, event_seq long, event_time timestamp"
    rows = [("f", "A", "raw", "PROCESSING", 1), ("f", "A", "raw", "PROCESSING", 2), ("f", "A", "regrid", "SUCCESS", 3)]
    spark.createDataFrame([(*r, T0) for r in rows], schema).write.parquet(source)
    stream = messages.without_repeats(spark.readStream.schema(schema).parquet(source))
    sinks.status_from_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == 2 and stored.filter("pipeline_time is null").count() == 0
    latest = status.latest_status(stored.drop("stage", "batch_id"))
    assert [(r["pipeline_status"], r["event_seq"]) for r in latest.collect()] == [("SUCCESS", 3)]


def test_late_events_are_kept_unless_a_delay_is_given(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "file_name string, cruise_name string, stage string, event_time timestamp"
    one = lambda name, at: spark.createDataFrame([(name, "A", "raw", at)], schema).coalesce(1).write.mode("append").parquet(source)
    for name, at in (("f", T0), ("g", T0 + dt.timedelta(days=30)), ("h", T0 - dt.timedelta(days=30)), ("f", T0 - dt.timedelta(days=60))):
        one(name, at)
        for delay in (None, "1 day"):
            stream = messages.without_repeats(spark.readStream.schema(schema).parquet(source), delay=delay)
            sinks.run_available(stream, str(tmp_path / f"out-{delay}"), str(tmp_path / f"cp-{delay}"))
    kept = lambda delay: sorted(r["file_name"] for r in spark.read.parquet(str(tmp_path / f"out-{delay}")).collect())
    assert kept(None) == ["f", "g", "h"] and kept("1 day") == ["f", "g"]


def test_status_rows_take_the_time_of_their_event(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("f", T0)], "file_name string, event_time timestamp").write.parquet(source)
    stream = spark.readStream.schema("file_name string, event_time timestamp").parquet(source)
    sinks.status_from_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "event_time")
    assert spark.read.parquet(str(tmp_path / "out")).first()["pipeline_time"] == T0


def test_log_lines(spark):
    lines = spark.createDataFrame(
        [("Error: Runtime exited with error: signal: killed",), ("x Task timed out after 900 s",), ("fine",)], "line string"
    )
    got = {(r["reason"], r["pipeline_status"]) for r in messages.classify_log_lines(lines).collect()}
    assert got == {("memory", "FAILURE"), ("time", "FAILURE")}


@pytest.mark.parametrize("named", [None, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"])
def test_completion_runs_in_a_session_with_another_state_store(spark, tmp_path, named):
    key, source = "spark.sql.streaming.stateStore.providerClass", str(tmp_path / "in")
    before = spark.conf.get(key)
    put(spark, source, [("A", "f0"), ("A", "f1"), ("A", "f2")])
    spark.conf.set(key, named) if named else spark.conf.unset(key)
    there = spark.conf.get(key, None)
    try:
        assert accumulate(spark, source, str(tmp_path / "acc"), lambda: file_list(spark)) == [("A", 3)]
        assert spark.conf.get(key, None) == there
    finally:
        spark.conf.set(key, before)


def test_state_is_dealt_to_few_partitions(spark, tmp_path):
    """However many partitions the session shuffles to, a batch commits no more stores than keep the cores busy."""
    key, source, base = "spark.sql.shuffle.partitions", str(tmp_path / "in"), tmp_path / "acc"
    before = spark.conf.get(key)
    most = max(STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism)
    put(spark, source, [("A", "f0"), ("A", "f1"), ("A", "f2")])
    spark.conf.set(key, str(most + 2))
    try:
        assert accumulate(spark, source, str(base), lambda: file_list(spark)) == [("A", 3)]
        assert spark.conf.get(key) == str(most + 2)
    finally:
        spark.conf.set(key, before)
    noted = json.loads((base / "checkpoint/offsets/0").read_text().splitlines()[1])
    assert noted["conf"][key] == str(most)
    # A session with fewer keeps its own, and so does a query that has begun.
    put(spark, source, [("B", "g0"), ("B", "g1")])
    assert accumulate(spark, source, str(base), lambda: file_list(spark)) == [("A", 3), ("B", 2)]
    noted = json.loads((base / "checkpoint/offsets/1").read_text().splitlines()[1])
    assert noted["conf"][key] == str(most)


def test_a_partition_has_four_stores(spark, tmp_path):
    """Each open store holds files, threads and memory, so tables of a join share one and checksums add no threads."""
    source, base = str(tmp_path / "in"), str(tmp_path / "acc")
    put(spark, source, [("A", "f0"), ("A", "f1"), ("A", "f2")])
    accumulator.publish_listing(file_list(spark), f"{base}/listed")
    stream = spark.readStream.schema("cruise_name string, file_name string, event_time timestamp").parquet(source)
    listed = spark.readStream.schema(accumulator.LISTED).parquet(f"{base}/listed")
    key = "spark.sql.streaming.checkpoint.fileChecksum.enabled"
    with keyed_state(spark):
        assert spark.conf.get(key) == "false"
        query = (
            accumulator.completions(stream, listed).writeStream.option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).foreachBatch(accumulator.completion_writer(base, "stage")).start()
        )
    query.awaitTermination()
    states = query.lastProgress["stateOperators"]
    assert sum(s["numStateStoreInstances"] for s in states) == 4 * states[0]["numShufflePartitions"]
    assert [tuple(r) for r in spark.read.parquet(f"{base}/notices").select("cruise_name", "files").collect()] == [("A", 3)]


def test_threads_do_not_put_back_each_others_settings(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.unset(key)

    def within(wait):
        time.sleep(wait)
        with keyed_state(spark):
            time.sleep(1)
            return spark.conf.get(key, None)

    try:
        with ThreadPoolExecutor(2) as threads:
            assert [*threads.map(within, (0, 0.5))] == [SETTINGS[key]] * 2
        assert spark.conf.get(key, None) is None
    finally:
        spark.conf.set(key, before)
