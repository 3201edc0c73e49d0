"""Sonar-shaped views over the driver tables.

A view is a list of column expressions that both engines read. The few functions they name
differently are written as @us(x) (epoch microseconds) and @list(...) (array of values).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from fathomgrid.session import use_utc
from workload.registry import sql_view

_SHARED: dict[str, tuple[str, dict[str, str], str | None]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spark(text: str) -> str:
    text = re.sub(r"@us\((\w+)\)", r"unix_micros(cast(\1 as timestamp))", text)
    return text.replace("@list(", "array(")


def _duckdb(text: str) -> str:
    text = re.sub(r"@us\((\w+)\)", r"epoch_us(\1)", text)
    return text.replace("@list(", "list_value(")


def shared(name: str, source: str, columns: dict[str, str], where: str | None = None) -> None:
    _SHARED[name] = (source, columns, where)
    picked = ",\n  ".join(f"{_duckdb(e)} AS {c}" for c, e in columns.items())
    tail = f"\nWHERE {_duckdb(where)}" if where else ""
    sql_view(name, f"SELECT {picked}\nFROM {source}{tail}")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns, where = _SHARED[name]
    df = view(spark, sf_dir, source) if source in _SHARED else table(spark, sf_dir, source)
    if where:
        df = df.filter(_spark(where))
    made = [f"{_spark(e)} AS {c}" for c, e in columns.items()]
    if name == "v_keys":
        # A listing has its keys stored; made by a generator they are built once per row as well.
        return df.selectExpr(f"inline(array(struct({', '.join(made)})))")
    return df.selectExpr(*made)


def _two(number: str) -> str:
    return f"lpad(cast({number} as string), 2, '0')"


_CRUISE = f"'CR' || {_two('o_custkey % 40')}"
_SHIP = "'Ship_' || cast(o_custkey % 5 as string)"
_SENSOR = "case when o_orderkey % 3 = 1 then 'EK80' else 'EK60' end"
_DAY = f"cast(year(o_orderdate) as string) || {_two('month(o_orderdate)')} || {_two('day(o_orderdate)')}"
_CLOCK = (
    f"case when o_orderkey % 83 = 0 then '27' else {_two('(o_orderkey * 7) % 24')} end"
    f" || {_two('(o_orderkey * 11) % 60')} || {_two('(o_orderkey * 13) % 60')}"
)
_FILE = (
    "case when o_orderkey % 97 = 0 then 'NOISE-' when o_orderkey % 5 = 0 then 'L0005-'"
    " when o_orderkey % 5 = 1 then 'SaKe2015-' else '' end || "
    "case when o_orderkey % 89 = 0 then 'calibration' || cast(o_orderkey as string) "
    f"else 'D' || {_DAY} || '-T' || {_CLOCK} end"
    " || case when o_orderkey % 79 = 0 then '.idx' else '.raw' end"
)

shared(
    "v_keys",
    "orders",
    {
        "key": f"'data/raw/' || {_SHIP} || '/' || {_CRUISE} || '/' || "
        f"case when o_orderkey % 71 = 0 then '' else {_SENSOR} || '/' end || {_FILE}",
        "size": "o_orderkey * 13 + 1",
    },
)

# One row per file, named by customer (cruise) and order (file).
shared(
    "v_file_info",
    "orders",
    {
        "cruise": "'C' || cast(o_custkey as string)",
        "file_name": "'F' || lpad(cast(o_orderkey as string), 12, '0')",
        "pipeline_status": "case o_orderstatus when 'F' then 'SUCCESS' "
        "when 'O' then 'POPULATING_CRUISE_ZARR' else 'FAILURE' end",
        "start_time": "cast(year(o_orderdate) as string) || '-' || "
        f"{_two('month(o_orderdate)')} || '-' || {_two('day(o_orderdate)')} || 'T00:00:00.000Z'",
        "num_ping_time_dropna": "o_orderkey % 7",
        "min_echo_range": "case when o_orderkey % 101 = 0 then 0e0 "
        "else cast(o_orderkey % 5 + 4 as double) * 4.8e-2 end",
        "max_echo_range": "cast(o_orderkey % 50 + 10 as double) * 9.6e-1",
        "frequencies": "@list(18000 + o_orderkey % 3, 38000, 120000)",
        "channels": "@list('GPT ' || cast(18 + o_orderkey % 3 as string), 'GPT 38', 'GPT 120')",
    },
)
shared(
    "v_usable_info",
    "v_file_info",
    {c: c for c in (
        "cruise", "file_name", "pipeline_status", "start_time", "num_ping_time_dropna",
        "min_echo_range", "max_echo_range", "frequencies", "channels",
    )},
    "pipeline_status in ('SUCCESS', 'POPULATING_CRUISE_ZARR')",
)

_USER_FILE = "'F' || cast(user_id as string)"
_USER_CRUISE = "'C' || cast(user_id % 10 as string)"

shared(
    "v_status",
    "events",
    {
        "file_name": _USER_FILE,
        "cruise_name": _USER_CRUISE,
        "ship_name": "'Ship_' || cast(user_id % 5 as string)",
        "sensor_name": "'EK60'",
        "pipeline_status": "case event_type when 'signup' then 'PROCESSING' when 'error' then 'FAILURE' "
        "when 'view' then 'POPULATING_CRUISE_ZARR' else 'SUCCESS' end",
        "pipeline_time": "ts",
        "event_seq": "event_id",
        "zarr_path": "'level_1/C' || cast(user_id % 10 as string) || '/F' || cast(user_id as string) || '.zarr'",
        "num_ping_time_dropna": "event_id % 9",
    },
)
# Every event is a fix or a ping of its user's file.
shared(
    "v_fix",
    "events",
    {
        "cruise": _USER_CRUISE,
        "file_name": _USER_FILE,
        "seq": "event_id",
        "ts": "ts",
        "latitude": "case when event_id % 11 = 0 then null else value end",
        "longitude": "case when event_id % 11 = 0 then null else value * 2e0 - 1.2e2 end",
    },
    "event_type in ('view', 'signup', 'error')",
)
shared(
    "v_ping",
    "events",
    {"cruise": _USER_CRUISE, "file_name": _USER_FILE, "ping_idx": "event_id", "ping_time": "ts"},
    "event_type in ('click', 'purchase')",
)
_HOURS = "(cast(@us(ts) - 1704067200000000 as double) / 3.6e9)"
_EAST = f"(cast(user_id * 37 % 340 - 179 as double) + floor({_HOURS} / 1.2e1) * 1.37e-1)"
shared(
    "v_track",
    "events",
    {
        "cruise": "'C' || cast(user_id as string)",
        "seq": "event_id",
        "ts": "ts",
        # Eastward, and round the world: some tracks cross the antimeridian.
        "longitude": f"{_EAST} - 3.6e2 * floor(({_EAST} + 1.8e2) / 3.6e2)",
        "latitude": f"cast(user_id % 100 - 60 as double) + floor({_HOURS} / 1.2e1) * 2.5e-1"
        f" + cast((cast(floor({_HOURS} / 1.2e1) as bigint) * (user_id + 3)) % 7 as double) * 1.13e-1",
    },
)

# Sound samples: one row per embedding, its components are the samples of one ping and channel.
_PING = {
    "cruise": "'C' || cast(vec_id % 2 as string)",
    "file_name": "'F' || cast(vec_id % 8 as string)",
    "channel": "'GPT ' || cast(label as string)",
    "frequency": "cast(18000 + label * 1000 as float)",
    "ping_idx": "cast(floor(cast(vec_id as double) / 8e0) as bigint)",
}


def soundings(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = "(case when vec_id % 8 = 7 then 0e0 else 1.92e-1 * (1 + vec_id % 4) end)"
    return table(spark, sf_dir, "embeddings").selectExpr(
        *[f"{e} AS {c}" for c, e in _PING.items()],
        "cast(timestamp_micros(1704067200000000 + cast(floor(cast(vec_id as double) / 8e0) as bigint) "
        "* 1800123000) as timestamp_ntz) AS ping_time",
        f"transform(sequence(0, 63), i -> cast(i as double) * {step} + cast(vec_id % 3 as double) * 2.5e-1) "
        "AS echo_range",
        "transform(embedding, (x, i) -> case when vec_id % 13 = 0 or (vec_id + i) % 17 = 0 then null "
        "else cast(x as double) end) AS sv",
    )


sql_view(
    "v_sounding",
    "SELECT "
    + ", ".join(f"{e} AS {c}" for c, e in _PING.items())
    + """,
  make_timestamp(1704067200000000 + cast(floor(cast(vec_id as double) / 8e0) as bigint) * 1800123000) AS ping_time,
  list_transform(range(0, 64), lambda i: cast(i as double)
    * (case when vec_id % 8 = 7 then 0e0 else 1.92e-1 * (1 + vec_id % 4) end)
    + cast(vec_id % 3 as double) * 2.5e-1) AS echo_range,
  list_transform(embedding, lambda x, i: case when vec_id % 13 = 0 or (vec_id + i - 1) % 17 = 0 then null
    else cast(x as double) end) AS sv
FROM embeddings""",
)
# One row per sample; sample_idx counts from 0.
sql_view(
    "v_sample",
    """
SELECT cruise, file_name, channel, frequency, ping_idx, ping_time, vec_no, i AS sample_idx,
  echo_range[i + 1] AS depth, sv[i + 1] AS sv
FROM (SELECT *, row_number() OVER (ORDER BY cruise, file_name, ping_idx, channel) AS vec_no FROM v_sounding),
  range(0, 64) t(i)
""",
)


def sounding_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct pings of the soundings."""
    return soundings(spark, sf_dir).select("cruise", "file_name", "ping_idx", "ping_time").distinct()


sql_view("v_sounding_ping", "SELECT DISTINCT cruise, file_name, ping_idx, ping_time FROM v_sounding")

# GPS fixes for the sound files.
shared(
    "v_sounding_fix",
    "events",
    {
        "cruise": "'C' || cast(user_id % 2 as string)",
        # File F3 is left without any fix.
        "file_name": "case when user_id % 8 = 3 then 'none' else 'F' || cast(user_id % 8 as string) end",
        "seq": "event_id",
        "ts": "ts",
        "latitude": "case when event_id % 4 = 0 then null else cast(user_id % 90 as double) + 1.25e-1 end",
        "longitude": "case when event_id % 4 = 0 then null else cast(event_id % 180 as double) - 5e-1 end",
    },
)
