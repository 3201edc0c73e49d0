"""Statistics of sound files."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomgrid.functions import arrays
from fathomgrid.operators import filestats
from workload.registry import query, sql_view
from workload.views import soundings, table, view

sql_view(
    "v_step",
    """
SELECT cruise, file_name, vec_no, min(step) AS step, max(depth) AS deepest
FROM (SELECT *, lead(depth) OVER (PARTITION BY vec_no ORDER BY sample_idx) - depth AS step FROM v_sample)
GROUP BY cruise, file_name, vec_no""",
)
sql_view(
    "v_file_stats",
    """
SELECT s.*, t.start_time, t.end_time FROM
  (SELECT cruise, file_name, min(step) AS min_echo_range, max(deepest) AS max_echo_range
   FROM v_step GROUP BY cruise, file_name) s
JOIN (SELECT cruise, file_name,
    strftime(min_by(ping_time, ping_idx), '%Y-%m-%dT%H:%M:%S.%gZ') AS start_time,
    strftime(max_by(ping_time, ping_idx), '%Y-%m-%dT%H:%M:%S.%gZ') AS end_time
   FROM v_sounding GROUP BY cruise, file_name) t USING (cruise, file_name)""",
)
sql_view(
    "v_recorded",
    "SELECT * REPLACE (round_even(min_echo_range * 1e4, 0) / 1e4 AS min_echo_range, "
    "round_even(max_echo_range * 1e4, 0) / 1e4 AS max_echo_range) FROM v_file_stats",
)


@query(
    "file_statistics",
    """
SELECT f.*, n.channels, n.frequencies, n.pairs FROM v_file_stats f JOIN (
  SELECT cruise, file_name, string_agg(channel, ',' ORDER BY frequency, channel) AS channels,
    string_agg(cast(cast(frequency AS int) AS string), ',' ORDER BY frequency, channel) AS frequencies,
    string_agg(channel || '@' || cast(cast(frequency AS int) AS string), ',' ORDER BY frequency, channel) AS pairs
  FROM (SELECT DISTINCT cruise, file_name, channel, frequency FROM v_sounding) GROUP BY ALL) n
USING (cruise, file_name)""",
)
def file_statistics(spark, d):
    """Lists joined to text, and the pairs of channel and frequency at the same place."""
    stats = filestats.file_statistics(soundings(spark, d))
    whole = F.transform("frequencies", lambda f: f.cast("int").cast("string"))
    pairs = F.zip_with("channels", whole, lambda c, f: F.concat(c, F.lit("@"), f))
    return stats.withColumn("pairs", F.array_join(pairs, ",")).withColumns(
        {"channels": F.array_join("channels", ","), "frequencies": F.array_join(whole, ",")}
    )


@query("sample_steps", "SELECT cruise, file_name, step, deepest FROM v_step")
def sample_steps(spark, d):
    return filestats.range_steps(soundings(spark, d)).select("cruise", "file_name", "step", "deepest")


@query(
    "adjacent_differences",
    """
SELECT cruise, file_name, ping_idx, channel, sample_idx, depth - before AS difference
FROM (SELECT *, lag(depth) OVER (PARTITION BY vec_no ORDER BY sample_idx) AS before FROM v_sample)
WHERE sample_idx > 0""",
)
def adjacent_differences(spark, d):
    rows = soundings(spark, d).select(
        "cruise", "file_name", "ping_idx", "channel",
        F.posexplode(arrays.differences(F.col("echo_range"))).alias("i", "difference"),
    )
    return rows.withColumn("sample_idx", F.col("i").cast("long") + 1).drop("i")


@query(
    "recorded_ranges", "SELECT cruise, file_name, min_echo_range, max_echo_range FROM v_recorded"
)
def recorded_ranges(spark, d):
    stats = filestats.recorded_ranges(filestats.file_statistics(soundings(spark, d)))
    return stats.select("cruise", "file_name", "min_echo_range", "max_echo_range")


@query(
    "half_even_rounding",
    """
SELECT o_orderkey, round_even(cast(o_orderkey AS double) / 8e0 * 1e2, 0) / 1e2 AS two_digits,
  round_even(cast(o_totalprice AS double) / 7e0 * 1e4, 0) / 1e4 AS four_digits FROM orders""",
)
def half_even_rounding(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        arrays.half_even(F.col("o_orderkey").cast("double") / 8.0, 2).alias("two_digits"),
        arrays.half_even(F.col("o_totalprice") / 7.0, 4).alias("four_digits"),
    )


@query(
    "zero_step_files", "SELECT cruise, file_name, min_echo_range FROM v_file_stats WHERE min_echo_range <= 0"
)
def zero_step_files(spark, d):
    stats = filestats.file_statistics(soundings(spark, d))
    return filestats.zero_step_files(stats).select("cruise", "file_name", "min_echo_range")


@query(
    "loudest_per_ping",
    "SELECT cruise, file_name, ping_idx, max(sv) AS max_sv, bool_and(sv IS NULL) AS all_missing FROM v_sample GROUP BY ALL",
)
def loudest_per_ping(spark, d):
    return filestats.loudest_per_ping(soundings(spark, d))


@query(
    "cube_shape",
    "SELECT cruise, file_name, count(DISTINCT channel) AS channels, count(DISTINCT ping_idx) AS pings, "
    "max(len(sv)) AS samples FROM v_sounding GROUP BY ALL",
)
def cube_shape(spark, d):
    return filestats.cube_shape(soundings(spark, d))


@query(
    "mean_sv", "SELECT cruise, file_name, round(avg(sv), 9) AS mean_sv FROM v_sample GROUP BY cruise, file_name"
)
def mean_sv(spark, d):
    return filestats.mean_sv(soundings(spark, d)).withColumn("mean_sv", F.round("mean_sv", 9))


@query(
    "single_precision", "SELECT o_orderkey, cast(cast(o_totalprice AS float) AS double) AS price FROM orders"
)
def single_precision(spark, d):
    return table(spark, d, "orders").select("o_orderkey", arrays.single(F.col("o_totalprice")).alias("price"))


@query(
    "numeric_lists",
    "SELECT file_name, cast(unnest(frequencies) AS double) AS frequency, unnest([0, 1, 2]) AS place FROM v_file_info",
)
def numeric_lists(spark, d):
    return view(spark, d, "v_file_info").select(
        "file_name", F.posexplode(arrays.to_doubles(F.col("frequencies"))).alias("place", "frequency")
    )


@query(
    "uncalibrated_flag",
    """
SELECT event_id, text NOT LIKE '_%uncalibrated%' AS calibrated FROM (
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'uncalibrated ' || event_type
    WHEN 1 THEN event_type || ' uncalibrated' WHEN 2 THEN event_type ELSE 'Uncalibrated' END AS text FROM events)""",
)
def uncalibrated_flag(spark, d):
    described = table(spark, d, "events").selectExpr(
        "event_id",
        "case event_id % 4 when 0 then 'uncalibrated ' || event_type when 1 then event_type || ' uncalibrated' "
        "when 2 then event_type else 'Uncalibrated' end AS beam_group_descr",
    )
    return filestats.uncalibrated_files(described).select("event_id", "calibrated")
