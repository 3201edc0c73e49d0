"""Every registered query next to its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from workload.check import compare, connect
from workload.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    verdict, _, _, _ = compare(spark, con, SF, name, QUERIES[name], ORACLES.get(name))
    assert verdict in ("ok", "rows only"), verdict


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


ORDERED = [
    "gps_asof", "ping_positions", "order_violations", "file_slices", "time_axis", "cruise_cube",
    "track_split", "track_points", "tracklines", "tile_merge",
]


@pytest.mark.parametrize("name", ORDERED)
def test_query_with_cut_groups(spark, con, monkeypatch, name):
    """The same rows when every group is too large for one task."""
    monkeypatch.setattr("fathomgrid.operators.ordered.GROUP_ROWS", 25)
    verdict, _, _, _ = compare(spark, con, SF, name, QUERIES[name], ORACLES[name])
    assert verdict == "ok", verdict


@pytest.mark.parametrize("name", ["datagram_propagation", "time_axis", "cruise_cube", "tile_merge", "completed_cruises"])
def test_query_without_broadcast(spark, con, name):
    """The same rows when nothing is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        verdict, _, _, _ = compare(spark, con, SF, name, QUERIES[name], ORACLES[name])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert verdict == "ok", verdict
