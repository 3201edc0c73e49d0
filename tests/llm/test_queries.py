"""Every registered query of the subpackage, and the pipeline, next to its SQL on the smallest tables."""

import pytest

import corpus_pipeline
from fathomgrid.llm.queries import ORACLES, QUERIES
from workload.check import compare, connect

SF = "/root/testdata/sf0.001"
ALL = {**QUERIES, "pipeline": corpus_pipeline.run}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(ALL))
def test_query_matches_sql(spark, con, name):
    verdict, _, _, _ = compare(spark, con, SF, name, ALL[name], ORACLES.get(name))
    assert verdict in ("ok", "rows only"), verdict


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_all_pairs(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
