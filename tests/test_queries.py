"""Registered queries against their check SQL, and the shape of their plans."""

import pytest

import __spark_entry__ as entry
from stayflow.plans import catalog
from tests.compare import compare, connect

# The corpus queries have tests of their own in tests/llm.
QUERIES, CHECKS = catalog.QUERIES, catalog.CHECKS
SLOW = {"model_comparison", "stacking", "train_trees", "cv_metrics"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_check(spark, sf_dir, con, name):
    assert compare(con, QUERIES[name](spark, sf_dir), CHECKS[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS) - SLOW))
def test_query_without_check_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 14


@pytest.mark.parametrize("name", ["threshold_sweep", "score_batch", "row_validation", "engineered_features", "chi_square", "duplicate_stats", "audit_summary"])
def test_plan_scales(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
    if name != "chi_square":  # its p-values are computed on the result rows and dropped here
        assert "ArrowEvalPython" not in plan
    assert "Window" not in plan


def test_columns_are_pruned(spark, sf_dir):
    plan = QUERIES["threshold_sweep"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "customer" not in plan and "o_totalprice" not in plan


def test_fixture_sweep_numbers():
    """The sweep at the 0.01 scale, as recorded for the fixture."""
    con = connect("/root/testdata/sf0.01")
    rows = con.sql(
        f"SELECT threshold, true_positives, total_flagged, net_value FROM ({CHECKS['threshold_sweep']})"
    ).fetchall()
    got = {r[0]: r[1:] for r in rows}
    assert got[0.2] == (5181, 12375, 2_489_850.0)
    assert got[0.45] == (3499, 6864, 1_756_200.0)
    assert got[0.85] == (0, 0, 0.0)
