"""Plans: windows broadcast after a count, filters at the scan, settings shuffled once."""

import pytest

import __spark_entry__ as entry
from ebbline.entities import LOGS
from ebbline.operators import cleanup
from tests.conftest import SMALL, plan

QUERIES = entry.queries()


@pytest.mark.parametrize("name", ["select_logs", "select_jobs", "select_queues", "select_audit", "select_licence"])
def test_selection_plan(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "BroadcastHashJoin" in text and "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_selection_pushes_time_and_id(spark):
    text = plan(QUERIES["select_jobs"](spark, SMALL))
    assert "GreaterThan(o_orderdate,1996-01-01" in text and "LessThanOrEqual(o_orderdate,1998-01-01" in text


def test_cleanup_needs_no_boundary_scan(views):
    text = plan(cleanup.removed(views.ledger, LOGS.__class__("ledger", "ledger_id", "creation_time"), "2024-01-21 00:00:00"))
    assert text.count("Scan parquet") <= 2 and "LessThan(ts,2024-01-21" in text  # one in the tree, one in the details


def test_column_pruning(views):
    text = plan(cleanup.boundary(views.logs, LOGS, "2024-01-21 00:00:00"))
    assert "props" not in text.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("name", ["plan_valid", "plan_windows"])
def test_planning_shuffles_the_settings_once(spark, name):
    df = QUERIES[name](spark, SMALL)
    df.collect()
    text = plan(df)
    assert "_bucket" in text and "ReusedExchange" in text
