"""Every registered query equals its DuckDB oracle on the smallest tables, by a plan without all-pairs joins."""

import pytest

import __spark_entry__ as entry
from check import compare, duck
from tests.conftest import SMALL, plan
from workload import load

REGISTRY = load()
QUERIES, ORACLES = REGISTRY.QUERIES, REGISTRY.ORACLES


def one_task_windows(text: str) -> list[str]:
    """Window operators fed, through a sort, by an exchange into a single partition."""
    lines = text.split("\n")
    return [line for i, line in enumerate(lines)
            if "Window [" in line and any("SinglePartition" in near for near in lines[i + 1:i + 5])]


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    ok, _, message = compare(spark, con, SMALL, name, lambda *_: df, ORACLES.get(name))
    assert ok, message
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not one_task_windows(plan(df, "simple"))


def test_only_file_reports_have_no_oracle():
    assert set(QUERIES) - set(ORACLES) == {"catalog_inventory", "table_usage", "space_totals"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
