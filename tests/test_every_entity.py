"""Reports over every archived entity, not over some of them."""

import pytest

from ebbline.entities import ARCHIVED
from tests.conftest import SMALL
from workload import load
from workload.schema import SOURCES

NAMES = {e.name for e in ARCHIVED}


@pytest.mark.parametrize("name, column, wanted", [
    ("volume_profile", "entity", NAMES), ("change_volume", "table_name", NAMES), ("high_watermark", "entity", NAMES),
    ("late_rows", "entity", {e.name for e in ARCHIVED if e.late}), ("source_contract", "table_name", set(SOURCES))])
def test_report_names_every_entity(spark, name, column, wanted):
    assert {r[column] for r in load().QUERIES[name](spark, SMALL).collect()} == wanted
