import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


def plan(df, mode="formatted") -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="session")
def spark():
    from ebbline.session import local_session

    return local_session(8, shuffle_partitions=4, memory="6g")


@pytest.fixture(scope="session")
def views(spark):
    from workload.registry import Views

    return Views(spark, SMALL)


@pytest.fixture
def folder(spark):
    from ebbline.session import work_dir

    return work_dir(spark, "test")
