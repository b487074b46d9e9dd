import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeops.session import build_session
from lakeops.tables import Tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return build_session("tests", 4, 4, spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SMALL)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
