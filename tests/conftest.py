import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.session import local_session  # noqa: E402
from shared import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from millrace.plans.registry import Tables

    return Tables(spark, SMALL)
