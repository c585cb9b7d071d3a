import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from corpusloom.session import local_session

    s = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    """The smallest tables."""
    return "/root/testdata/sf0.001"
