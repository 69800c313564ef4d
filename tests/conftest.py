import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from arrivo import get_spark

    s = get_spark("local[2]", app="arrivo-tests", conf={
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="arrivo-test-ckpt-"),
    })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
