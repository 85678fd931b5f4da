import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package as the tests do
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidecopy.session import build_session

    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session("local[*]", shuffle_partitions=8,
                          extra={"spark.sql.warehouse.dir": f"{work}/wh"})
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{work}/ckpt")
    yield spark
    spark.stop()


@pytest.fixture
def sf_small():
    return SF_SMALL


@pytest.fixture
def sf_mid():
    return SF_MID
