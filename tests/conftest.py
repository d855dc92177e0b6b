import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from livetables.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="lt-warehouse-")
    s = local_session("*", 8, extra_conf={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="lt-test-")


def _duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def duck():
    return _duck(SF01)


@pytest.fixture(scope="session")
def duck_small():
    return _duck(SF001)
