import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))  # for Python workers

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from viewgrid.session import get_session

    s = get_session("local[4]", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        # tests only: no cluster-provided checkpoint directory
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="viewgrid-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from viewgrid.sources.tables import DRIVER_TABLES, table_path

    def connect(sf):
        con = duckdb.connect()
        for t in DRIVER_TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf, t)}')")
        return con

    return connect
