import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regloom.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*")
    yield session
    session.stop()


@pytest.fixture(scope="session", params=["sf0.001", "sf0.01"])
def parity(request):
    """A data folder and a DuckDB connection over the same tables."""
    folder = f"{TESTDATA}/{request.param}"
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return folder, db
