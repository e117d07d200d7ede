from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tallywind.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def checker():
    db = duckdb.connect()
    for name in ("events", "part", "customer", "supplier", "documents", "pages", "benchmark", "labels"):
        db.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return db
