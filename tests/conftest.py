from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import local_session
    ckpt = tempfile.mkdtemp(prefix="tillroll-test-ckpt-")
    s = local_session("*", 8, app="tillroll-tests", extra={
        "spark.checkpoint.dir": ckpt,
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tillroll-test-wh-"),
    })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    d = "/root/testdata/sf0.001"
    for t in ("region nation customer supplier part orders lineitem events").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    return con
