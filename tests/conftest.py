import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from sparkmart.session import build_session
    # spark.checkpoint.dir is used as configured; only when it is unset does
    # checkpoint_root fall back to this run's warehouse folder.
    scratch = tempfile.mkdtemp(prefix="sparkmart-tests-")
    session = build_session(master="local[4]", app="sparkmart-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
    })
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="sparkmart-case-")
