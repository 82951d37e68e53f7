from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from freightlens.session import local_session, remove_run_dirs


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests")
    session.sparkContext.setLogLevel("ERROR")
    # Plans name the whole path of a file, however long that of the temporary folder is.
    session.conf.set("spark.sql.maxMetadataStringLength", "1000")
    yield session
    remove_run_dirs(session)
    session.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    return "/root/testdata/sf0.001"
