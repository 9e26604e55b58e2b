"""One local session for all tests; workers find the package on their path."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, f"{ROOT}/tests", os.environ.get("PYTHONPATH")) if x)
DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from corpusflow.session import local_session

    session = local_session("4", "4g", "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    """The smallest supplied data set."""
    path = DATA / "sf0.001"
    if not path.is_dir():
        pytest.skip("no supplied tables")
    return str(path)
