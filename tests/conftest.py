from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from slipmatch.session import local_session

    session = local_session("tests", 8, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
