import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from isobar.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, 8)
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A new path for each use: ``folder("silver")``."""
    return lambda name: str(tmp_path / name)
