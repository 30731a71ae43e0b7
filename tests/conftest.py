import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL_SF = os.environ.get("HEARTH_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from hearth.session import build_session
    s = build_session("local[4]", 4, app_name="hearth-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    """A fresh folder per test (tests only; jobs use the shared checkpoint folder)."""
    return tempfile.mkdtemp(prefix="hearth-test-")
