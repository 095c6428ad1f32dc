import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestrata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="lodestrata-tests-")
    session = build_session("tests", "local[8]", 8, **{"spark.checkpoint.dir": folder, "spark.ui.enabled": "false", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SMALL
