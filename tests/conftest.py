import sys
import threading
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from pricewright.session import local_session  # noqa: E402
from pricewright.sources import market  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
TEST_SECONDS = 600


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def time_limit(request):
    """A test that hangs loses its Spark jobs and fails, and the next one goes on."""
    if "spark" not in request.fixturenames:
        yield
        return
    session = request.getfixturevalue("spark")
    timer = threading.Timer(TEST_SECONDS, session.sparkContext.cancelAllJobs)
    timer.start()
    yield
    timer.cancel()


@pytest.fixture(scope="session")
def small_market(spark):
    rows = market(spark, SMALL).persist()
    yield rows
    rows.unpersist()
