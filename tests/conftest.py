import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tillstar.session import build_session
    ckpt = tempfile.mkdtemp(prefix="tillstar-test-")
    s = build_session("local[4]", app_name="tillstar-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture
def release_cache(spark):
    """Drop cached tables after a test that builds its own warehouses."""
    yield
    spark.catalog.clearCache()
