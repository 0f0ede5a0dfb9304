import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL_SF = os.environ.get("TIDEWELL_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidewell.session import build_session

    s = build_session("local[4]", app="tidewell-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidewell-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL_SF


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidewell-test-")
