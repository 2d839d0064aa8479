import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from skuflow.session import build_session

    s = build_session("local[4]", 8, app_name="skuflow-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="skuflow-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="skuflow-test-")
