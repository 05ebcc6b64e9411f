import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ludex.session import get_session
    return get_session("local[4]", 4, app_name="ludex-tests",
                       extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ludex-tests-")})


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
