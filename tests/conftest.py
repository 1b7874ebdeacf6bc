import os
import sys

import pytest

_TESTS = os.path.dirname(os.path.abspath(__file__))
_ROOT = os.path.dirname(_TESTS)
sys.path.insert(0, _ROOT)
# Python workers are started by the JVM with this environment: let them import
# the package and the test helpers that closures refer to
os.environ["PYTHONPATH"] = os.pathsep.join(
    [_ROOT, _TESTS] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])


@pytest.fixture(scope="session")
def spark():
    from noema.session import local_session
    s = local_session("*", 8, app="noema-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
