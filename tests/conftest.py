import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# test modules define small functions that run in Python workers
os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(os.path.abspath(__file__))] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])

from foldwise.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, app_name="foldwise-tests")
    checkpoint_dir(s)
    yield s
    s.stop()
