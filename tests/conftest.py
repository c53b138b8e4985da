import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers inherit this, so UDFs defined in test modules can be unpickled.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, os.path.join(ROOT, "tests")] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session

    s = build_session("local[4]", app_name="tessera-tests", shuffle_partitions=8)
    yield s
    s.stop()
