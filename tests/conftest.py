import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# PySpark's own Python workers (separate processes) warn about a pandas
# deprecation inside Spark's serializer; keep the test output readable.
os.environ.setdefault("PYTHONWARNINGS", "ignore::FutureWarning")
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import local_session
    s = local_session("*", shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="strata-test-")
