import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakepact.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="lakepact-tests")
    yield s


@pytest.fixture()
def lake(spark, tmp_path):
    """A fresh lake root per test; the test's tables live under it."""
    spark.conf.set("lakepact.lake.root", str(tmp_path / "lake"))
    return tmp_path


@pytest.fixture()
def fresh_env():
    """A contract environment name whose catalog namespace is unused."""
    return f"t{uuid.uuid4().hex[:8]}"
