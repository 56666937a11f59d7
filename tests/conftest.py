import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from corpusmap.session import local_session

    os.environ.setdefault("CORPUSMAP_DRIVER_MEMORY", "4g")
    session = local_session("corpusmap-tests", cpus=8)
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpusmap-tests-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def pytest_collection_modifyitems(items):
    """Functions of test modules travel to the Python workers by value; workers cannot import them."""
    from pyspark import cloudpickle

    for module in {item.module for item in items}:
        cloudpickle.register_pickle_by_value(module)
