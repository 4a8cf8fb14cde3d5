import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_DIR = os.environ.get("LORRY_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from lorry.session import local_session

    s = local_session(shuffle_partitions=8, app="lorry-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


class FrameTables:
    """A Tables stand-in over hand-made DataFrames (unit tests)."""

    def __init__(self, spark, **frames):
        self.spark = spark
        self._frames = {k.lower(): v for k, v in frames.items()}

    def __getitem__(self, name):
        return self._frames[name.lower()]

    def period(self, *args):
        from lorry.sources.tables import Tables

        return Tables.period(self, *args)

    def _stored(self, name, column):
        return None

    def __getattr__(self, name):
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]


@pytest.fixture
def frames(spark):
    def make(**kw):
        return FrameTables(spark, **kw)
    return make
