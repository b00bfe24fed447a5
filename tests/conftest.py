import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session
    s = local_session("*", 8, app="tessera-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from tessera.sources.documents import read_table_files
    return read_table_files(spark, SF_SMALL)


def bag(df):
    """Rows as a sorted list (multiset comparison)."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
