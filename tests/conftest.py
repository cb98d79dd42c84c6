import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rillstone.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="4", shuffle_partitions=2, memory="4g")


@pytest.fixture(scope="session")
def folder():
    return SMALL


def rows(df, *columns):
    """Sorted tuples of the named columns (all of them by default)."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
