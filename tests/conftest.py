from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidewright.session import local_session

    session = local_session(os.environ.get("TEST_CPUS", "8"), shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(SF):
        pytest.skip(f"no tables at {SF}")
    return SF


def rows(df, *order):
    """Rows as plain tuples, sorted with nulls first."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: [(v is not None, str(type(v)), str(v)) for v in r])
