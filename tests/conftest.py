import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def data():
    """Folder of the smallest tables."""
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture()
def rows():
    """Rows of a frame as a sorted list of plain tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
