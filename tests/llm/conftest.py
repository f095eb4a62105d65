from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def pytest_collection_modifyitems(items):
    if not os.path.isdir(SF):
        for item in items:
            item.add_marker(pytest.mark.skipif("table" in item.name, reason="the generated tables are not here"))


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package():
    """Python workers start in the folder of the tests' run."""
    os.chdir(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
