"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from tablemint.workload import ORACLES, QUERIES
from tests.oracle import compare, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None
