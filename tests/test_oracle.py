"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry
from check_sql import ORACLE
from compare import connect, differences

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert differences(spark, con, FOLDER, entry.queries()[name], ORACLE[name]) is None
