"""Every registered query beside its DuckDB equivalent."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from checks.compare import differences, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_an_equivalent():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    assert differences(df, connection, ORACLES[name]) == []


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "row_is_valid" in df.columns
