import pytest

from checks.compare import differences, duck
from rowproof.llm.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), duck(FOLDER), ORACLES[name]) == []
