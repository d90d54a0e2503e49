import pytest

from lexwarrant.llm import queries

from ..compare import differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query(spark, name):
    assert differences(queries.queries()[name](spark, SF), queries.oracle_sql()[name], SF) == ([], [])
