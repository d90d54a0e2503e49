"""Every registered query of the engine against its SQL counterpart."""

import pytest

from lexwarrant.plans import queries

from .compare import differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.REGISTRY)
def test_query(spark, name):
    query, sql = queries.REGISTRY[name]
    found = query(spark, SF)
    if sql is None:
        assert found.count() > 0
    else:
        assert differences(found, sql, SF) == ([], [])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
