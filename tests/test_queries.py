"""Every registered query of the reference's operators against its SQL."""

import pytest
from geots.plans import registry

from oracle import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    same(registry.QUERIES[name](spark, SF), db, registry.ORACLE_SQL[name])


def test_names():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())
