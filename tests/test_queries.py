"""Every registered query of the engine against its SQL, over whole small tables."""

import os

import pytest

from sluice import queries
from tests.compare import same

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")
@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query(spark, name):
    same(spark, queries.QUERIES[name], queries.ORACLE_SQL[name], SF)


def test_every_query_has_its_sql():
    assert queries.QUERIES.keys() == queries.ORACLE_SQL.keys()


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")
def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
