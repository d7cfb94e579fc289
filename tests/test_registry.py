"""Every registered query agrees with its SQL on the smallest test tables."""

import os

import pytest

from checks.compare import compare, duck
from checks.registry import oracle_sql, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert not any("pipeline" in name or name.startswith("op") and name[2:3].isdigit() for name in queries())


@pytest.mark.parametrize("name", sorted(set(oracle_sql())))
def test_query_agrees_with_sql(spark, name):
    got = queries()[name](spark, SF).toPandas()
    assert compare(got, duck(SF).execute(oracle_sql()[name]).df()) == "ok"
