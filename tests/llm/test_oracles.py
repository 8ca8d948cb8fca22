"""Queries with SQL against DuckDB on the driver's smallest tables."""

import os

import pytest

from gridloom.llm import queries
from tests.test_oracles import SMALL, same_rows


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    same_rows(queries.QUERIES[name](spark, SMALL), queries.ORACLES[name])
