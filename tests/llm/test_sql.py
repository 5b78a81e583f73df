"""Queries that SQL can express, against their SQL."""

import pytest
from compare import connect, difference

from callmart.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, folder, name):
    assert difference(QUERIES[name](spark, folder), connect(folder), SQL[name]) is None
