"""Every registered query against its SQL on the driver tables."""

import pytest

import __spark_entry__ as checks
from compare import connect, difference


@pytest.fixture(scope="module")
def db(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert set(checks.QUERIES) == set(checks.SQL)


@pytest.mark.parametrize("name", list(checks.QUERIES))
def test_query(spark, folder, db, name):
    assert difference(checks.queries()[name](spark, folder), db, checks.oracle_sql()[name]) is None


def test_entry(spark):
    df = checks.entry(spark)
    assert df.columns == ["PHONE_NUMBER", "ID_CUID", "DATE_", "SCORE", "SK_DATE_SCORE", "SCORE_GROUP", "SK_DTIME_SCORE"]
    assert df.count() > 0
