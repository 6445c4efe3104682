"""Every registered query against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from floatlake.gallery.oracles import oracles
from floatlake.gallery.queries import QUERIES as GALLERY

SF = "/root/testdata/sf0.001"
#: Queries of the text operators are tested with them.
QUERIES, SQL = GALLERY, oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
