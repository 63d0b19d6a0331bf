import pytest
from compare import connect, differences
from conftest import SF

import __spark_entry__ as entry
from spokeline.catalogue.oracles import ORACLES
from spokeline.catalogue.queries import QUERIES


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, db, name):
    result = QUERIES[name](spark, SF)
    assert differences(result, ORACLES[name], db) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
