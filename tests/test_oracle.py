"""Every registered query against its SQL."""

import __spark_entry__ as entry
import comparing
import pytest

from breezemart.plans import oracle
from breezemart.plans.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    with comparing.oracle(sf_dir) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(oracle.statements()) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_is_lazy_and_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, connection, name):
    frame = entry.queries()[name](spark, sf_dir)
    assert comparing.differences(name, frame, connection, entry.oracle_sql()[name]) == []
