"""Every registered query against its DuckDB statement on whole tables."""

import pytest

import __spark_entry__ as contract
from oracle_check import compare, connect
from paneloom.queries import QUERIES

@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, db, name):
    df = contract.queries()[name](spark, sf_dir)
    notes = compare(df, db, contract.oracle_sql()[name])
    assert not notes, "\n".join(notes)
