"""Every query with an oracle gives the oracle's rows; the others run and have rows."""

import __spark_entry__ as entry
import pytest
from compare import duck, rows
from conftest import SF

QUERIES, ORACLES = entry.QUERIES, entry.ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    found = QUERIES[name](spark, SF).toPandas()
    wanted = duck(SF).execute(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).columns
    QUERIES[name](spark, SF).count()


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def test_queries_and_oracles_agree_on_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
