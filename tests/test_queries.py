"""Every query with SQL gives the rows of its SQL on the smallest tables; the others give rows."""

import pytest
from helpers import SF, rows_of

from landweave.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, oracle, name):
    assert rows_of(QUERIES[name](spark, SF).toPandas()) == rows_of(oracle.execute(ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_others_run(spark, name):
    found = QUERIES[name](spark, SF)
    assert found.columns and found.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
